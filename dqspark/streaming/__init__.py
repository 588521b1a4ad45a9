"""Alerts, as rows: from a batch of outcomes or from a stream of result files."""
