"""Operators for preparing training data: each in a module of its own, their queries in ``queries``."""
