"""Columns shown of rule outcomes."""

OUTCOME_COLUMNS = ("position", "rule", "column", "element_count", "unexpected_count", "observed", "outcome")
