"""Table operators: dedup, violations, referential checks, rules and their evaluation."""
