"""Column expressions: scalar text/number/time rules and nested-value rules."""
