"""Column helpers, rules and schema routing."""
