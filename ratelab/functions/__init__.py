"""Column-level rules: cleaning and error terms."""
