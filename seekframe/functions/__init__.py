"""Column in, column out: predicates, updates, text matching and tokens."""
