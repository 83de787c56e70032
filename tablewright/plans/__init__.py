"""The catalogue: one checked query per operator, each over the whole given tables."""
