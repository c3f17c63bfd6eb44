"""Training-data operators: one module per operator, queries and SQL in ``queries``."""
