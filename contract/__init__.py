"""The driver's queries and their SQL twins."""
