"""Operators run over the driver's tables: inputs, queries and their SQL twins."""
