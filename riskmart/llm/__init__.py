"""Operators of a training-data pipeline; one module each, queries and their SQL in ``queries``."""
