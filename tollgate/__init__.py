"""Spark jobs for transaction data: clean, train, validate, score, watch the load."""
