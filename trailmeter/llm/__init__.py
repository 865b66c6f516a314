"""Operators that a training-data pipeline needs, and their queries. Nothing else imports this package."""
