"""Operators of a training-data pipeline: encoding, scoring, deduplication, mixing. Nothing else imports this."""
