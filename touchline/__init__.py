"""Touchline: sports pages, payloads and entity files to a star schema, on Spark."""
