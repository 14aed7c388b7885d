"""Operators of a training-data pipeline over document, conversation, page and embedding tables."""
