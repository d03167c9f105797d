"""Operators of a training-data pipeline over document and embedding tables; nothing else in the library imports them."""
