"""Operators that a training-data pipeline for language models needs; nothing else in loomspark imports them."""
