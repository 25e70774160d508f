"""Readers of the text formats and the relations derived from the given tables."""
