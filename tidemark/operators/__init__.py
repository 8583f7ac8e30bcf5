"""Relational operators Spark has no single built-in for."""
