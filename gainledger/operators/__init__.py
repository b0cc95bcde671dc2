"""Relational building blocks: history joins, size checks, key checks, stored tables."""
