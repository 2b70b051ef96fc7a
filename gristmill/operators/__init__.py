"""Relational building blocks: joins, de-duplication, unions, rule tables and column profiles."""
