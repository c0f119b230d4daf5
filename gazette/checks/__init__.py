"""Test articles from the given tables, registered queries and their SQL."""
