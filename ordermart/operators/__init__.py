"""Reusable relational operators built from DataFrame operations."""
