"""Operators for a large text corpus. Nothing else in the library imports this package."""
