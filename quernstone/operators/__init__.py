"""Relational operators as DataFrame plans."""
