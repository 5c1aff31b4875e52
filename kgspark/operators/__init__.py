"""Relational and text operators as DataFrame transforms."""
