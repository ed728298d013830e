"""Operators over NAV rows and scheme labels."""
