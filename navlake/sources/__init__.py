"""Readers for tables and text feeds."""
