"""Whole jobs, views, and the registered queries."""
