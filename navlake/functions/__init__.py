"""Scalar expressions: feed text, periods and return arithmetic."""
