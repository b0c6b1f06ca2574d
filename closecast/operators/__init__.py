"""Relational operators over snapshot / prediction DataFrames."""
