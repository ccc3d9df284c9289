"""Whole jobs, from lines or records to results."""
