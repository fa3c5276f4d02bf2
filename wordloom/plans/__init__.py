"""Whole jobs, from input path to output path."""
