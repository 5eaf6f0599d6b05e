"""Operators, grouped by what they compute."""
