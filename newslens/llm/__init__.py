"""Operators for cleaning, scoring, mixing and encoding training documents."""
