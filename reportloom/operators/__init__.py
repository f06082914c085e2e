"""Operators over report tables."""
