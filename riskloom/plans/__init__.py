"""Operators composed into the work of a whole stage."""
