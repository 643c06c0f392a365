"""Loan-risk analytics as PySpark DataFrame operators."""
