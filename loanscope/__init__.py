"""Loan-portfolio credit monitoring on Spark."""
