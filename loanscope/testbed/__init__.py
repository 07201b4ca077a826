"""Loan panel derived from the TPC-H style test tables, with its SQL oracle."""
