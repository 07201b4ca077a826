"""Reusable column expressions (all native Spark SQL, no UDFs)."""
