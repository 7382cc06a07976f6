"""Test inputs derived by Spark from the given TPC-H style tables."""
