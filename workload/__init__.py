"""Test workload: views over the given tables, queries on them, SQL to compare."""
