"""Queries as composable operators over one Spark plan."""
