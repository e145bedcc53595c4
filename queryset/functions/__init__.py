"""Scalar expressions over Spark columns."""
