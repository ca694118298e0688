"""Scalar projections as Spark columns."""
