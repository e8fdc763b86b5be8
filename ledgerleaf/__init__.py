"""Spark jobs for cash-flow valuation, reserve reporting and batch operations."""

__version__ = "0.1.0"
