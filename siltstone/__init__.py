"""Spark-first analytics over scraped, semi-structured job-market data."""

__version__ = "0.1.0"
