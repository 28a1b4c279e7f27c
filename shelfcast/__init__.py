"""Retail stock-out analytics on Spark: bronze tables to alerts, as DataFrame jobs."""
