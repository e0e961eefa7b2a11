"""Retail revenue and near-duplicate text analytics as Spark DataFrame jobs."""
