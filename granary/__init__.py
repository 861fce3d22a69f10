"""Retail demand analytics and training-data preparation on Spark."""
