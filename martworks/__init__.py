"""Data-engineering jobs as plain PySpark DataFrame functions."""
