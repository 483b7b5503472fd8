"""Data-engineering operators written as PySpark DataFrame transformations."""
