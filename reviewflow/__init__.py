"""reviewflow: a PySpark engine that prepares user comments and product reviews for analysis."""
