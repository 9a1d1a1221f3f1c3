"""Spark-first toolkit for catalog building and analysis over crawled company pages."""
