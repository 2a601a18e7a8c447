"""Layered e-commerce analytics on Spark DataFrames: ingest, quality, history, star schema, reports."""
