"""Retail order analytics on Spark: typed layers, KPIs, data quality,
snapshot features, scoring and model evaluation.

Operators take DataFrames and return DataFrames. Writing happens only in
``orderloom.sources.tables``; ``orderloom.plans`` strings operators together.
"""
