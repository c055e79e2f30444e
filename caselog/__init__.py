"""Append-only logs of nested records -> tested, analysis-ready tables, as Spark DataFrames."""
