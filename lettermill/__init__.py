"""Conversation curation and corpus preparation on PySpark DataFrames."""
