"""Corpus-to-QA analytics on Spark: lazy DataFrame operators, see README.md."""
