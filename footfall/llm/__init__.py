"""Operators of a training-data pipeline, each a Spark job over a table of texts.

Nothing outside this subpackage imports it.  ``queries.py`` registers one query
per operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
