"""Operators of a training-data pipeline over text documents.

One module per operator; ``queries`` registers one query per operator and the
pipeline.  Nothing outside this subpackage imports it."""
