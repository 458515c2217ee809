"""Operators and a pipeline for preparing text corpora."""
