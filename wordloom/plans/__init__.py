"""Whole jobs: the pipeline, the registered queries and their SQL twins."""
