"""Whole jobs: the configured pipeline, synthesis, audit and privacy."""
