"""Whole pipelines: consolidate, load, dump."""
