"""Whole runs: settings, the question pipeline, its command line."""
