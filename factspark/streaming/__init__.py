"""Streaming forms of what a run keeps in memory: seen questions and counters. Batch runs need neither."""
