"""Operators for preparing large training corpora.

Nothing else in ``factspark`` imports this subpackage; it can be deleted
without touching the knowledge-graph engine.
"""
