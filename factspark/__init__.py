"""A Spark engine that turns a knowledge graph into audited questions with one answer."""
