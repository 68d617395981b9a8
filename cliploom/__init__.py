"""Dataset-curation analytics on Spark."""
