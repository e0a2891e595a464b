"""Operators for training-data pipelines over documents, benchmark items and crawled pages."""
