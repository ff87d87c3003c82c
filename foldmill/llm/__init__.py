"""Operators for large training-data pipelines over documents, pages, conversations and embeddings."""
