"""Operators for training-data pipelines on documents, conversations and embeddings."""
