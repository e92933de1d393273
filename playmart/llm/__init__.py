"""Operators a training-data pipeline needs over documents, pages and conversations."""
