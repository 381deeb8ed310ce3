"""Operators for training-data pipelines: extraction, filters, near copies, tokens, packing, search."""
