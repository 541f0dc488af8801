"""Operators for preparing training data: token counts, filters, deduplication, packing and archives."""
