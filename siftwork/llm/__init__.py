"""Operators for training corpora: deduplication, quality, packing, mixing, toxicity, token counts.

Nothing outside this subpackage imports it.
"""
