"""Training-data operators: token counts, scans, filters, near-duplicate join, mixing and the corpus pipeline.

Nothing outside this package imports it.
"""
