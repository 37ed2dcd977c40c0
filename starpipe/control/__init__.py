"""Incremental batches: the high-watermark control table. There are no event streams."""
