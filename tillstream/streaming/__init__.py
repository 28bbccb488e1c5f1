"""Streaming jobs, one query per layer, with topics or tables between them."""
