"""Incremental loads: Structured Streaming over landed
files, keyed upserts and partial recomputation."""
