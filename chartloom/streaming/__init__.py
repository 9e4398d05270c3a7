"""The micro-batch feed: scan, clean, upsert, incremental marts, batch metrics."""
