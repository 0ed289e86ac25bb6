"""Readers and writers: document folders, topics, raw and mart tables, the exported matrix."""
