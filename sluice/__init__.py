"""Sluice: bounded, mixed, tokenized and split text corpora as Spark jobs."""
