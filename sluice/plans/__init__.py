"""The four corpora, from tables to split outputs."""
