"""Operators for preparing text corpora: archives, tokenizing, deduplication, scoring, decontamination."""
