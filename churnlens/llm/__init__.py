"""Operators for preparing large text corpora: deduplication, tokenizers, search, classifiers, packing, sharding."""
