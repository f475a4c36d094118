"""Operators for preparing training text: packing, sharding, decontamination, quality, fingerprints, near copies,
web archives, toxicity, page text, secrets."""
