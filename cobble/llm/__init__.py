"""Operators of a training-data pipeline: tokens, secrets, near-duplicates, chat, decontamination,
fingerprints, URL filters, quality, packing, toxicity. Nothing else in the library imports this package."""
