"""Operators for preparing training text: near copies, quality, language, decontamination, shards, packing."""
