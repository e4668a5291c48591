"""Operators for preparing training text: scoring, language, copies, shards, search, licences, packing, mixing."""
