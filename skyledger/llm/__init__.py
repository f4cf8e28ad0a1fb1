"""Operators of a training-data pipeline: search, packing, mixing, de-duplication, language, secrets and quality."""
