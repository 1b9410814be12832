"""Training-data operators: mixing, packing, WARC revisits, language, toxicity, dedup, secrets, PII.

Nothing else in the library imports this subpackage.
"""
