"""Extraction, encoding, clustering, scoring and monitoring operators."""
