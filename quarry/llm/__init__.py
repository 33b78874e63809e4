"""Operators for large training-data pipelines: scans, rules, tokenisation, dedup."""
