"""Operators for preparing training text: audits, dedup, filters, encoding."""
