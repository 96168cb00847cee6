"""Operators for preparing training text: scoring, extraction, deduplication, mixing and scans.

Nothing outside this subpackage imports it; ``queries.py`` registers its queries.
"""
