"""Whole jobs: company table, consortium linking, register linking."""
