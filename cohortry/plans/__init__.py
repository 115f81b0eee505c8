"""Whole studies, the registered queries and their SQL counterparts."""
