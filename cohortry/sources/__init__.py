"""Scans, sinks, reference tables and the stand-in respondent table."""
