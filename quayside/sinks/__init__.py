"""Sinks: the gold, quarantine and check-log tables, and CSV output."""
