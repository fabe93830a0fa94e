"""Readers: flow records, log lines, dimension files."""
