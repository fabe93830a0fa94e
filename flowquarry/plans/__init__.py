"""Whole queries: forensics, dashboards, capture report."""
