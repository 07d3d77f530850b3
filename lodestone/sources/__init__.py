"""Readers, writers, reports, catalog tables, versioned tables and snapshots."""
