"""Readers: source tables, staged files, partition catalogs and file listings."""
