"""Readers and writers: test-data tables, landed API pages, stored tables."""
