"""Readers and writers: file trees, delimited files, reference files, period tables and reports."""
