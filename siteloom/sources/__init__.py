"""Readers and writers: variant text, summary statistics, annotation text and the QC'd matrix tables."""
