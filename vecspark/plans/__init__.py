"""Whole flows composed of operators: ingest, index build and search."""
