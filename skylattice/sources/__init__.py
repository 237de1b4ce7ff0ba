"""Scans, catalogs and sinks."""
