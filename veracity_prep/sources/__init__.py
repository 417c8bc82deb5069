"""Scans of the raw corpora and of processed tables, and the sinks that write them."""
