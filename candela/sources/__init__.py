"""Inputs: the driver tables, tick-shaped fixtures derived from them, lake scans and writes."""
