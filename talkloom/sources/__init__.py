"""Readers: stage tables, input lists, landed payloads, uploaded files."""
