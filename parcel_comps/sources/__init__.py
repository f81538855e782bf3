"""Landed files in, files out."""
