"""Landed files and documents to rows."""
