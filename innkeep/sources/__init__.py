"""Readers for landed API documents, spreadsheet extracts and tables."""
