"""Operators for preparing training corpora (documents, pages, conversations)."""
