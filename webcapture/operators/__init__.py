"""Operators over DataFrames of responses, pages, documents and requests."""
