"""Stored collections and bulk loaders of text reports."""
