"""Operators on profile collections, each a plain data-frame transformation."""
