"""Operators for large training corpora, independent of the rest of the package."""
