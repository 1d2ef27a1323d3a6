"""Operators for preparing training corpora, and the queries over them."""
