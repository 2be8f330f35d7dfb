"""Operators that prepare text corpora for language models; the rest of the library does not import them."""
