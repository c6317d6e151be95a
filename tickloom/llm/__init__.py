"""Operators over text corpora: cleaning, de-duplication, tokens, archives, nearest neighbours."""
