"""Readers, writers and landed-page decoding."""
