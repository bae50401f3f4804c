"""Readers, writers and the listings adapter."""
