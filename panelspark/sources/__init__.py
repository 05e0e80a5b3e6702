"""Readers, writers and literal dimension tables."""
