"""Operators for preparing training corpora; see the README for the method of each."""
