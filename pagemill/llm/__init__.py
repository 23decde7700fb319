"""Operators on text corpora; nothing outside this subpackage imports it."""
