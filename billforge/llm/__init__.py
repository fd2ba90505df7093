"""Operators for text corpora; nothing else in billforge imports this subpackage."""
