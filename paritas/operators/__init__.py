"""Relational building blocks of a reconciliation, each a lazy DataFrame function."""

from . import counts, cross, diff, match, ordinals, profile, structure

__all__ = ["counts", "cross", "diff", "match", "ordinals", "profile", "structure"]
