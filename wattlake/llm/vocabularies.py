"""Vocabulary files of public tokenizers. Every function that needs one takes its path."""

from __future__ import annotations


def default_path(name: str) -> str:
    """Place of a vocabulary file on the machine that asks (each executor has its own copy)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def resolve(path: str) -> str:
    """A path as it is; a bare file name is looked up among the installed vocabularies."""
    return path if "/" in path else default_path(path)
