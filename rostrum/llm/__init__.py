"""Operators for language-model training data. Nothing outside this folder imports it."""

from __future__ import annotations


def registry():
    """All queries of this subpackage."""
    from ..plans import Registry

    out = Registry()
    for module in _modules():
        out.queries |= module.query.queries
        out.sql |= module.query.sql
    return out


def _modules():
    from . import encode, leaks, lists, matching, names, noise, subjects, survivors, transcripts

    return (encode, leaks, lists, matching, names, noise, subjects, survivors, transcripts)
