"""Canonical JSON text and the SHA-256 content hash of a record.

The hash covers every listed attribute *including nulls*, keyed by field
name with keys sorted, compact separators, non-ASCII kept -- so two
records with the same content hash identically whatever the field order.
Nested values (lists / objects) are stored as canonical JSON *text*, so
they are hashed as strings, exactly as they are persisted.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEEP_NULLS = {"ignoreNullFields": "false"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_json(text: str | Column) -> Column:
    """Canonical form of a JSON text column: object keys sorted at every
    level, no whitespace.  Invalid JSON becomes null (``try_parse_json``)."""
    return F.to_json(F.try_parse_json(_col(text)))


def json_text(c: str | Column) -> Column:
    """A nested (array / map / struct) column rendered as JSON text."""
    return F.to_json(_col(c), _KEEP_NULLS)


def record_json(columns: Iterable[str]) -> Column:
    """Compact JSON object of the given top-level columns, keys sorted."""
    names = sorted(set(columns))
    return F.to_json(F.struct(*[F.col(f"`{n}`") for n in names]), _KEEP_NULLS)


def content_hash(columns: Iterable[str]) -> Column:
    """SHA-256 hex digest of :func:`record_json` over ``columns``."""
    return F.sha2(record_json(columns), 256)


def json_entries(text: str | Column) -> Column:
    """Generator of ``key, value`` pairs of a JSON object held as text
    (values as JSON text), for ``select(..., json_entries(c))``; the
    equivalent of a ``json_each`` table function."""
    return F.explode(F.from_json(_col(text), "map<string,string>"))


def json_items(text: str | Column, element_type: str = "string") -> Column:
    """Generator of the elements of a JSON array held as text."""
    return F.explode(F.from_json(_col(text), f"array<{element_type}>"))
