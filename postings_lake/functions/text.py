"""Text normalisation helpers used by curation and search."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Strip U+0020 spaces at both ends (tabs and newlines are kept)."""
    return F.trim(_col(c))


def clean_lower(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c)))


def contains_term(c: Column | str, term: str) -> Column:
    """Literal, case-insensitive substring test; a null value never matches.

    ``term`` must already be lower-cased; ``%``, ``_``, ``[`` or ``.`` in it
    are plain characters.
    """
    return F.lower(F.coalesce(_col(c), F.lit(""))).contains(F.lit(term))

