"""Spellings of other corpora: case, accents and normal forms folded by collation, group names as sets of tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Compares letters by their base, whatever their case, accents and normal form.
FOLDING = "UNICODE_CI_AI"


def folded(x: Column) -> Column:
    """A key under which spellings meet that differ in case, accents or normal form only; usable in joins and groups."""
    return F.collate(x.cast("string"), FOLDING)


def group_tokens(x: Column, ignored: tuple[str, ...] = ()) -> Column:
    """The different words of a group's name as one key, in an order of their own, without the ``ignored`` ones."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(r"([\p{L}\p{M}\p{N}]+)"), F.lit(1)))
    kept = F.filter(words, lambda w: ~w.isin(*ignored)) if ignored else words
    return F.nullif(F.array_join(F.array_sort(kept), " "), F.lit(""))
