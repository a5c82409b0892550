"""Regular-expression matches with code-point positions, as Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _prefixes(numbers: Column, join) -> Column:
    """What each element and all before it join to, by doubling: log2(n) passes, each O(n); a fold that appends would be
    O(n^2). ``join`` takes an element and an earlier one, null where there is none."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(1)))).cast("int"))
    return F.reduce(
        rounds, numbers,
        lambda acc, k: F.transform(acc, lambda x, i: join(x, F.get(acc, (i - F.pow(F.lit(2), k)).cast("int")))))


def prefix_sums(numbers: Column) -> Column:
    """Running sums of an array."""
    return _prefixes(numbers, lambda x, before: x + F.coalesce(before, F.lit(0)))


def prefix_max(numbers: Column) -> Column:
    """Running maxima of an array."""
    return _prefixes(numbers, F.greatest)


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches (or one group of them)."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def gaps(text: Column, pattern: str, matches: Column) -> Column:
    """The text before, between and after the matches; null where there are none."""
    return F.when(F.size(matches) > 0, F.split(text, pattern, -1))


def match_ends(matches: Column, pieces: Column) -> Column:
    """End position (exclusive) of every match; an empty array where there are none."""
    lengths = F.transform(matches, lambda m, i: F.length(m) + F.length(F.get(pieces, i)))
    return F.when(F.size(matches) > 0, prefix_sums(lengths)).otherwise(lengths)


def kind_count(spans: Column, no: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["no"] == no)).cast("long")


def span_text(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of an array of structs with ``no`` (1-based kind), ``start`` and ``end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["no"] - 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
