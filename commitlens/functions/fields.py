"""Derived keys and scalar functions over commit columns.

Everything here returns a ``Column`` built from Spark built-ins, so it stays inside whole-stage codegen and
participates in column pruning. ``get`` is used instead of ``[n]``: under ANSI mode a short array throws on
``[n]`` but gives NULL with ``get``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "c", "url_part", "owner", "repo_name", "owner_repo", "owner_repo_between", "extension",
    "explode_files", "committer_name", "author_name", "committer_date", "author_date",
    "epoch_seconds", "day_label", "count_if", "md5_long", "strip_punctuation", "ascii_lower",
    "join_sorted",
]

# Fixed value: ASCII punctuation, the POSIX [:punct:] class, written as ranges of the ASCII table.
PUNCT_CLASS = r"[!-/:-@\[-`{-~]"
# Fixed value: blank characters that separate words (space, tab, newline, carriage return, form feed).
BLANKS = r"[\t\n\f\r ]+"


def c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def url_part(url: str | Column, n: int) -> Column:
    """n-th '/'-separated part of a string (0-based), NULL when absent."""
    return F.get(F.split(c(url), "/"), n)


def owner(url: str | Column = "url") -> Column:
    """Repository owner: part 4 of ``https://api.github.com/repos/<owner>/<repo>/commits/<sha>``."""
    return url_part(url, 4)


def repo_name(url: str | Column = "url") -> Column:
    """Repository name without owner: part 5 of the API url."""
    return url_part(url, 5)


def owner_repo(url: str | Column = "url") -> Column:
    """``owner/repo``."""
    return F.concat_ws("/", owner(url), repo_name(url))


def owner_repo_between(url: str | Column = "url") -> Column:
    """the text between ``/repos/`` and ``/commits`` (same value as :func:`owner_repo` for API urls)."""
    return F.regexp_extract(c(url), r"/repos/(.+?)/commits", 1)


def extension(filename: str | Column, no_dot: str = "unknown") -> Column:
    """F2 / D-3: the last '.'-separated segment of a file name.

    Java's split drops trailing empty parts, so ``foo.`` gives ``foo``; trailing dots are stripped to match.
    A name of dots only gives ``unknown``. Dots in directories count (``a.b/README`` gives ``b/README``).
    ``no_dot="unknown"``: names without a dot and NULL names give ``unknown`` (extension frequency).
    ``no_dot="self"``: a name without a dot is its own type (``README``); NULL stays NULL.
    """
    f = c(filename)
    stripped = F.regexp_replace(f, r"\.+$", "")
    last = F.element_at(F.split(stripped, r"\."), -1)
    last = F.when(stripped == "", F.lit("unknown")).otherwise(last)
    if no_dot == "unknown":
        return F.when(f.isNull() | ~f.contains("."), F.lit("unknown")).otherwise(last)
    if no_dot == "self":
        return F.when(f.isNull(), F.lit(None).cast("string")).otherwise(last)
    raise ValueError(f"no_dot must be 'unknown' or 'self', got {no_dot!r}")


def explode_files(commits: DataFrame, names: list[str], keep: list[str | Column] | None = None,
                  prefix: str = "") -> DataFrame:
    """one row per file with only the named file fields (``explode(arrays_zip(...))``).

    Zipping the projected arrays (rather than exploding the whole ``files`` struct) lets Parquet read only the
    named nested fields. Empty/NULL arrays produce no rows, as ``flatMap`` does.
    """
    keep = keep or []
    zipped = F.arrays_zip(*[F.col(f"files.{n}").alias(n) for n in names])
    exploded = commits.select(*keep, F.explode(zipped).alias("_f"))
    kept = [F.col(f"`{n}`") for n in exploded.columns if n != "_f"]
    return exploded.select(*kept, *[F.col(f"_f.{n}").alias(prefix + n) for n in names])


def committer_name() -> Column:
    return F.col("commit.committer.name")


def author_name() -> Column:
    return F.col("commit.author.name")


def committer_date() -> Column:
    return F.col("commit.committer.date")


def author_date() -> Column:
    return F.col("commit.author.date")


def epoch_seconds(ts: str | Column) -> Column:
    """seconds since the epoch (timestamp or ISO string)."""
    return F.unix_timestamp(c(ts))


def day_label(hour: str | Column) -> Column:
    """P19 / D-10: part of day for a UTC hour (night is 21:00-04:59)."""
    h = c(hour)
    return (F.when(h.between(5, 11), "morning")
            .when(h.between(12, 16), "afternoon")
            .when(h.between(17, 20), "evening")
            .otherwise("night"))


def count_if(arr: str | Column, pred) -> Column:
    """number of array elements satisfying ``pred`` (a Column -> Column function)."""
    return F.size(F.filter(c(arr), pred))


def md5_long(s: str | Column) -> Column:
    """Stable signed 64-bit id of a name, built from built-ins only.

    h1 = MD5 of the UTF-8 bytes, as hex without leading zeros; h2 = MD5 of that text; the result is the top
    8 bytes of h2 with the name-based UUID version nibble (3) forced in, read as a signed long.
    """
    h1 = F.regexp_replace(F.md5(F.encode(c(s), "UTF-8")), r"^0+(?=.)", "")
    h2 = F.md5(F.encode(h1, "UTF-8"))
    top = F.concat(F.substring(h2, 1, 12), F.lit("3"), F.substring(h2, 14, 3))
    return F.conv(top, 16, -10).cast("long")


def strip_punctuation(text: str | Column) -> Column:
    """delete ASCII punctuation (``far-off`` -> ``faroff``)."""
    return F.regexp_replace(c(text), PUNCT_CLASS, "")


def ascii_lower(text: str | Column) -> Column:
    """F5 for byte-oriented text tools: only A-Z are folded; other letters are kept as they are."""
    return F.translate(c(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def join_sorted(arr: str | Column, sep: str = ",") -> Column:
    """comma-join of sorted strings."""
    return F.array_join(F.array_sort(c(arr)), sep)
