"""Web-server log questions (P15-P18, A18, O4) over a line DataFrame ``(value, file, line)``.

Fields are split on single spaces as ``awk -F'[ ]'`` does (runs of spaces give empty fields) and a missing
field reads as ''. Input order is the ``(file, line)`` columns of :func:`commitlens.sources.text.read_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def field(value: str | Column, n: int) -> Column:
    """1-based space-separated field, '' when absent (awk ``$n`` with ``-F'[ ]'``)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.get(F.split(v, " "), n - 1), F.lit(""))


def _tail(c: Column) -> Column:
    """awk ``substr(x, 2)``: drop the first character."""
    return F.substr(c, F.lit(2))


def to_csv_columns(lines: DataFrame) -> DataFrame:
    """Every access-log line as client, time, method, path, status, size
    (leading ``[`` of the time and ``"`` of the method removed)."""
    v = F.col("value")
    return lines.select("file", "line", field(v, 1).alias("client"), _tail(field(v, 4)).alias("time"),
                        _tail(field(v, 6)).alias("method"), field(v, 7).alias("path"),
                        field(v, 9).alias("status"), field(v, 10).alias("size"))


def post_requests(lines: DataFrame, token: str = "POST") -> DataFrame:
    """Lines containing ``POST`` anywhere -> time, client, path, status, size.

    Built as the pipeline does: ``$4,$1,$7,$9,$10`` joined by commas with the first character of the line cut,
    then split on commas, so short lines come out exactly as the text pipeline prints them.
    """
    v = F.col("value")
    joined = F.concat_ws(",", field(v, 4), field(v, 1), field(v, 7), field(v, 9), field(v, 10))
    out = lines.where(v.contains(token)).select("file", "line", _tail(joined).alias("csv"))
    parts = F.split("csv", ",")
    return out.select("file", "line", *[F.coalesce(F.get(parts, i), F.lit("")).alias(n)
                                        for i, n in enumerate(["time", "client", "path", "status", "size"])])


def _numeric_prefix(s: str | Column) -> Column:
    """``sort -n`` key: the leading number of the text, 0 when there is none (e.g. ``-``)."""
    c = F.col(s) if isinstance(s, str) else s
    num = F.regexp_extract(c, r"^\s*(-?[0-9]+(\.[0-9]+)?)", 1)
    return F.coalesce(num.try_cast("double"), F.lit(0.0))


def largest_post(lines: DataFrame) -> DataFrame:
    """Client and path of the largest POST response (``-`` sizes count as 0; ties: the line
    ``client,path,size`` in descending byte order, as ``sort -t, -k3,3 -nr`` breaks them)."""
    p = post_requests(lines)
    whole = F.concat_ws(",", "client", "path", "size")
    return (p.orderBy(_numeric_prefix("size").desc(), whole.desc()).limit(1).select("client", "path"))


def top_post_client(lines: DataFrame) -> DataFrame:
    """The client that sent most POST requests, with the count (ties: client descending)."""
    p = post_requests(lines)
    per = p.groupBy("client").agg(F.count(F.lit(1)).alias("n"))
    return per.orderBy(F.desc("n"), F.desc("client")).limit(1)


def lines_containing(lines: DataFrame, text: str) -> DataFrame:
    """The lines containing a literal (``grep "File does not exist"``)."""
    return lines.where(F.col("value").contains(text))


def first_requests(lines: DataFrame, method: str = "GET", n: int = 3, quoted_only: bool = True) -> DataFrame:
    """P18 / O5 / D-15: the first ``n`` lines containing ``method`` in input order; by default only the quoted
    request (``"GET /path HTTP/1.1"`` without the quotes), as the question asks."""
    hits = lines.where(F.col("value").contains(method))
    out = F.regexp_extract("value", '"([^"]*)"', 1) if quoted_only else F.col("value")
    return hits.orderBy("file", "line").limit(n).select("file", "line", out.alias("request"))
