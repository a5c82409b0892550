"""Operator 1, secret scan with corpus-wide ownership frequency. Built-in functions only.

Three base kinds (assigned values, access keys, long hex strings) are always reported. Wider candidate kinds are
reported only where the corpus says that they look live. Every candidate value is hashed, and the hash is counted by
the distinct documents, repositories and owners that hold it:

* more than ``MAX_OWNERS`` owners: an example that people copy from each other;
* few owners, more than ``MAX_REPOS`` repositories: boilerplate that its owners put everywhere;
* few owners and repositories, more than ``MAX_ROWS`` documents: a placeholder of one place's template;
* few of all three: owner-specific, so it looks live.

Only hashes are shuffled, never values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import landed
from commitlens.llm.spans import found, gaps, kind_count, match_ends, span_text

#: Fixed patterns: kind -> (pattern, group whose text is the value, least characters of that group).
#: Runs that a pattern's class could re-enter in the middle start only at their own first character.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]++", 0, 16),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{32,}+", 0, 32),
}
ADDED = {
    "jwt": (r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", 0, 32),
    "prefixed": (r"(?<![A-Za-z0-9_-])(?:gh[opusr]_|sk_live_|xox[abprs]-|AIza)[A-Za-z0-9_-]{16,}+", 0, 20),
    "mixed": (r"(?<![A-Za-z0-9+/_-])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])(?=[A-Za-z+/_-]*+[0-9])"
              r"[A-Za-z0-9+/_-]{24,}+", 0, 24),
}
KINDS = [*BASE, *ADDED]
#: A value held by more owners, repositories or documents than these is copied.
MAX_OWNERS, MAX_REPOS, MAX_ROWS = 2, 4, 100


def _spans(text: Column, kind: str, rows: dict[str, Column]) -> Column:
    least = {**BASE, **ADDED}[kind][2]
    every = F.transform(rows["match"], lambda m, i: F.struct(
        (F.get(rows["end"], i) - F.length(m)).alias("start"), F.lit(KINDS.index(kind) + 1).alias("no"),
        F.get(rows["end"], i).alias("end"), F.length(F.get(rows["value"], i)).alias("n"),
        F.sha2(F.get(rows["value"], i), 256).alias("hash")))
    return F.filter(every, lambda s: s["n"] >= least)


def candidates(docs: DataFrame, owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row per input row: ``(row_id, doc_id, owner, repo, base, added)``; span arrays hold positions in code points
    (end exclusive) and the value's SHA-256."""
    rows = docs.select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col(owner_col).cast("string").alias("owner"),
        F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repo_cols]).alias("repo"))
    patterns = {**BASE, **ADDED}
    rows = rows.select("*", *[found("text", p).alias(f"{k}_match") for k, (p, _, _) in patterns.items()])
    rows = rows.select("*", *[gaps(F.col("text"), p, F.col(f"{k}_match")).alias(f"{k}_gap")
                              for k, (p, _, _) in patterns.items()],
                       *[(F.when(F.size(f"{k}_match") > 0, found("text", p, g)) if g else F.col(f"{k}_match"))
                         .alias(f"{k}_value") for k, (p, g, _) in patterns.items()])
    rows = rows.select("*", *[match_ends(F.col(f"{k}_match"), F.col(f"{k}_gap")).alias(f"{k}_end") for k in patterns])

    def spans(kinds):
        return F.sort_array(F.flatten(F.array(*[_spans(F.col("text"), k, {
            c: F.col(f"{k}_{c}") for c in ("match", "end", "value")}) for k in kinds])))

    return rows.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "owner", "repo",
                       spans(BASE).alias("base"), spans(ADDED).alias("added"))


def ownership(found_rows: DataFrame) -> DataFrame:
    """``(hash, owner, repo)``, one row per value and document -> ``(hash, rows, repos, owners)``. Three partial
    aggregations, so a value that every repository holds is one row per task before each shuffle."""
    by_repo = found_rows.groupBy("hash", "owner", "repo").agg(F.count("*").alias("rows"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.sum("rows").alias("rows"), F.count("*").alias("repos"))
    return by_owner.groupBy("hash").agg(F.sum("rows").alias("rows"), F.sum("repos").alias("repos"),
                                        F.count("*").alias("owners"))


def secret_spans(docs: DataFrame, owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang"),
                 max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS, max_rows: int = MAX_ROWS) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied)``, one row per input row.

    Null or empty text: no spans (the digest of an empty string). A row without an owner is an owner and a repository of
    its own, as nothing says that two such rows belong together; other null repository parts count as empty. Repeated rows
    are documents of their own; a value counts once per row, however often the row holds it. Spans are ordered by start,
    then kind; other columns are ignored; an empty table gives an empty result. ``n_live`` and ``n_copied`` count
    candidate spans by what their value's ownership says.
    """
    rows = landed(candidates(docs, owner_col, repo_cols), "secrets")
    every = rows.select("row_id", F.concat("base", "added").alias("every"), F.coalesce(
        F.concat(F.lit("="), "owner"), F.col("row_id").cast("string")).alias("owner"), "repo")
    held = every.select("owner", "repo", F.explode(F.array_distinct(F.transform(
        "every", lambda s: s["hash"]))).alias("hash"))
    live = ownership(held).where((F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
                                 & (F.col("rows") <= max_rows)).select("hash")
    judged = every.select("row_id", F.explode("every").alias("s")).select("row_id", "s.*").join(
        live, "hash", "left_semi").groupBy("row_id").agg(
        F.count("*").alias("n_live"),
        F.collect_list(F.when(F.col("no") > len(BASE), F.struct("start", "no", "end"))).alias("more"))
    plain = F.transform("base", lambda s: F.struct(s["start"], s["no"], s["end"]))
    spans = F.when(F.size("more") > 0, F.sort_array(F.concat(plain, "more"))).otherwise(plain)
    n_live = F.coalesce("n_live", F.lit(0))
    return (rows.select("row_id", "doc_id", "base", (F.size("base") + F.size("added")).alias("n_all"))
            .join(judged, "row_id", "left").select(
        "doc_id", *[kind_count(F.col("base"), n + 1).alias(f"n_{k}") for n, k in enumerate(BASE)],
        F.sha2(span_text(F.col("base"), KINDS), 256).alias("base_sha256"),
        span_text(spans, KINDS).alias("spans"),
        n_live.cast("long").alias("n_live"), (F.col("n_all") - n_live).cast("long").alias("n_copied")))
