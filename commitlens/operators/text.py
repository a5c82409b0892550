"""Text questions over documents (A17, F6-F8): word counts, sentences, a word fix. Whole texts, built-ins only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.functions.fields import BLANKS, ascii_lower, strip_punctuation
from commitlens.functions.partitions import spread


def _pieces(files: DataFrame, order: str, text: str, sep: str, keep=None) -> DataFrame:
    """One row per token of each file: ``(order, kind, i, token)``; kind 0 is interior, 1 a first, 2 a last token, 3 a
    whole file without a separator. Each text is split once. ``keep`` may thin out the interior (pos, token) array."""
    t = spread(files).select(order, F.split(F.coalesce(F.col(text), F.lit("")), sep).alias("t"))
    n = F.size("t")
    interior = F.filter(F.transform("t", lambda x, i: F.struct(F.lit(0).alias("kind"), i.alias("i"), x.alias("token"))),
                        lambda s: (s["i"] > 0) & (s["i"] < n - 1))
    interior = keep(interior) if keep else interior

    def edge(kind: int, i: Column) -> Column:
        return F.array(F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), F.get("t", i).alias("token")))

    every = F.when(n == 1, edge(3, F.lit(0))).otherwise(F.concat(edge(1, F.lit(0)), interior, edge(2, n - 1)))
    return t.select(order, F.explode_outer(every).alias("p")).select(order, "p.kind", "p.i", "p.token")


def _chains(edges: DataFrame, order: str) -> DataFrame:
    """Tokens that cross files, from the edge rows ``(order, kind, i, token)`` of :func:`_pieces`.

    In stream order a chain opens at a file's last token, runs through separator-free files and closes at the next
    file's first token, so its number is the count of last tokens before it: a running sum over the files. A chain's
    pieces are as long as its token, which is itself one value of the result. ``(_o, _i)`` is where it opens.
    """
    from commitlens.operators.ordered import global_running_sum
    per_file = edges.groupBy(order).agg(F.max((F.col("kind") == 2).cast("int")).alias("_ends"))
    files = global_running_sum(per_file, [order], F.col("_ends"), "_upto")
    placed = edges.join(files, order).select(
        order, "i", "token", F.when(F.col("kind") == 2, F.col("_upto")).otherwise(F.col("_upto") - F.col("_ends")).alias("c"))
    piece = F.struct(F.col(order).alias("o"), "i", "token")
    return placed.groupBy("c").agg(F.sort_array(F.collect_list(piece)).alias("s")).select(
        F.col("s")[0]["o"].alias("_o"), F.col("s")[0]["i"].alias("_i"),
        F.array_join(F.transform("s", lambda x: x["token"]), "").alias("token"))


def concatenated_tokens(files: DataFrame, order: str, text: str, sep: str, keep=None) -> DataFrame:
    """Tokens of the concatenation of all texts in ``order`` - what ``cat`` then a split on runs of ``sep`` gives -
    as rows ``(_o, _i, token)`` where ``(_o, _i)`` (the file's order value, token index) is the stream order.

    ``order`` must be unique per file (a file name or id). A file that does not end with a separator glues its last
    token to the next file's first token; a file with no separator at all is glued on both sides.
    """
    from commitlens.session import landed
    rows = landed(_pieces(files, order, text, sep, keep), "tokens")
    inside = rows.where("kind = 0").select(F.col(order).alias("_o"), F.col("i").alias("_i"), "token")
    return inside.unionByName(_chains(rows.where("kind > 0"), order))


def top_words(docs: DataFrame, k: int = 10, text: str = "text", join_files: bool = False,
              order: str | None = None) -> DataFrame:
    """The ``k`` most common words: ASCII punctuation deleted (``far-off`` -> ``faroff``), A-Z folded to
    lower case, split on blanks. Ties: word descending (the order ``sort -nr`` gives equal counts).

    Each document is a unit by default. ``join_files=True`` counts the words of the concatenation in ``order``,
    as ``cat *.txt`` would (a file without a final newline glues its last word to the next file's first word): one pass
    gives the counts of interior words and two edge tokens per file.
    Word counting is a partial + final aggregate; a very common word is combined map-side.
    """
    cleaned = ascii_lower(strip_punctuation(F.col(text)))
    if join_files:
        from commitlens.session import landed
        rows = _pieces(docs.select(order, cleaned.alias("_clean")), order, "_clean", BLANKS)
        rows = landed(rows.groupBy("kind", F.when(F.col("kind") > 0, F.col(order)).alias(order),
                                   F.when(F.col("kind") > 0, F.col("i")).alias("i"), "token")
                      .agg(F.count(F.lit(1)).alias("n")), "words")
        crossing = _chains(rows.where("kind > 0"), order).select("token", F.lit(1).cast("long").alias("n"))
        words = rows.where("kind = 0").select("token", "n").unionByName(crossing).where("token <> ''")
        counts = words.groupBy(F.col("token").alias("word")).agg(F.sum("n").alias("n"))
        return counts.orderBy(F.desc("n"), F.desc("word")).limit(k)
    # explode_outer: a plain explode makes Catalyst infer a size(split(..)) > 0 filter and push it below the
    # spread into the scan, which would run the whole regex work in the scan's single task.
    words = spread(docs).select(F.explode_outer(F.split(cleaned, BLANKS)).alias("word")).where(F.col("word") != "")
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.desc("word")).limit(k)


def sentences(docs: DataFrame, order: str = "doc_id", text: str = "text") -> DataFrame:
    """sentences = runs of text between '.' and newline (runs of separators squeezed), trimmed, empty ones
    dropped; one row per sentence with (``order``, ``pos``). Each document ends a sentence."""
    parts = spread(docs).select(order, F.posexplode_outer(F.split(F.col(text), r"[.\n]+")).alias("pos", "sentence"))
    return parts.select(order, "pos", F.trim("sentence").alias("sentence")).where(F.col("sentence") != "")


def first_sentences(docs: DataFrame, n: int = 7, order: str = "doc_id", text: str = "text",
                    join_files: bool = False) -> DataFrame:
    """The first ``n`` sentences in document order (top-n on (document, position), not a sort of all).

    No document can give more than ``n`` of them, so only its first ``n`` non-empty ones become rows.
    ``join_files=True``: sentences of the concatenation (``cat *.txt | tr -s '.' '\\n'``), so a file that does not
    end with '.' or a newline continues its last sentence into the next file. Output (``pos``, ``sentence``).
    """
    if join_files:
        def leading(tokens):
            return F.slice(F.filter(tokens, lambda s: F.trim(s["token"]) != ""), 1, n)
        toks = concatenated_tokens(docs.select(order, text), order, text, r"[.\n]+", leading)
        s = toks.select("_o", "_i", F.trim("token").alias("sentence")).where(F.col("sentence") != "")
        top = s.orderBy("_o", "_i").limit(n)
        return top.select(F.row_number().over(Window.orderBy("_o", "_i")).alias("pos"), "sentence")
    parts = F.transform(F.split(F.col(text), r"[.\n]+"), lambda x, i: F.struct(i.alias("pos"), F.trim(x).alias("sentence")))
    lead = F.slice(F.filter(parts, lambda s: s["sentence"] != ""), 1, n)
    s = spread(docs).select(order, F.explode_outer(lead).alias("s")).where("s is not null").select(order, "s.*")
    return s.orderBy(order, "pos").limit(n)


def fix_lower_i(docs: DataFrame, text: str = "text", word_boundary: bool = False) -> DataFrame:
    """F8 / D-17: replace the word `` i `` by `` I `` and ``"i `` by ``"I `` in every line, order kept.

    As the text pipeline does, the surrounding space is consumed, so in `` i i `` only the first is fixed and an
    ``i`` at line start is left; ``word_boundary=True`` fixes every standalone ``i`` instead.
    """
    t = F.col(text)
    if word_boundary:
        fixed = F.regexp_replace(t, r"\bi\b", "I")
    else:
        fixed = F.regexp_replace(F.regexp_replace(t, " i ", " I "), '"i ', '"I ')
    return spread(docs).withColumn(text, fixed)
