"""Operator 4, chat formatting of reply trees. Built-in functions only.

Messages form trees. Iterative self-joins double the reach of every message's jump to its ancestors, so ``log2(depth)``
joins give each root-to-leaf path its length and score; leaves are ranked per tree and the chosen ones walk back up over
the stored jumps (each ancestor is reached once: a distance is one sum of powers of two). Every chosen path is formatted
as one conversation with a loss mask over the assistant's texts.

Template, per turn: ``<|role|>``, a line break, the text, ``<|end|>``, a line break. In roles and texts the characters
``&``, ``<``, ``[`` and ``|`` are written as ``&amp;``, ``&lt;``, ``&#91;`` and ``&#124;``, so no control string of this or
another bracketed template can occur inside a text, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.llm.common import landed
from commitlens.llm.spans import prefix_sums

#: Escapes in the order in which they are written (and undone backwards).
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("|", "&#124;")]
END = "<|end|>\n"


def escape(c: Column) -> Column:
    for plain, coded in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def _jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """``nodes(tree, node, parent, score)`` -> jumps and whole paths, both ``(tree, node, anc, dist, total)``.

    Jump table k leads 2^k messages up, for messages at least that deep. A message is done once its jump passes the
    root: ``dist`` and ``total`` then cover its whole path, and only the others are joined again, so a few deep trees
    do not make all the rest travel. Messages on a cycle never reach a root; the doubling stops when a jump is longer
    than the table, and they are left without a path.
    """
    start = nodes.select("tree", "node", F.col("parent").alias("anc"), F.lit(1).cast("long").alias("dist"),
                         F.col("score").cast("double").alias("total"))
    known = nodes.select("tree", F.col("node").alias("anc"), F.lit(True).alias("known"))
    start = landed(start.join(known, ["tree", "anc"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("anc")).alias("anc"), "dist", "total"), "jumps")
    size = start.count()
    done, levels = start.where("anc is null"), [start.where("anc is not null")]
    while (1 << len(levels)) <= 2 * size and not levels[-1].isEmpty():
        high = done.union(levels[-1]).select("tree", F.col("node").alias("anc"), F.col("anc").alias("next"),
                                             F.col("dist").alias("more"), F.col("total").alias("plus"))
        step = landed(levels[-1].join(high, ["tree", "anc"]).select(
            "tree", "node", F.col("next").alias("anc"), (F.col("dist") + F.col("more")).alias("dist"),
            (F.col("total") + F.col("plus")).alias("total")), "jumps")
        done = done.union(step.where("anc is null"))
        levels.append(step.where("anc is not null"))
    return levels, done


def chosen_paths(nodes: DataFrame, top_k: int = 1) -> DataFrame:
    """``(tree, leaf, rank, total, node, depth)``: the messages of the ``top_k`` best root-to-leaf paths of each tree.

    A path's score is the sum of its messages' scores; equal scores rank by leaf. A parent that does not exist makes a
    message a root.
    """
    levels, done = _jumps(nodes)
    full = done.select("tree", "node", "dist", "total")
    parents = levels[0].select("tree", F.col("anc").alias("node")).distinct()
    order = Window.partitionBy("tree").orderBy(F.col("total").desc(), F.col("node"))
    marked = (full.join(parents, ["tree", "node"], "left_anti").withColumn("rank", F.row_number().over(order))
              .where(F.col("rank") <= top_k).select("tree", F.col("node").alias("leaf"), "rank", "total", "node"))
    marked = landed(marked, "paths")
    for level in reversed(levels):
        up = marked.join(level.select("tree", "node", "anc"), ["tree", "node"]).select(
            "tree", "leaf", "rank", "total", F.col("anc").alias("node"))
        marked = marked.union(landed(up, "paths"))
    return marked.join(full.select("tree", "node", F.col("dist").alias("depth")), ["tree", "node"])


def format_paths(messages: DataFrame, top_k: int = 1) -> DataFrame:
    """``messages(tree, node, parent, score, role, text)``, ``(tree, node)`` unique and not null -> one row per chosen
    path: ``(tree, leaf, rank, total, n_turns, formatted, loss_spans)``.

    ``loss_spans`` are code-point positions (end exclusive) of the assistant's escaped texts in ``formatted``. Null
    roles and texts are empty; an empty table gives no rows. A conversation is one string, so one path's messages meet
    in one row; different paths and trees never do.
    """
    paths = chosen_paths(messages.select("tree", "node", "parent", "score"), top_k)
    head = F.concat(F.lit("<|"), escape(F.coalesce("role", F.lit(""))), F.lit("|>\n"))
    turns = messages.select("tree", "node", (F.coalesce("role", F.lit("")) == "assistant").alias("loss"),
                            head.alias("head"), escape(F.coalesce("text", F.lit(""))).alias("body"))
    rows = paths.join(turns, ["tree", "node"]).groupBy("tree", "leaf", "rank", "total").agg(
        F.sort_array(F.collect_list(F.struct("depth", "loss", "head", "body"))).alias("t"))
    rows = rows.withColumn("ends", prefix_sums(F.transform(
        "t", lambda t: F.length(t["head"]) + F.length(t["body"]) + len(END))))
    spans = F.transform("t", lambda t, i: F.struct(
        t["loss"].alias("loss"), (F.get("ends", i) - len(END) - F.length(t["body"])).alias("start"),
        (F.get("ends", i) - len(END)).alias("end")))
    return rows.select(
        "tree", "leaf", "rank", "total", F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"], s["end"])).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text, start, end of the escaped text, loss) read from ``formatted`` and ``loss_spans``."""
    rows = formatted.withColumn("pieces", F.split("formatted", r"<\|end\|>\n", -1))
    rows = rows.withColumn("pieces", F.slice("pieces", 1, F.size("pieces") - 1))
    rows = rows.withColumn("ends", prefix_sums(F.transform("pieces", lambda p: F.length(p) + len(END))))
    rows = rows.withColumn("starts", F.transform("loss_spans", lambda s: s["start"]))

    def turn(p, i):
        head = F.substring_index(p, "|>\n", 1)
        start = F.get("ends", i) - len(END) - F.length(p) + F.length(head) + 3
        return F.struct(unescape(F.substr(head, F.lit(3))).alias("role"),
                        unescape(F.substr(p, F.length(head) + 4)).alias("text"),
                        F.array_contains(F.col("starts"), start).alias("loss"))

    return rows.withColumn("turns", F.transform("pieces", turn)).drop("pieces", "ends", "starts")


def threads(conversations: DataFrame) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` as messages: each row answers the row before it in its conversation.

    Rows are in order of turn (null first), ties by role, then text, so repeated rows become turns of their own. A null
    ``conv_id`` is one conversation. The score of a message is the length of its text.
    """
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"), "node",
                       F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                       F.length("text").alias("score"), "role", "text")


def formatted_conversations(conversations: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` read back from the output."""
    rows = read_back(format_paths(landed(threads(conversations), "threads")))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return rows.select(
        F.when(F.col("tree") != "", F.col("tree").cast("long")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
