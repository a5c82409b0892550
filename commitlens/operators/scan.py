"""Folds and running folds by any associative step over long sequences, by blocks and levels.

Rows are ``(seq_id, pos, e)``: ``e`` is an element of whatever the caller's ``combine`` joins, usually a struct that stands for
a step (``lift`` of the item). ``combine(x, y)`` is the element of x's items followed by y's; it must be associative and give
``x``'s type. A block of ``block`` positions is combined into one element, these again block by block, until one is left, so a
list has ``block`` elements at most and a sequence of n items is spread over n / block groups on the lowest level. Every
level is ``block`` times smaller than the one below; the number of levels follows the highest position. Blocks of one
position would never end: they are of two at least.

A fold by a function that is not associative has no such form; ``sequences.fold_left`` keeps its one list a sequence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.operators.ordered import BLOCK
from commitlens.session import landed

Combine = Callable[[Column, Column], Column]


def _items(from_right: bool) -> Column:
    """The elements of a group in order of their positions."""
    return F.transform(F.sort_array(F.collect_list(F.struct("pos", "e")), asc=not from_right), lambda s: s["e"])


def _whole(items: Column, combine: Combine) -> Column:
    return F.aggregate(F.slice(items, 2, F.size(items)), items[0], combine)


def _before(items: Column, combine: Combine) -> Column:
    """What stands before each element of an array, null for the first: doubling, log2(n) passes of O(n) each."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(items), F.lit(1)))).cast("int"))

    powers = F.transform(rounds, lambda k: F.pow(F.lit(2), k).cast("int"))
    upto = F.aggregate(powers, items, lambda acc, back: F.transform(
        acc, lambda e, i: F.when(i >= back, combine(F.get(acc, i - back), e)).otherwise(e)))
    return F.transform(items, lambda e, i: F.when(i > 0, F.get(upto, i - 1)))


def _highest(rows: DataFrame) -> int:
    return rows.agg(F.max("pos")).first()[0] or 0


def _level(rows: DataFrame, combine: Combine, block: int, from_right: bool) -> DataFrame:
    up = rows.groupBy("seq_id", F.expr(f"pos div {block}").alias("up")).agg(_items(from_right).alias("items"))
    return up.select("seq_id", F.col("up").alias("pos"), _whole(F.col("items"), combine).alias("e"))


def fold_elements(rows: DataFrame, combine: Combine, block: int = BLOCK, from_right: bool = False) -> DataFrame:
    """``(seq_id, e)``: all elements of each sequence combined, in order (or from the last to the first)."""
    highest, block = _highest(rows), max(block, 2)
    while True:
        rows, highest = _level(rows, combine, block, from_right), highest // block
        if not highest:
            return rows.select("seq_id", "e")


def scan_elements(rows: DataFrame, combine: Combine, block: int = BLOCK, from_right: bool = False) -> DataFrame:
    """``(seq_id, pos, before)``: what all elements before (or, from the right, after) a position combine to; null where
    there are none. Levels are combined upwards, then every block is given what stands before it."""
    block = max(block, 2)
    groups = rows.groupBy("seq_id", F.expr(f"pos div {block}").alias("up")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "e")), asc=not from_right).alias("items"))
    elements = F.transform("items", lambda s: s["e"])
    if not _highest(rows):
        return rows.select("seq_id", "pos", F.when(F.lit(False), F.col("e")).alias("before"))
    groups = landed(groups.select("seq_id", "up", F.transform("items", lambda s: s["pos"]).alias("at"),
                                  _before(elements, combine).alias("inside"), _whole(elements, combine).alias("e")), "scan")
    carried = scan_elements(groups.select("seq_id", F.col("up").alias("pos"), "e"), combine, block, from_right)
    carried = carried.select("seq_id", F.col("pos").alias("up"), F.col("before").alias("carry"))
    inner = groups.select("seq_id", "up", F.explode(F.arrays_zip("at", "inside")).alias("x")).join(
        carried, ["seq_id", "up"])
    inside = F.col("x.inside")
    before = F.when(inside.isNull(), F.col("carry")).when(F.col("carry").isNull(), inside).otherwise(
        combine(F.col("carry"), inside))
    return inner.select("seq_id", F.col("x.at").alias("pos"), before.alias("before"))


def fold_steps(seqs: DataFrame, keys: DataFrame, lift: Callable[[DataFrame], Column], combine: Combine,
               finish: Callable[[Column], Column], empty: Column, block: int = BLOCK,
               from_right: bool = False) -> DataFrame:
    """``(seq_id, result)`` of every key: ``finish`` of the combined steps, ``empty`` where there are no items."""
    rows = seqs.select("seq_id", "pos", lift(seqs).alias("e"))
    total = fold_elements(rows, combine, block, from_right).select("seq_id", finish(F.col("e")).alias("result"))
    return keys.join(total, "seq_id", "left").select("seq_id", F.coalesce("result", empty).alias("result"))
