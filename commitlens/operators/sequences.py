"""Ordered-sequence questions (L1-L18, J4, A21) on long tables ``(seq_id, pos, value)``.

Contract: ``pos`` is 0-based and contiguous within ``seq_id``; operators that drop items renumber. A NULL value is
an undefined item (the optional-number lists). Keys of all sequences, empty ones included, come as a one-column
``seq_id`` DataFrame where a question must answer for empty sequences too.

The work is grouped aggregation, joins and windows; positional renumbering runs inside blocks of positions
(:func:`row_number_within`), so one enormous sequence is not one task. Folds whose steps can be combined (affine ones, and
any others by :mod:`scan`) hold one block of positions. Only the folds with an arbitrary function (L18) hold one
sequence's values together (``collect_list``): nothing can be known of such a fold before its items are in order, so
their size bound is the longest sequence.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.operators.ordered import BLOCK, position_block, row_number_within
from commitlens.operators.scan import fold_elements, scan_elements
from commitlens.session import landed

INT_MIN = -2147483648
Pred = Callable[[Column], Column]


def renumber(seqs: DataFrame) -> DataFrame:
    """Re-issue contiguous 0-based positions after items were dropped."""
    r = row_number_within(seqs, ["seq_id"], ["pos"], position_block(), name="_rn")
    return r.withColumn("pos", F.col("_rn") - 1).drop("_rn")


def first_n(seqs: DataFrame, n: int) -> DataFrame:
    """L1: the first ``n`` items of every sequence."""
    return seqs.where(F.col("pos") < n)


def max_value(seqs: DataFrame, keys: DataFrame) -> DataFrame:
    """L2: maximum per sequence; an empty sequence gives Int.MinValue."""
    m = seqs.groupBy("seq_id").agg(F.max("value").alias("max_value"))
    return keys.join(m, "seq_id", "left").select("seq_id", F.coalesce("max_value", F.lit(INT_MIN)).alias("max_value"))


def int_range(rows: DataFrame, a: str, b: str, name: str = "value") -> DataFrame:
    """L3: the inclusive range [a, b] as rows; none when a > b (``sequence`` alone would count down).

    Blocks of the range are exploded first, then each block, so no array is longer than a block (or their number).
    """
    blocks = F.when(F.col(a) <= F.col(b), F.sequence(F.col(a).cast("long"), F.col(b).cast("long"), F.lit(BLOCK)))
    return (rows.withColumn("_start", F.explode(blocks))
            .withColumn(name, F.explode(F.sequence("_start", F.least(F.col("_start") + (BLOCK - 1), F.col(b)))))
            .drop("_start"))


def every_other_match(seqs: DataFrame, pred: Pred) -> DataFrame:
    """L4: of the items satisfying ``pred``, keep the 0th, 2nd, 4th ... (renumbered)."""
    m = renumber(seqs.where(pred(F.col("value"))))
    return m.where(F.col("pos") % 2 == 0).withColumn("pos", (F.col("pos") / 2).cast("long"))


def custom_average(seqs: DataFrame, above: int, n: int) -> DataFrame:
    """Integer mean of the first ``n`` items larger than ``above`` (sequences without such items: no row)."""
    m = renumber(seqs.where(F.col("value") > above)).where(F.col("pos") < n)
    return m.groupBy("seq_id").agg(F.expr("sum(value) div nullif(count(value), 0)").alias("average"))


def first_n_above_sum(seqs: DataFrame, keys: DataFrame, above: int = 25, n: int = 10) -> DataFrame:
    """Sum of the first ``n`` items larger than ``above``; 0 when there is none."""
    m = renumber(seqs.where(F.col("value") > above)).where(F.col("pos") < n)
    s = m.groupBy("seq_id").agg(F.sum("value").alias("total"))
    return keys.join(s, "seq_id", "left").select("seq_id", F.coalesce("total", F.lit(0)).alias("total"))


def head_sums_tail(seqs: DataFrame) -> DataFrame:
    """Length of the first sequence (lowest ``seq_id``) whose head equals the sum of the rest; no row if none."""
    g = seqs.groupBy("seq_id").agg(F.min_by("value", "pos").alias("head"), F.sum("value").alias("s"),
                                   F.count(F.lit(1)).alias("length"))
    return g.where(F.col("head") * 2 == F.col("s")).orderBy("seq_id").limit(1).select("seq_id", "length")


def first_divisible(seqs: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """The first defined item divisible by ``n`` (NULL when there is none)."""
    # min_by skips rows whose ordering is NULL, so only divisible items compete; fixed-width buffers keep this a
    # hash aggregate (a min over a struct would need a sort-based one).
    g = seqs.groupBy("seq_id").agg(F.min_by("value", F.when(F.col("value") % n == 0, F.col("pos"))).alias("value"))
    return keys.join(g, "seq_id", "left").select("seq_id", "value")


def optional_sum(seqs: DataFrame, keys: DataFrame) -> DataFrame:
    """Sum of the defined items (0 for none)."""
    g = seqs.groupBy("seq_id").agg(F.sum("value").alias("total"))
    return keys.join(g, "seq_id", "left").select("seq_id", F.coalesce("total", F.lit(0)).alias("total"))


def only_even(seqs: DataFrame) -> DataFrame:
    """The defined even items, in order (renumbered)."""
    return renumber(seqs.where(F.col("value").isNotNull() & (F.col("value") % 2 == 0)))


def twice(seqs: DataFrame) -> DataFrame:
    """Every item twice in place."""
    return seqs.select("seq_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("_i"), "pos", "value").select(
        "seq_id", (F.col("pos") * 2 + F.col("_i")).alias("pos"), "value")


def drunk_words(seqs: DataFrame) -> DataFrame:
    """The sequence reversed, and every string in it reversed."""
    n = seqs.groupBy("seq_id").agg(F.count(F.lit(1)).alias("_n"))
    return seqs.join(n, "seq_id").select("seq_id", (F.col("_n") - 1 - F.col("pos")).alias("pos"),
                                         F.reverse("value").alias("value"))


def for_all(seqs: DataFrame, keys: DataFrame, pred: Pred) -> DataFrame:
    """Does every item satisfy ``pred``? An empty sequence: true."""
    g = seqs.groupBy("seq_id").agg(F.bool_and(pred(F.col("value"))).alias("all_ok"))
    return keys.join(g, "seq_id", "left").select("seq_id", F.coalesce("all_ok", F.lit(True)).alias("all_ok"))


def last_elem(seqs: DataFrame, keys: DataFrame) -> DataFrame:
    """The last item (NULL for an empty sequence)."""
    g = seqs.groupBy("seq_id").agg(F.max_by("value", "pos").alias("value"))
    return keys.join(g, "seq_id", "left").select("seq_id", "value")


def append(xs: DataFrame, ys: DataFrame) -> DataFrame:
    """``xs ++ ys`` per sequence: ys positions shifted by the length of xs."""
    n = xs.groupBy("seq_id").agg(F.count(F.lit(1)).alias("_n"))
    shifted = ys.join(n, "seq_id", "left").select(
        "seq_id", (F.col("pos") + F.coalesce("_n", F.lit(0))).alias("pos"), "value")
    return xs.select("seq_id", "pos", "value").unionByName(shifted)


def map_values(seqs: DataFrame, f: Callable[[Column], Column]) -> DataFrame:
    """L16 map with a user Column function."""
    return seqs.withColumn("value", f(F.col("value")))


def filter_values(seqs: DataFrame, pred: Pred) -> DataFrame:
    """L16 filter with a user predicate (renumbered)."""
    return renumber(seqs.where(pred(F.col("value"))))


def flatten_nested(nested: DataFrame, column: str = "items", depth: int = 2) -> DataFrame:
    """Flatten a nested list column of the declared ``depth`` into rows (seq_id, pos, value)."""
    flat = F.col(column)
    for _ in range(depth - 1):
        flat = F.flatten(flat)
    return nested.select("seq_id", F.posexplode(flat).alias("pos", "value"))


def flatten_levels(seqs: DataFrame, levels: Sequence[str], bucket: Column) -> DataFrame:
    """L17 on a long table: nested sequences as one position column per level, outermost first (the declared depth).

    The flat position is the number of items before it in the order of the levels; no list is built. ``bucket`` must
    not decrease along that order.
    """
    r = row_number_within(seqs, ["seq_id"], list(levels), bucket, name="_rn")
    return r.select("seq_id", (F.col("_rn") - 1).alias("pos"), "value")


def _ordered_values(seqs: DataFrame) -> DataFrame:
    return seqs.groupBy("seq_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda s: s["value"]).alias("_vs"))


def fold_left(seqs: DataFrame, keys: DataFrame, init: Column, f: Callable[[Column, Column], Column]) -> DataFrame:
    """L18 foldLeft: ``f(...f(f(init, x0), x1)..., xn)`` per sequence; ``init`` for an empty one."""
    g = _ordered_values(seqs).select("seq_id", F.aggregate("_vs", init, f).alias("result"))
    return keys.join(g, "seq_id", "left").select("seq_id", F.coalesce("result", init).alias("result"))


def fold_right(seqs: DataFrame, keys: DataFrame, init: Column, f: Callable[[Column, Column], Column]) -> DataFrame:
    """L18 foldRight: ``f(x0, f(x1, ... f(xn, init)))``; ``f`` takes (item, accumulator)."""
    g = _ordered_values(seqs).select(
        "seq_id", F.aggregate(F.reverse("_vs"), init, lambda acc, x: f(x, acc)).alias("result"))
    return keys.join(g, "seq_id", "left").select("seq_id", F.coalesce("result", init).alias("result"))


def fold_affine(seqs: DataFrame, keys: DataFrame, init: int, a: int, modulus: int | None = None,
                from_right: bool = False, block: int = BLOCK) -> DataFrame:
    """L18 for folds whose step is affine in the accumulator: foldLeft of ``(acc * a + x) % m``, or with
    ``from_right`` foldRight of ``f(x, acc) = (a * acc + x) % m`` (``a = -1`` without a modulus gives ``x - acc``).

    ``%`` is the remainder with the sign of the dividend, as in :func:`fold_left`. A sequence is folded in blocks of
    ``block`` positions, each by itself, so no list is longer than a block:

    1. a block is one map ``acc -> A * acc + B`` (mod m); a scan of these maps (:mod:`scan`) gives every block the residue
       that it starts from;
    2. with a modulus that residue stands for two accumulators (``r`` and ``r - m``), so each block is folded from both
       (the first from ``init``); these pairs are combined over the blocks of a sequence.

    Without a modulus only ``a`` in -1, 0, 1 is taken: a larger power of ``a`` overflows although the result may not.
    """
    if modulus is None and a not in (-1, 0, 1):
        raise ValueError("fold_affine without a modulus takes a = -1, 0 or 1; use fold_left or fold_right")
    if modulus is not None and (modulus <= 0 or (abs(a) + 1) * modulus >= 1 << 61 or abs(init) >= 1 << 61):
        raise ValueError("fold_affine: the accumulator does not fit 64 bits; use fold_left or fold_right")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def residue(c: Column) -> Column:
        return F.pmod(c, F.lit(modulus)) if modulus else c

    def run(values: Column, start: Column) -> Column:
        return F.aggregate(values, start, lambda acc, x: (acc * a + x) % modulus if modulus else acc * a + x)

    items = F.sort_array(F.collect_list(F.struct("pos", F.col("value").cast("long").alias("v"))), asc=not from_right)
    blocks = seqs.groupBy("seq_id", F.expr(f"pos div {block}").alias("pos")).agg(
        F.transform(items, lambda s: s["v"]).alias("_vs"))
    map_of = F.aggregate("_vs", F.struct(one.alias("A"), zero.alias("B")), lambda st, x: F.struct(
        residue(st["A"] * a).alias("A"), residue(st["B"] * a + residue(x)).alias("B")))
    blocks = landed(blocks.select("seq_id", "pos", "_vs", map_of.alias("e")), "fold-blocks")
    maps = blocks.select("seq_id", "pos", "e")

    def after(x: Column, y: Column) -> Column:
        return F.struct(residue(x["A"] * y["A"]).alias("A"), residue(x["B"] * y["A"] + y["B"]).alias("B"))

    start = F.lit(init).cast("long")
    if modulus is None:
        total = fold_elements(maps, after, block, from_right).select(
            "seq_id", (F.col("e.A") * start + F.col("e.B")).alias("result"))
    else:
        before = scan_elements(maps, after, block, from_right)
        starts = before.select("seq_id", "pos", F.coalesce(
            residue(F.col("before.A") * residue(start) + F.col("before.B")), residue(start)).alias("_r"),
            F.col("before").isNull().alias("_first"))
        # A negative accumulator is r - m, any other is r; a block is what it makes of either. The first block starts from
        # ``init`` whichever it is called with.
        up = run(F.col("_vs"), F.when(F.col("_first"), start).otherwise(F.col("_r")))
        down = run(F.col("_vs"), F.when(F.col("_first"), start).otherwise(F.col("_r") - modulus))
        ends = blocks.join(starts, ["seq_id", "pos"]).select("seq_id", "pos", F.struct(up.alias("up"), down.alias("down"))
                                                            .alias("e"))

        def then(x: Column, y: Column) -> Column:
            return F.struct(*[F.when(x[k] < 0, y["down"]).otherwise(y["up"]).alias(k) for k in ("up", "down")])

        total = fold_elements(landed(ends, "fold-ends"), then, block, from_right).select(
            "seq_id", F.col("e.up").alias("result"))
    return keys.join(total, "seq_id", "left").select("seq_id", F.coalesce("result", start).alias("result"))


def reset_lift(value: Column, reset: Column) -> Column:
    """A step of :func:`reset_after`: the largest value so far, or nothing where ``reset`` holds."""
    return F.struct(F.coalesce(reset, F.lit(False)).alias("reset"),
                    F.when(reset, F.lit(None)).otherwise(value).cast("long").alias("best"))


def reset_after(x: Column, y: Column) -> Column:
    """Maximum that starts anew at a reset: ``y`` alone where it holds one."""
    return F.struct((x["reset"] | y["reset"]).alias("reset"),
                    F.when(y["reset"], y["best"]).otherwise(F.greatest(x["best"], y["best"])).alias("best"))


def flatten_any(nested: DataFrame, column: str = "items") -> DataFrame:
    """L17 for lists of any depth: ``(seq_id, path, value)`` of a VARIANT column that holds lists of values and lists.

    ``path`` is the position in each list from the outermost in; ordering by it is the flat order. Every round opens the
    outermost lists that are left and writes them, until none is; a round reads only what is still a list. Empty lists
    and a null column give no rows; JSON nulls and objects are values. ``value`` stays a VARIANT.
    """
    spark = nested.sparkSession
    is_list = F.schema_of_variant("v").startswith("ARRAY")
    rows = nested.where(F.col(column).isNotNull()).select(
        "seq_id", F.array().cast("array<int>").alias("path"), F.col(column).alias("v"))
    leaves = rows.where(~is_list)
    lists = landed(rows.where(is_list), "nested-0")
    level = 0
    while not lists.isEmpty():
        level += 1
        opened = lists.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).toDF("at", "key", "inner"))
        opened = landed(opened.select("seq_id", F.concat("path", F.array("at")).alias("path"), F.col("inner").alias("v")),
                        f"nested-{level}")
        leaves = leaves.unionByName(opened.where(~is_list))
        lists = opened.where(is_list)
    return leaves.select("seq_id", "path", F.col("v").alias("value"))


def zip_sequences(xs: DataFrame, ys: DataFrame) -> DataFrame:
    """Positional zip, stopping at the shorter sequence (inner equi-join on (seq_id, pos))."""
    return xs.select("seq_id", "pos", F.col("value").alias("left_value")).join(
        ys.select("seq_id", "pos", F.col("value").alias("right_value")), ["seq_id", "pos"])


def passing_students(grades: DataFrame, min_mean: float = 5.75, min_grade: int = 4) -> DataFrame:
    """A21 / D-11: students (seq_id) whose true mean grade is >= ``min_mean`` with no grade below ``min_grade``."""
    g = grades.groupBy("seq_id").agg(F.avg("value").alias("mean"), F.min("value").alias("low"))
    return g.where((F.col("mean") >= min_mean) & (F.col("low") >= min_grade)).agg(
        F.count(F.lit(1)).alias("n_passing"))
