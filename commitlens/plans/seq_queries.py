"""Bindings of the ordered-sequence questions (L1-L18, J4, A21, P19 labels) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from commitlens.functions.labels import fizzbuzz, label_counts, traffic_light_rule
from commitlens.operators import sequences as L
from commitlens.plans.registry import register
from commitlens.plans.seqview import ORACLE_CTE, customer_orders, event_types, order_keys, quantities
from commitlens.plans.testbed import table

W = "WITH " + ORACLE_CTE


def q(spark, sf, col="value"):
    s = quantities(spark, sf)
    return s.select("seq_id", "pos", F.col(col).alias("value"))


@register("seq_first_n", W + "SELECT seq_id, pos, value FROM sq WHERE pos < 3")
def seq_first_n(spark, sf):
    return L.first_n(q(spark, sf), 3)


@register("seq_max", W + """
SELECT ks.seq_id, coalesce(max(sq.value), -2147483648) AS max_value FROM ks LEFT JOIN sq ON ks.seq_id = sq.seq_id
GROUP BY ks.seq_id""")
def seq_max(spark, sf):
    return L.max_value(q(spark, sf), order_keys(spark, sf))


@register("seq_range", """
SELECT seq_id, a, b, unnest(generate_series(a, b)) AS value FROM (
  SELECT l_orderkey AS seq_id, CAST(l_linenumber AS BIGINT) AS a, CAST(trunc(l_quantity) AS BIGINT) % 10 AS b FROM lineitem)
WHERE a <= b""")
def seq_range(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("seq_id"), F.col("l_linenumber").cast("long").alias("a"),
        (F.col("l_quantity").cast("long") % 10).alias("b"))
    return L.int_range(rows, "a", "b")


@register("seq_every_other", W + """
, m AS (SELECT seq_id, value, row_number() OVER (PARTITION BY seq_id ORDER BY pos) - 1 AS r FROM sq WHERE value > 25)
SELECT seq_id, r // 2 AS pos, value FROM m WHERE r % 2 = 0""")
def seq_every_other(spark, sf):
    return L.every_other_match(q(spark, sf), lambda v: v > 25)


@register("seq_custom_average", W + """
, m AS (SELECT seq_id, value, row_number() OVER (PARTITION BY seq_id ORDER BY pos) AS r FROM sq WHERE value > 20)
SELECT seq_id, CAST(sum(value) // count(*) AS BIGINT) AS average FROM m WHERE r <= 3 GROUP BY seq_id""")
def seq_custom_average(spark, sf):
    return L.custom_average(q(spark, sf), 20, 3)


@register("seq_first10_above25", W + """
, m AS (SELECT seq_id, value, row_number() OVER (PARTITION BY seq_id ORDER BY pos) AS r FROM sq WHERE value > 25),
s AS (SELECT seq_id, sum(value) AS total FROM m WHERE r <= 10 GROUP BY seq_id)
SELECT ks.seq_id, CAST(coalesce(s.total, 0) AS BIGINT) AS total FROM ks LEFT JOIN s ON ks.seq_id = s.seq_id""")
def seq_first10_above25(spark, sf):
    return L.first_n_above_sum(q(spark, sf), order_keys(spark, sf), 25, 10)


@register("seq_head_sums_tail", W + """
, g AS (SELECT seq_id, arg_min(value, pos) AS head, sum(value) AS s, count(*) AS length FROM sq GROUP BY seq_id)
SELECT seq_id, length FROM g WHERE 2 * head = s ORDER BY seq_id LIMIT 1""")
def seq_head_sums_tail(spark, sf):
    return L.head_sums_tail(q(spark, sf))


@register("seq_first_div", W + """
, d AS (SELECT seq_id, arg_min(opt, pos) AS value FROM sq WHERE opt % 7 = 0 GROUP BY seq_id)
SELECT ks.seq_id, d.value FROM ks LEFT JOIN d ON ks.seq_id = d.seq_id""")
def seq_first_div(spark, sf):
    return L.first_divisible(q(spark, sf, "opt"), order_keys(spark, sf), 7)


@register("seq_optional_sum", W + """
SELECT ks.seq_id, CAST(coalesce(sum(sq.opt), 0) AS BIGINT) AS total FROM ks LEFT JOIN sq ON ks.seq_id = sq.seq_id
GROUP BY ks.seq_id""")
def seq_optional_sum(spark, sf):
    return L.optional_sum(q(spark, sf, "opt"), order_keys(spark, sf))


@register("seq_only_even", W + """
SELECT seq_id, row_number() OVER (PARTITION BY seq_id ORDER BY pos) - 1 AS pos, opt AS value FROM sq WHERE opt % 2 = 0""")
def seq_only_even(spark, sf):
    return L.only_even(q(spark, sf, "opt"))


@register("seq_twice", W + "SELECT seq_id, pos * 2 + i AS pos, value FROM sq, range(2) t(i)")
def seq_twice(spark, sf):
    return L.twice(q(spark, sf))


@register("seq_drunk_words", W + """
SELECT seq_id, count(*) OVER (PARTITION BY seq_id) - 1 - pos AS pos, reverse(value) AS value FROM ev""")
def seq_drunk_words(spark, sf):
    return L.drunk_words(event_types(spark, sf))


@register("seq_forall", W + """
SELECT ks.seq_id, coalesce(bool_and(sq.value >= 5), true) AS all_ok FROM ks LEFT JOIN sq ON ks.seq_id = sq.seq_id
GROUP BY ks.seq_id""")
def seq_forall(spark, sf):
    return L.for_all(q(spark, sf), order_keys(spark, sf), lambda v: v >= 5)


@register("seq_last", W + """
SELECT ks.seq_id, arg_max(sq.value, sq.pos) AS value FROM ks LEFT JOIN sq ON ks.seq_id = sq.seq_id GROUP BY ks.seq_id""")
def seq_last(spark, sf):
    return L.last_elem(q(spark, sf), order_keys(spark, sf))


@register("seq_append", W + """
SELECT seq_id, pos, value FROM sq
UNION ALL
SELECT sq.seq_id, sq.pos + n.n AS pos, sq.pk AS value FROM sq JOIN (SELECT seq_id, count(*) AS n FROM sq GROUP BY 1) n
  ON sq.seq_id = n.seq_id""")
def seq_append(spark, sf):
    return L.append(q(spark, sf), q(spark, sf, "pk"))


@register("seq_map", W + "SELECT seq_id, pos, value * 2 + 1 AS value FROM sq")
def seq_map(spark, sf):
    return L.map_values(q(spark, sf), lambda v: v * 2 + 1)


@register("seq_filter", W + """
SELECT seq_id, row_number() OVER (PARTITION BY seq_id ORDER BY pos) - 1 AS pos, value FROM sq WHERE value % 2 = 1""")
def seq_filter(spark, sf):
    return L.filter_values(q(spark, sf), lambda v: v % 2 == 1)


@register("seq_flatten", W + """
SELECT seq_id, row_number() OVER (PARTITION BY seq_id ORDER BY rf, pos) - 1 AS pos, value FROM sq""")
def seq_flatten(spark, sf):
    """Per order, the items nested by return flag (level 1) and position (level 2)."""
    return L.flatten_levels(quantities(spark, sf), ["rf", "pos"], F.col("rf"))


@register("seq_fold_left", W + """
, l AS (SELECT seq_id, list(value ORDER BY pos) AS vs FROM sq GROUP BY seq_id)
SELECT ks.seq_id, coalesce(list_reduce(l.vs, lambda acc, x: (acc * 31 + x) % 1000003, 7), 7) AS result
FROM ks LEFT JOIN l ON ks.seq_id = l.seq_id""")
def seq_fold_left(spark, sf):
    return L.fold_affine(q(spark, sf), order_keys(spark, sf), 7, 31, modulus=1000003)


@register("seq_fold_right", W + """
, l AS (SELECT seq_id, list(value ORDER BY pos DESC) AS vs FROM sq GROUP BY seq_id)
SELECT ks.seq_id, coalesce(list_reduce(l.vs, lambda acc, x: x - acc, 0), 0) AS result
FROM ks LEFT JOIN l ON ks.seq_id = l.seq_id""")
def seq_fold_right(spark, sf):
    return L.fold_affine(q(spark, sf), order_keys(spark, sf), 0, -1, from_right=True)


_SIGNED = """
, l AS (SELECT seq_id, list(value - 25 ORDER BY pos {order}) AS vs FROM sq GROUP BY seq_id)
SELECT ks.seq_id, coalesce(list_reduce(l.vs, lambda acc, x: (acc * 31 + x) % 1000003, {init}), {init}) AS result
FROM ks LEFT JOIN l ON ks.seq_id = l.seq_id"""


def _signed(spark, sf):
    return q(spark, sf).withColumn("value", F.col("value") - 25)


def _step(acc, x):
    return (acc * 31 + x) % 1000003


@register("seq_fold_left_signed", W + _SIGNED.format(order="", init=-7))
def seq_fold_left_signed(spark, sf):
    """Values of both signs, folded in blocks of two positions."""
    return L.fold_affine(_signed(spark, sf), order_keys(spark, sf), -7, 31, modulus=1000003, block=2)


@register("seq_fold_left_any", W + _SIGNED.format(order="", init=-7))
def seq_fold_left_any(spark, sf):
    """The fold with an arbitrary function (here the same one), values of both signs."""
    return L.fold_left(_signed(spark, sf), order_keys(spark, sf), F.lit(-7).cast("long"), _step)


@register("seq_fold_right_any", W + _SIGNED.format(order="DESC", init=5))
def seq_fold_right_any(spark, sf):
    return L.fold_right(_signed(spark, sf), order_keys(spark, sf), F.lit(5).cast("long"), lambda x, acc: _step(acc, x))


@register("seq_fold_max_reset", W + """
, l AS (SELECT seq_id, list({'v': value, 'z': rf = 'R'} ORDER BY pos) AS vs FROM sq GROUP BY seq_id)
SELECT ks.seq_id, coalesce(list_reduce(list_transform(l.vs, lambda s: CASE WHEN s.z THEN NULL ELSE s.v END),
         lambda acc, x: CASE WHEN x IS NULL THEN 0 ELSE greatest(acc, x) END, 0), 0) AS result
FROM ks LEFT JOIN l ON ks.seq_id = l.seq_id""")
def seq_fold_max_reset(spark, sf):
    """L18 by a step that forgets: the maximum since the last returned item, in blocks of two positions."""
    from commitlens.operators.scan import fold_steps
    from commitlens.operators.sequences import reset_after, reset_lift
    return fold_steps(quantities(spark, sf), order_keys(spark, sf), lambda _: reset_lift(F.col("value"), F.col("rf") == "R"),
                      reset_after, lambda e: F.greatest(e["best"], F.lit(0)), F.lit(0).cast("long"), block=2)


@register("seq_fold_text_length", W + """
, l AS (SELECT seq_id, list(value ORDER BY pos) AS vs FROM sq GROUP BY seq_id)
SELECT ks.seq_id, coalesce(length(list_reduce(list_transform(l.vs, lambda x: CAST(x AS VARCHAR)),
                                              lambda acc, x: acc || ',' || x, '')), 0) AS result
FROM ks LEFT JOIN l ON ks.seq_id = l.seq_id""")
def seq_fold_text_length(spark, sf):
    """The length of the text that a fold would have built."""
    from commitlens.operators.scan import fold_steps
    return fold_steps(q(spark, sf), order_keys(spark, sf),
                      lambda _: (F.length(F.col("value").cast("string")) + 1).cast("long"), lambda x, y: x + y,
                      lambda e: e, F.lit(0).cast("long"), block=3)


@register("seq_fold_one_sequence", W + """
SELECT list_reduce(list(value ORDER BY seq_id, pos), lambda acc, x: (acc * 31 + x) % 1000003, 7) AS result FROM sq""")
def seq_fold_one_sequence(spark, sf):
    """L18 over all items as one sequence, spread over blocks."""
    from commitlens.operators.ordered import global_row_number
    rows = global_row_number(q(spark, sf).withColumnRenamed("seq_id", "s"), ["s", "pos"], "at")
    one = rows.select(F.lit(0).alias("seq_id"), (F.col("at") - 1).alias("pos"), "value")
    return L.fold_affine(one, spark.range(1).select(F.lit(0).alias("seq_id")), 7, 31, modulus=1000003, block=4096).select(
        "result")


# Items of the nested lists by (order + position) % 4, as text patterns with %s for the value.
_NESTS = ["%s", "[%s,[%s]]", "[[[%s]],[]]", "[%s,[],[[%s,[%s]]]]"]
_NEST_SQL = " ".join(f"WHEN {k} THEN replace('{x}', '%s', CAST(value AS VARCHAR))" for k, x in enumerate(_NESTS))


@register("seq_flatten_any", "WITH RECURSIVE " + ORACLE_CTE + f"""
, t AS (SELECT seq_id, '[' || string_agg(CASE (seq_id + pos) % 4 {_NEST_SQL} END, ',' ORDER BY pos) || ']' AS j
        FROM sq GROUP BY seq_id),
r(seq_id, path, v) AS (
  SELECT seq_id, CAST([] AS BIGINT[]), CAST(j AS JSON) FROM t
  UNION ALL
  SELECT seq_id, list_append(path, i), json_extract(v, '$[' || i || ']')
  FROM (SELECT *, unnest(range(json_array_length(v)::BIGINT)) AS i FROM r WHERE json_type(v) = 'ARRAY'))
SELECT seq_id, row_number() OVER (PARTITION BY seq_id ORDER BY path) - 1 AS pos, CAST(v AS BIGINT) AS value
FROM r WHERE json_type(v) <> 'ARRAY'""")
def seq_flatten_any(spark, sf):
    """L17 on lists of mixed depth."""
    from commitlens.operators.ordered import row_number_within
    kind = (F.col("seq_id") + F.col("pos")) % 4
    item = F.coalesce(*[F.when(kind == k, F.replace(F.lit(x), F.lit("%s"), F.col("value").cast("string")))
                        for k, x in enumerate(_NESTS)])
    items = F.transform(F.array_sort(F.collect_list(F.struct("pos", item.alias("t")))), lambda s: s["t"])
    lists = quantities(spark, sf).groupBy("seq_id").agg(
        F.parse_json(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))).alias("items"))
    flat = L.flatten_any(lists)
    numbered = row_number_within(flat, ["seq_id"], ["path"], F.expr("get(path, 0) div 65536"), name="rn")
    return numbered.select("seq_id", (F.col("rn") - 1).alias("pos"), F.expr("variant_get(value, '$', 'bigint')").alias("value"))


@register("seq_zip", W + """
SELECT a.seq_id, a.pos, a.value AS left_value, b.value AS right_value FROM co a JOIN ev b
  ON a.seq_id = b.seq_id AND a.pos = b.pos""")
def seq_zip(spark, sf):
    return L.zip_sequences(customer_orders(spark, sf), event_types(spark, sf))


@register("seq_passing_students", W + """
SELECT count(*) AS n_passing FROM (SELECT seq_id FROM sq GROUP BY seq_id
                                   HAVING avg(value % 11) >= 5.75 AND min(value % 11) >= 4)""")
def seq_passing_students(spark, sf):
    g = q(spark, sf).withColumn("value", F.col("value") % 11)
    return L.passing_students(g)


@register("seq_fizzbuzz_labels", W + """
SELECT CASE WHEN value % 15 = 0 THEN 'FizzBuzz' WHEN value % 3 = 0 THEN 'Fizz' WHEN value % 5 = 0 THEN 'Buzz'
            ELSE CAST(value AS VARCHAR) END AS label, count(*) AS n FROM sq GROUP BY 1""")
def seq_fizzbuzz_labels(spark, sf):
    return label_counts(q(spark, sf), fizzbuzz("value"))


@register("events_traffic_labels", """
WITH t AS (SELECT (['green', 'orange', 'red', 'blue'])[user_id % 4 + 1] AS status, hour(ts) % 6 AS time FROM events)
SELECT CASE WHEN status = 'green' THEN false WHEN status = 'orange' AND time <= 3 THEN false
            WHEN status = 'orange' THEN true WHEN status = 'red' THEN true ELSE false END AS fined,
       CASE WHEN status = 'green' THEN 'ok: nothing wrong here' WHEN status = 'orange' AND time <= 3 THEN 'ok: we allow it'
            WHEN status = 'orange' THEN 'ok: too late' WHEN status = 'red' THEN 'ok: waaay too late'
            ELSE 'ERROR: (' || status || ',' || CAST(time AS VARCHAR) || ')' END AS reason,
       count(*) AS n
FROM t GROUP BY 1, 2""")
def events_traffic_labels(spark, sf):
    ev = table(spark, sf, "events")
    status = F.element_at(F.array(*[F.lit(s) for s in ["green", "orange", "red", "blue"]]),
                          (F.col("user_id") % 4 + 1).cast("int"))
    t = ev.select(traffic_light_rule(status, F.hour("ts") % 6).alias("r"))
    return t.groupBy(F.col("r.fined").alias("fined"), F.col("r.reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("n"))
