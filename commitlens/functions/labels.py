"""Label each row by the first matching rule, then count per label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["first_match", "label_counts", "fizzbuzz", "traffic_light_rule", "size_label"]


def first_match(rules: Sequence[tuple[Column, Column | str]], default: Column | str) -> Column:
    """Chained CASE WHEN: the label of the first rule whose condition holds, else ``default``."""
    expr = None
    for cond, label in rules:
        lab = label if isinstance(label, Column) else F.lit(label)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)


def label_counts(df: DataFrame, label: Column, name: str = "label") -> DataFrame:
    """``label -> n`` (partial + final hash aggregate; the label domain is tiny)."""
    return df.select(label.alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def fizzbuzz(n: str | Column) -> Column:
    """Divisibility labels: FizzBuzz / Fizz / Buzz / the number itself."""
    x = F.col(n) if isinstance(n, str) else n
    return first_match([((x % 3 == 0) & (x % 5 == 0), "FizzBuzz"), (x % 3 == 0, "Fizz"), (x % 5 == 0, "Buzz")],
                       x.cast("string"))


def traffic_light_rule(status: str | Column, time: str | Column) -> Column:
    """Traffic-light penalty rule: struct(fined, reason); anything unmatched is an ERROR label."""
    s = F.col(status) if isinstance(status, str) else status
    t = F.col(time) if isinstance(time, str) else time
    # The reason texts of the rule.
    fined = first_match([(s == "green", F.lit(False)), ((s == "orange") & (t <= 3), F.lit(False)),
                         ((s == "orange") & (t > 3), F.lit(True)), (s == "red", F.lit(True))], F.lit(False))
    reason = first_match([(s == "green", "ok: nothing wrong here"), ((s == "orange") & (t <= 3), "ok: we allow it"),
                          ((s == "orange") & (t > 3), "ok: too late"), (s == "red", "ok: waaay too late")],
                         F.concat(F.lit("ERROR: ("), F.coalesce(s, F.lit("null")), F.lit(","),
                                  F.coalesce(t.cast("string"), F.lit("null")), F.lit(")")))
    return F.struct(fined.alias("fined"), reason.alias("reason"))


def size_label(changes: str | Column, limit: int = 20) -> Column:
    """Small (0 <= x <= limit) / large (x > limit) commit."""
    x = F.col(changes) if isinstance(changes, str) else changes
    return F.when(x > limit, "large").otherwise("small")
