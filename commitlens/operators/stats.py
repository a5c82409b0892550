"""Column summary (A19) and deterministic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary(df: DataFrame, column: str) -> DataFrame:
    """Count / mean / sample stddev / min / max of one column, as one row of numbers.

    Same figures as ``df.describe(column)`` but typed; all five are mergeable aggregates (one pass, partial+final).
    """
    c = F.col(column)
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"),
                  F.min(c).alias("min"), F.max(c).alias("max"))


def sample_rows(df: DataFrame, fraction: float, seed: int = 0, key: str | None = None,
                hash: str = "xxhash64") -> DataFrame:
    """A deterministic row sample.

    Without ``key`` this is Spark's Bernoulli ``sample`` (depends on the partition layout, as the reference's does).
    With ``key`` a row is kept when a hash of (seed, key) falls under the fraction: the same rows whatever the
    partitioning, cluster size or retry. ``hash="md5"`` uses the low 20 bits of the first 32 bits of
    ``md5('<seed>:<key>')``, which other engines can reproduce exactly (slower than ``xxhash64``).
    """
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    buckets = 1 << 20
    if hash == "md5":
        digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
        h = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets))
    elif hash == "xxhash64":
        h = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(buckets))
    else:
        raise ValueError("hash must be 'xxhash64' or 'md5'")
    return df.where(h < F.lit(int(fraction * buckets)))
