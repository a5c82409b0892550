"""Helpers shared by the training-data operators: tables, shared scratch tables, hashing, grouped Arrow streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from commitlens.session import landed

__all__ = ["arrow_map", "binary_texts", "byte_chunks", "flat_words", "landed", "mix", "odd_constants", "quoted", "stream_groups",
           "table", "word_hashes"]

#: Bytes of an Arrow batch where the session sets none.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 6 << 20
#: Texts are tokenized in chunks of about this many bytes, so a task's memory does not grow with its batch.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column's name as part of a path, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` over batches bounded in bytes: texts differ widely in length, and the default of 64 MB a batch is
    held several times over by the task and its Python worker. A limit that the session sets itself stands."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_CONF, None) is None:
        conf.set(BATCH_CONF, str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def binary_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def byte_chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes (a longer text is a range of its own)."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def flat_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Words (maximal runs outside 0x20 and 0x09-0x0D, ASCII letters lower-cased) of all texts, and each text's
    offsets into them. ``bytes.split`` and ``bytes.lower`` know exactly these characters."""
    words: list[bytes] = []
    bounds = np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        words += t.lower().split()
        bounds[i + 1] = len(words)
    return words, bounds


def word_hashes(words: list[bytes] | list[str]) -> np.ndarray:
    """64-bit hash per word, the same in every process."""
    if not words:
        return np.zeros(0, np.uint64)
    boxed = np.empty(len(words), object)
    boxed[:] = words
    return pd.util.hash_array(boxed, categorize=True)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply) over uint64 arrays."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def odd_constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)


def stream_groups(batches: Iterator[pa.RecordBatch], keys: list[str],
                  fn: Callable[[tuple, pa.Table], pa.RecordBatch | None]) -> Iterator[pa.RecordBatch]:
    """Call ``fn(key, rows)`` for each run of equal keys in a partition sorted by ``keys``; one group in memory."""
    pending: list[pa.Table] = []
    current: tuple | None = None

    def flush():
        if pending:
            out = fn(current, pa.concat_tables(pending))
            if out is not None and out.num_rows:
                yield out

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        frame = rows.select(keys).to_pandas()
        change = (frame != frame.shift()).any(axis=1).to_numpy()
        change[0] = True
        starts = np.append(np.flatnonzero(change), batch.num_rows)
        for a, b in zip(starts[:-1], starts[1:]):
            key = tuple(frame.iloc[a])
            if key != current:
                yield from flush()
                pending, current = [], key
            pending.append(rows.slice(a, b - a))
    yield from flush()
