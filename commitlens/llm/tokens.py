"""Operator 5, token counts: batch encoding in Arrow functions that return lengths only.

The tokenizer drops white space, no merge, normalisation or special token spans ASCII white space, so a text may be cut
there: its count is the sum of the counts of its pieces. Texts are cut at every such boundary; pieces not seen lately
are encoded in batches balanced by bytes, and a bounded memo holds the lengths of short ones.
"""

from __future__ import annotations

import os
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import arrow_map, binary_texts, byte_chunks

BATCH_BYTES = 1 << 16
MEMO_WORDS = 1 << 19
MEMO_BYTES = 64


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=2)
def _memo(path: str) -> dict[bytes, int]:
    return {}


def piece_lengths(pieces: list[bytes], path: str) -> list[int]:
    """Token counts of pieces, encoded in batches of about ``BATCH_BYTES``."""
    tokenizer, out = _tokenizer(path), []
    for a, b in byte_chunks(pieces, BATCH_BYTES):
        out += [len(e.ids) for e in tokenizer.encode_batch_fast([p.decode() for p in pieces[a:b]],
                                                               add_special_tokens=False)]
    return out


def count_tokens(texts: list[bytes], path: str) -> list[int]:
    """Tokens of each text."""
    memo, counts = _memo(path), []
    for a, b in byte_chunks(texts):
        split = [t.split() for t in texts[a:b]]
        new = list(set().union(*split).difference(memo))
        memo.update(zip(new, piece_lengths(new, path)))
        counts += [sum(map(memo.__getitem__, words)) for words in split]
        for w in new:
            if len(w) > MEMO_BYTES:
                del memo[w]
        if len(memo) > MEMO_WORDS:
            memo.clear()
    return counts


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per input row. Null or empty text: zero bytes and tokens. Rows are
    counted one by one; repeated rows, null ids and other columns need no rule."""
    def run(batches):
        for batch in batches:
            texts = binary_texts(batch.column(1))
            n = count_tokens(texts, tokenizer_path)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
