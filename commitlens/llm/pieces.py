"""Operator 8, SentencePiece encoding and decoding: an Aho-Corasick automaton drives a single-pass Viterbi.

The automaton holds every normal piece. It reads a text once; at each position it reports, over its output links, all
pieces that end there (longest first), and each relaxes the best score of that position. A character that no piece
covers is encoded as its UTF-8 byte pieces, at a cost below every piece. Among equal scores the longest last piece wins.

White space becomes U+2581 and a dummy prefix is put in front, as the model file says. A U+2581 that stands in the text
itself is encoded as bytes, so decoding is exact for every text. No piece of such a model holds U+2581 after another
character, nor a line break (checked when the model is read), so the best path of a text is the concatenation of the
best paths of its words, and a bounded memo of words replaces most of the work.
"""

from __future__ import annotations

import array
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import arrow_map, byte_chunks

SPACE = "▁"
#: Stands for a U+2581 of the text while it is encoded; no text that Spark holds has a lone surrogate.
LITERAL = "\udc81"
MEMO_WORDS = 1 << 18
MEMO_LENGTH = 64


class PieceCodec:
    """Encoder and decoder of one model file, built once per Python worker."""

    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.byte_ids = [0] * 256
        self.surface: list[bytes] = [b""] * size
        self.automaton = ahocorasick.Automaton()
        self.single: set[str] = set()
        self.is_byte = np.zeros(size, bool)
        lowest, crossing = 0.0, False
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value], self.surface[i] = i, bytes([value])
                self.is_byte[i] = True
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.automaton.add_word(piece, (len(piece), model.get_score(i), i))
                self.surface[i] = piece.replace(SPACE, " ").encode()
                crossing |= SPACE in piece.lstrip(SPACE) or "\n" in piece
                if len(piece) == 1:
                    self.single.add(piece)
                lowest = min(lowest, model.get_score(i)) if model.get_score(i) > -1e8 else lowest
        self.automaton.make_automaton()
        self.unknown_cost = lowest - 10.0
        self.words = re.compile("(?s).+" if crossing else f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
        self.memo: dict[str, bytes] = {}

    def best_path(self, s: str) -> list[int]:
        """Ids of the best-scoring segmentation of an escaped string."""
        n = len(s)
        best = [float("-inf")] * (n + 1)
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        best[0] = 0.0
        bare = [i for i, c in enumerate(s) if c not in self.single]
        at = 0
        for end, (length, score, piece) in self.automaton.iter(s):
            while at < len(bare) and bare[at] <= end:
                i, at = bare[at], at + 1
                if best[i] + self.unknown_cost > best[i + 1]:
                    best[i + 1], back[i + 1] = best[i] + self.unknown_cost, (i, -1)
            start = end + 1 - length
            if best[start] + score > best[end + 1]:
                best[end + 1], back[end + 1] = best[start] + score, (start, piece)
        for i in bare[at:]:
            if best[i] + self.unknown_cost > best[i + 1]:
                best[i + 1], back[i + 1] = best[i] + self.unknown_cost, (i, -1)
        ids: list[int] = []
        while n:
            start, piece = back[n]
            if piece < 0:
                raw = SPACE if s[start:n] == LITERAL else s[start:n]
                ids += [self.byte_ids[b] for b in reversed(raw.encode())]
            else:
                ids.append(piece)
            n = start
        return ids[::-1]

    def encode(self, text: str) -> bytes:
        """Ids of a text as packed little-endian 32-bit integers; an empty text has none."""
        if not text:
            return b""
        out = []
        escaped = SPACE + (text.replace(SPACE, LITERAL) if SPACE in text else text).replace(" ", SPACE)
        for word in self.words.findall(escaped):
            ids = self.memo.get(word)
            if ids is None:
                ids = array.array("i", self.best_path(word)).tobytes()
                if len(word) <= MEMO_LENGTH:
                    if len(self.memo) >= MEMO_WORDS:
                        self.memo.clear()
                    self.memo[word] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of packed ids, without the dummy prefix."""
        text = b"".join(map(self.surface.__getitem__, memoryview(ids).cast("i")))
        return text[1:] if text[:1] == b" " else text


@lru_cache(maxsize=2)
def codec(model_path: str) -> PieceCodec:
    return PieceCodec(model_path)


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_pieces, ids)`` per input row. Null or empty text: no pieces. Rows are encoded one by one, so
    repeated rows, null ids and any other columns need no rule; whole texts, whatever their length."""
    def run(batches):
        c = codec(model_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in byte_chunks(texts_of(texts)):
                packed = [c.encode(t or "") for t in texts[a:b]]
                sizes = pa.array([0, *_running([len(p) // 4 for p in packed])], pa.int32())
                flat = pa.Array.from_buffers(pa.int32(), sizes[-1].as_py(), [None, pa.py_buffer(b"".join(packed))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(p) // 4 for p in packed], pa.int64()),
                     pa.ListArray.from_arrays(sizes, flat)], names=["doc_id", "n_pieces", "ids"])
    return arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")),
        run, "doc_id long, n_pieces long, ids array<int>")


def decode_pieces(coded: DataFrame, model_path: str) -> DataFrame:
    """``coded(doc_id, ids)`` -> ``(doc_id, text)``; null ids decode to an empty text."""
    def run(batches):
        c = codec(model_path)
        for batch in batches:
            ids = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c.decode(array.array("i", x or []).tobytes()).decode() for x in ids],
                                           pa.string())], names=["doc_id", "text"])
    return arrow_map(coded.select(F.col("doc_id").cast("long"), "ids"), run, "doc_id long, text string")


def round_trips(docs: DataFrame, model_path: str) -> DataFrame:
    """Encode and decode in one pass: ``(doc_id, n_pieces, n_byte_pieces, ids_sha256, text_sha256, round_trip)``.
    ``ids_sha256`` is over the packed ids, ``text_sha256`` over the decoded text; a null text counts as empty."""
    def run(batches):
        c = codec(model_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = []
            for t in texts:
                ids = c.encode(t or "")
                back = c.decode(ids)
                rows.append((len(ids) // 4, int(c.is_byte[np.frombuffer(ids, np.int32)].sum()),
                             hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest(),
                             back == (t or "").encode()))
            n, raw, ids_sha, text_sha, same = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(raw, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_pieces", "n_byte_pieces", "ids_sha256", "text_sha256", "round_trip"])
    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        run, "doc_id long, n_pieces long, n_byte_pieces long, ids_sha256 string, text_sha256 string, "
             "round_trip boolean")


def texts_of(texts: list[str | None]) -> list[str]:
    return [t or "" for t in texts]


def _running(sizes: list[int]) -> list[int]:
    out, at = [], 0
    for n in sizes:
        at += n
        out.append(at)
    return out
