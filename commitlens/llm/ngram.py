"""Operator 7, language-model scores from Elias-Fano n-gram tries.

The model is a bigram with a Dirichlet prior on the unigram (MacKay and Peto, 1995), which is a probability for every
context: ``p(w|v) = (c(v,w) + mu * q(w)) / (c(v) + mu)`` with ``q(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1))``. Its log
splits into a part that only the trie of ``w`` knows (``c(v,w)``, ``c(w)``) and one that only the trie of ``v`` knows
(``c(v)``), so the model never has to be in one place:

1. Training counts of all words, by partial aggregation; ``N`` and ``V`` are one row.
2. Blocks of documents send their (word, context, document) counts, packed, to the shards of the word. The number of
   shards follows the number of tokens; a word with more than half a shard's tokens is dealt over several by context.
3. A shard builds its trie from the training documents: level 1 holds its words, level 2 the contexts of each word as
   an Elias-Fano sequence made monotone by adding the last value of the word before, found over Elias-Fano pointers.
   Log numerators are quantised. All levels are memory-mapped. Every (word, context) of the shard's documents, sorted,
   is looked up by successor search inside its word's range; sums per document go back to the block.
4. The sums of a block meet, and each document gets its row.

Words are 64-bit hashes of their bytes; the start of a text is the context of its first token. One (word, context) pair
is never split over shards: it is at most one entry per document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import (arrow_map, binary_texts, byte_chunks, flat_words, landed, mix, stream_groups,
                                   word_hashes)
from commitlens.llm.eliasfano import EliasFano, Quantised

BLOCK_BYTES = 12 << 20
SHARD_TOKENS = 3_000_000
MU = 100.0
#: No word holds a line break, so these two stand for the end and the start of a text.
END, START = word_hashes([b"\n", b"\n\n"])
TYPES = (np.uint8, np.uint16, np.uint32, np.uint64)


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers in the narrowest type that holds them, compressed."""
    top = int(values.max()) if len(values) else 0
    kind = next(i for i, t in enumerate(TYPES) if top <= np.iinfo(t).max)
    raw = values.astype(TYPES[kind]).tobytes()
    return bytes([kind]) + len(raw).to_bytes(4, "little") + bytes(pa.compress(raw, "zstd", asbytes=True))


def unpack(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[5:], int.from_bytes(data[1:5], "little"), "zstd", asbytes=True)
    return np.frombuffer(raw, TYPES[data[0]])


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of texts, each with its end; each token's document; each document's number of tokens."""
    words, bounds = flat_words(texts)
    sizes = np.diff(bounds) + 1
    doc = np.repeat(np.arange(len(texts)), sizes)
    tokens = np.full(len(words) + len(texts), END, np.uint64)
    inner = np.ones(len(tokens), bool)
    inner[np.cumsum(sizes) - 1] = False
    tokens[inner] = word_hashes(words)
    return tokens, doc, sizes


def _with_split(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, held_out)``; a null id counts as an empty text."""
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                       (F.crc32(text_id) % 5 == 1).alias("held_out"))


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)``: training occurrences of every word hash, the end included."""
    def run(batches):
        for batch in batches:
            texts, held = binary_texts(batch.column(1)), batch.column(2).to_pylist()
            texts = [t for t, h in zip(texts, held) if not h]
            for a, b in byte_chunks(texts, BLOCK_BYTES):
                codes, words = pd.factorize(_tokens(texts[a:b])[0])
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(np.bincount(codes))],
                                                 names=["word", "n"])
    return (arrow_map(_with_split(docs), run, "word long, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _runs(x: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)


def _block_rows(texts, held, ids, block, shards, hot, hot_parts):
    """Rows ``(shard, block, parts)`` of one block of documents."""
    tokens, doc, sizes = _tokens(texts)
    context = np.append(np.uint64(0), tokens[:-1])
    context[np.cumsum(sizes) - sizes] = START
    codes, names = pd.factorize(np.concatenate([tokens, context]), sort=True)
    w, c = codes[:len(tokens)].astype(np.int64), codes[len(tokens):].astype(np.int64)
    # One sort of (word, context, document); the three numbers fit 63 bits for blocks of this size.
    key = np.sort((w * len(names) + c) * len(texts) + doc)
    at = _runs(key)
    times = np.diff(np.append(at, len(key)))
    pair, doc = key[at] // len(texts), key[at] % len(texts)
    w, c = pair // len(names), pair % len(names)
    place = mix(names)
    parts = np.ones(len(names), np.uint64)
    if len(hot):
        spot = np.minimum(np.searchsorted(hot, names), len(hot) - 1)
        parts = np.where(hot[spot] == names, hot_parts[spot], 1).astype(np.uint64)
    shard = ((place[w] % np.uint64(shards)) + (mix(place[c]) % parts[w])) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    w, c, doc, times, shard = w[order], c[order], doc[order], times[order], shard[order].astype(np.int64)
    cuts = np.append(_runs(shard), len(shard))
    chief = int(mix(np.array([block], np.uint64))[0] % np.uint64(len(cuts) - 1))
    flags = np.packbits(np.array(held, bool))
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        pairs = _runs(w[a:b] * len(names) + c[a:b])
        own_w, own_c = w[a:b][pairs], c[a:b][pairs]
        words = _runs(own_w)
        seen, index = np.unique(own_c, return_inverse=True)
        more = [b"", b""]
        if i == chief:
            more = [pa.array(ids, pa.int64()).fill_null(0).to_numpy().tobytes() + np.packbits(
                np.array([x is None for x in ids], bool)).tobytes(), pack(sizes)]
        yield int(shard[a]), block, [
            pack(names[own_w[words]]), pack(np.diff(np.append(words, len(own_w)))), pack(names[seen]), pack(index),
            pack(np.diff(np.append(pairs, b - a))), pack(doc[a:b]), pack(times[a:b]),
            len(texts).to_bytes(4, "little") + flags.tobytes(), *more]


def _blocks(docs: DataFrame, shards: int, hot: list[tuple[int, int]]) -> DataFrame:
    hot_words = np.array([h for h, _ in hot], np.int64).view(np.uint64)
    order = np.argsort(hot_words)
    hot_words, hot_parts = hot_words[order], np.array([p for _, p in hot], np.int64)[order]

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts, held = batch.column(0).to_pylist(), binary_texts(batch.column(1)), batch.column(2).to_pylist()
            for a, b in byte_chunks(texts, BLOCK_BYTES):
                shard, block, parts = zip(*_block_rows(texts[a:b], held[a:b], ids[a:b], number, shards, hot_words,
                                                       hot_parts))
                number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), pa.array(block, pa.int64()), pa.array(parts, pa.list_(pa.binary()))],
                    names=["shard", "block", "parts"])
    return arrow_map(_with_split(docs), run, "shard int, block long, parts array<binary>")


class Trie:
    """A shard's trie: words on level 1, their contexts on level 2, quantised log10 numerators."""

    def __init__(self, word: np.ndarray, context: np.ndarray, count: np.ndarray, prior: np.ndarray, top: float):
        """Training pairs in order of (word, context), as indexes; ``prior[word]`` is ``mu * q(word)``. Numerators lie
        between 0 (a pair seen once) and ``top``, the same for all shards."""
        starts = _runs(word)
        self.words = word[starts]
        ends = np.append(starts[1:], len(word))
        last = context[ends - 1] if len(word) else context[:0]
        base = np.append(0, np.cumsum(last + 1)[:-1]) if len(word) else last
        self.pointers = EliasFano(np.append(starts, len(word)))
        self.contexts = EliasFano(context + np.repeat(base, ends - starts))
        self.values = Quantised(np.log10(count + prior[word]), 0.0, top)

    def look_up(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Log10 numerators of pairs in order of (word, context); NaN where the pair was not seen in training."""
        out = np.full(len(word), np.nan)
        if not len(self.words):
            return out
        spot = np.searchsorted(self.words, word)
        asked = np.flatnonzero(self.words[np.minimum(spot, len(self.words) - 1)] == word)
        spot, context = spot[asked], context[asked]
        rows, row = np.unique(spot, return_inverse=True)
        begin, end = self.pointers.take(rows), self.pointers.take(rows + 1)
        final = self.contexts.take(end - 1)
        base = np.where(begin > 0, self.contexts.take(np.maximum(begin - 1, 0)) + 1, 0)
        inside = base[row] + context <= final[row]
        asked, row, wanted = asked[inside], row[inside], (base[row] + context)[inside]
        at = self.contexts.find(wanted)
        hit = (at >= begin[row]) & (at < end[row])
        hit[hit] = self.contexts.take(at[hit]) == wanted[hit]
        out[asked[hit]] = self.values.take(at[hit])
        return out


def _score_shard(group: pa.Table, n_tokens: int, n_words: int, hot: dict[int, int], mu: float) -> pa.RecordBatch:
    """Sums per document of one shard: ``(block, parts)``. A document's pairs are added in order of their hashes, so its
    sum does not depend on which block holds it."""
    blocks, parts = group.column("block").to_pylist(), group.column("parts").to_pylist()
    per = []
    for i in range(len(blocks)):
        words, pairs, contexts, index, entries, doc, times = (unpack(p) for p in parts[i][:7])
        head = parts[i][7]
        n_docs = int.from_bytes(head[:4], "little")
        held = np.unpackbits(np.frombuffer(head, np.uint8, offset=4))[:n_docs].astype(bool)
        starts = np.concatenate([[0], np.cumsum(entries, dtype=np.int64)[:-1]])
        trained = np.add.reduceat(np.where(held[doc], 0, times).astype(np.int64), starts)
        per.append((words.astype(np.uint64), pairs, contexts.astype(np.uint64)[index], entries, doc, times, trained,
                    n_docs))
    words, word_of = np.unique(np.concatenate([np.repeat(p[0], p[1]) for p in per]), return_inverse=True)
    contexts, context_of = np.unique(np.concatenate([p[2] for p in per]), return_inverse=True)
    key, pair_of = np.unique(word_of * len(contexts) + context_of, return_inverse=True)
    word, context = key // len(contexts), key % len(contexts)
    trained = np.bincount(pair_of, np.concatenate([p[6] for p in per]), len(key))
    count = np.bincount(word, trained, len(words))
    for i, w in enumerate(words.view(np.int64).tolist()) if hot else ():
        count[i] = hot.get(w, count[i])
    q = (count + 0.5) / (n_tokens + 0.5 * (n_words + 1))
    seen = trained > 0
    trie = Trie(word[seen], context[seen], trained[seen], mu * q, float(np.log10(n_tokens + mu)))
    numerator = trie.look_up(word, context)
    numerator = np.where(np.isnan(numerator), np.log10(mu * q)[word], numerator)
    gain = (numerator - np.log10(count + mu)[word])[pair_of]
    plain, known = np.log10(q)[word][pair_of], (count > 0)[word][pair_of]
    out_parts, at = [], 0
    for i, (_, _, contexts_i, entries, doc, times, _, n_docs) in enumerate(per):
        mine = np.repeat(np.arange(at, at + len(contexts_i)), entries)
        at += len(contexts_i)
        base, score, hits = (np.bincount(doc, times * x[mine], n_docs) for x in (plain, gain, known))
        out_parts.append([base.tobytes(), score.tobytes(), pack(hits.astype(np.int64)),
                          parts[i][8], parts[i][9]])
    return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(out_parts, pa.list_(pa.binary()))],
                                      names=["block", "parts"])


def _finish_block(group: pa.Table, n_tokens: int) -> pa.RecordBatch:
    """Scores of a block's documents. The shards' parts are added in order of size, whatever order they came in."""
    plains, gains, known = [], [], 0
    for plain, gain, hits, head, tokens in group.column("parts").to_pylist():
        plains.append(np.frombuffer(plain))
        gains.append(np.frombuffer(gain))
        known = known + unpack(hits).astype(np.int64)
        if tokens:
            sizes = unpack(tokens)
            ids = np.frombuffer(head, np.int64, len(sizes))
            null = np.unpackbits(np.frombuffer(head, np.uint8, offset=8 * len(sizes)))[:len(sizes)].astype(bool)
    base, score = (np.sort(np.stack(x), axis=0).sum(axis=0) for x in (plains, gains))
    n = len(sizes)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64(), mask=null), pa.array(sizes, pa.int64()),
         pa.array(known), pa.array([n_tokens] * n, pa.int64()), pa.array(base), pa.array(score)],
        names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def language_scores(docs: DataFrame, mu: float = MU, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row per input row.

    Null or empty text: the end is its only token. A null id belongs to the training part. Repeated rows count and are
    scored one by one. Without training rows N and V are 0 and every token is unknown. Other columns are ignored.
    """
    counts = landed(word_counts(docs), "words")
    row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_tokens, n_words = int(row["n"]), int(row["v"])
    shards = max(1, -(-n_tokens * 5 // (4 * shard_tokens)))
    # At most 2 * shards words can have that many training tokens.
    hot = [(int(r["word"]), int(r["n"])) for r in counts.where(F.col("n") > shard_tokens // 2).collect()]
    parts = [(w, min(shards, -(-n * 2 // shard_tokens))) for w, n in hot]
    hot_counts = dict(hot)
    dealt = _blocks(docs, shards, parts).repartitionById(shards, "shard").sortWithinPartitions("shard", "block")
    sums = arrow_map(dealt, lambda batches: stream_groups(
        batches, ["shard"], lambda _, g: _score_shard(g, n_tokens, n_words, hot_counts, mu)),
        "block long, parts array<binary>")
    rows = arrow_map(sums.repartition("block").sortWithinPartitions("block"), lambda batches: stream_groups(
        batches, ["block"], lambda _, g: _finish_block(g, n_tokens)),
        "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return rows.withColumn("held_out", F.crc32(text_id) % 5 == 1).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
