"""Operator 10, near-duplicate groups: fast similarity sketching, banding, exact verification.

A document's set holds its distinct 5-word shingles as 64-bit hashes (fewer words: the whole sequence as one; no words:
empty, linked with nothing). Documents with Jaccard similarity of at least ``percent``/100 are linked; the result is
each document's connected component.

1. *Sketch* (Dahlgaard, Knudsen, Thorup 2017): round ``i`` < t throws every shingle into a hashed bin with the value
   ``i + hash``; round ``t + b`` throws all of them into bin ``b``. A bin keeps its smallest value, so every one of the
   ``t`` coordinates fills, most of them in a few rounds.
2. Equal sets are one *node* (a digest of the set); copies never meet each other again.
3. *Banding* only proposes: nodes that share a band are joined to the band's smallest node (a star, no pairs), and the
   components of these stars are candidate clusters. With 8 rows and 60 bands a pair at similarity 0.85 shares no
   band with probability 5e-9; unlike pairs in a cluster only cost work.
4. *Exact verification* sees every pair in a cluster: a breadth-first search over full sets finds the links that
   connect it. A cluster whose sets exceed ``BLOCK_SHINGLES`` is cut into blocks and every pair of blocks is one group,
   so a group's memory is bounded and no link is lost. Links are spanning edges, never all pairs.
5. Components of the verified links; the smallest ``doc_id`` names each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import (arrow_map, binary_texts, byte_chunks, flat_words, landed, mix, odd_constants,
                                   stream_groups, word_hashes)
from commitlens.llm.components import connected_components

SHINGLE = 5
ROWS, BANDS = 8, 60
#: Shingles that one verification group may hold (8 bytes each).
BLOCK_SHINGLES = 1 << 20


def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for a, b in byte_chunks(texts):
        words, bounds = flat_words(texts[a:b])
        h = word_hashes(words)
        mult = odd_constants(k, 5)
        windows = np.zeros(0, np.uint64)
        if len(h) >= k:
            windows = sum(h[j:len(h) - k + 1 + j] * mult[j] for j in range(k))
            windows = mix(windows)
        for start, stop in zip(bounds[:-1], bounds[1:]):
            if stop - start >= k:
                yield np.unique(windows[start:stop - k + 1])
            elif stop > start:
                whole = (h[start:stop] * odd_constants(stop - start, 5)).sum() + np.uint64(stop - start)
                yield mix(np.array([whole], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketch: ``t`` values of a non-empty set. Later rounds never lower a filled bin, so running
    several rounds at once gives the same values as stopping at the first full one."""
    bins = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    at, step = 0, max(1, min(t, 2 * t // len(shingles)))
    while at < 2 * t and (bins == np.iinfo(np.uint64).max).any():
        stop = min(at + step, t if at < t else 2 * t)
        rounds = np.arange(at, stop, dtype=np.uint64)[:, None]
        h = mix(shingles[None, :] + rounds * np.uint64(0x9E3779B97F4A7C15))
        value = (rounds << np.uint64(40)) | (h >> np.uint64(24))
        if at < t:
            np.minimum.at(bins, ((h & np.uint64(0xFFFFFF)) % np.uint64(t)).astype(np.int64).ravel(), value.ravel())
        else:
            bins[at - t:stop - t] = np.minimum(bins[at - t:stop - t], value.min(axis=1))
        at = stop
    return bins


def band_keys(values: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` sketch values; the band's number is part of the key."""
    folded = (values.reshape(bands, rows) * odd_constants(rows, 7)).sum(axis=1, dtype=np.uint64)
    return mix(folded + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _found_again(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, spare)``; ``spare`` is a hash of the text."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.withColumn("spare", F.xxhash64("text"))


def signatures(docs: DataFrame, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """``(doc_id, spare, n_shingles, node, bands)`` per row; node and bands are null for an empty set. ``spare`` is a
    hash of the text: with the id it finds a row of that text again, also among rows that share an id or have none."""
    def run(batches):
        for batch in batches:
            ids, texts, spare = batch.column(0), binary_texts(batch.column(1)), batch.column(2)
            n, node, keys = [], [], []
            for s in shingle_sets(texts):
                n.append(len(s))
                node.append(_digest(s))
                keys.append(band_keys(sketch(s, rows * bands), rows, bands) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), spare, pa.array(n, pa.int64()), pa.array(node, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "spare", "n_shingles", "node", "bands"])
    return arrow_map(_found_again(docs),
        run, "doc_id long, spare long, n_shingles long, node binary, bands array<long>")


def candidate_clusters(classes: DataFrame) -> DataFrame:
    """``classes(node, bands)`` -> ``(spot, cluster)`` for nodes that share a band with another. ``spot`` is a 64-bit
    hash of the node; if two nodes had the same one, their clusters would merely merge."""
    keys = classes.select(F.xxhash64("node").alias("spot"), F.explode("bands").alias("key"))
    shared = (keys.groupBy("key").agg(F.min("spot").alias("low"), F.max("spot").alias("high"))
              .where("low < high").select("key", "low"))
    stars = keys.join(shared, "key").where("spot <> low").select(F.col("spot").alias("u"), F.col("low").alias("v"))
    return connected_components(stars).select(F.col("node").alias("spot"), F.col("label").alias("cluster"))


def _linked(group: pa.Table, percent: int) -> pa.RecordBatch | None:
    """Spanning links of one group: a breadth-first search that compares each reached set with all unreached ones."""
    nodes = group.column("node").to_pylist()
    first = {n: i for i, n in enumerate(nodes)}
    if len(first) < 2:
        return None
    picked = sorted(first.values())
    nodes = [nodes[i] for i in picked]
    raw = group.column("shingles")
    sets = [np.frombuffer(raw[i].as_buffer(), np.uint64) for i in picked]
    sizes = np.array([len(s) for s in sets])
    shingles, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    mine = [flat[a:b] for a, b in zip(starts[:-1], starts[1:])]
    mask = np.zeros(len(shingles), bool)
    left = np.arange(len(sets))
    out: list[tuple[int, int]] = []
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            fits = (100 * np.minimum(sizes[left], sizes[at]) >= percent * np.maximum(sizes[left], sizes[at]))
            near = left[fits]
            if not len(near):
                continue
            mask[mine[at]] = True
            joined = np.concatenate([mine[i] for i in near])
            edges = np.concatenate([[0], np.cumsum(sizes[near])[:-1]])
            both = np.add.reduceat(mask[joined].astype(np.int64), edges)
            mask[mine[at]] = False
            hit = near[100 * both >= percent * (sizes[near] + sizes[at] - both)]
            if len(hit):
                out += [(at, int(i)) for i in hit]
                queue += hit.tolist()
                left = left[~np.isin(left, hit)]
    if not out:
        return None
    return pa.RecordBatch.from_arrays([pa.array([nodes[a] for a, _ in out], pa.binary()),
                                       pa.array([nodes[b] for _, b in out], pa.binary())], names=["u", "v"])


def verified_links(docs: DataFrame, members: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """``members(node, rep, spare, cluster, n_shingles)`` -> links ``(u, v)`` that connect what is linked in each
    cluster. One row of each class is read again: rows of one id and text arrive side by side, and the first stands for
    all, so a group holds distinct sets whatever the number of copies."""
    weight = members.groupBy("cluster").agg(F.sum("n_shingles").alias("weight"))
    placed = members.join(weight, "cluster").select(
        "node", F.col("rep").isNull().alias("unnamed"), F.coalesce("rep", F.lit(0)).alias("key"), "spare", "cluster",
        F.ceil(F.col("weight") * 2 / F.lit(block_shingles)).cast("int").alias("blocks"))

    def run(batches):
        last = None
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            fresh = pa.array([i for i, n in enumerate(nodes) if n != (nodes[i - 1] if i else last)], pa.int64())
            last = nodes[-1] if nodes else last
            rows = pa.Table.from_batches([batch]).take(fresh)
            sets = list(shingle_sets(binary_texts(rows.column("text"))))
            keep = pa.array([i for i, (s, n) in enumerate(zip(sets, rows.column("node").to_pylist()))
                             if _digest(s) == n], pa.int64())
            yield from pa.table({
                "cluster": rows.column("cluster").take(keep), "blocks": rows.column("blocks").take(keep),
                "node": rows.column("node").take(keep),
                "shingles": pa.array([sets[i].tobytes() for i in keep.to_pylist()], pa.binary())}).to_batches()

    # A sort-merge join at every size: the members grow with the documents, so broadcasting a few would not carry over.
    texts = _found_again(docs).select(F.col("doc_id").isNull().alias("unnamed"),
                                      F.coalesce("doc_id", F.lit(0)).alias("key"), "spare", "text")
    texts = texts.join(placed.hint("merge"), ["spare", "key", "unnamed"]).select("cluster", "blocks", "node", "text")
    sets = arrow_map(texts, run, "cluster long, blocks int, node binary, shingles binary")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = F.when(F.col("blocks") <= 1, F.array(F.struct(F.lit(0).alias("p"), F.lit(0).alias("q")))).otherwise(
        F.transform(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("mine")),
                    lambda b: F.struct(F.least(b, "mine").alias("p"), F.greatest(b, "mine").alias("q"))))
    dealt = (sets.withColumn("mine", mine).select("cluster", F.explode(pairs).alias("b"), "node", "shingles")
             .select("cluster", "b.p", "b.q", "node", "shingles")
             .repartition("cluster", "p", "q").sortWithinPartitions("cluster", "p", "q"))
    return arrow_map(dealt,
        lambda batches: stream_groups(batches, ["cluster", "p", "q"], lambda _, g: _linked(g, percent)),
        "u binary, v binary")


def near_duplicates(docs: DataFrame, percent: int = 85, rows: int = ROWS, bands: int = BANDS,
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> ``(doc_id, n_shingles, component_id, kept)``, one row per input row.

    Null or wordless text: ``n_shingles`` 0, its own component, kept. Repeated rows of one ``doc_id`` are each returned
    and judged by their own text. A null ``doc_id`` takes part; its component is the smallest id known, or null.
    Other columns, whatever their names, are ignored.
    """
    drawn = landed(signatures(docs, rows, bands), "sketches")
    classes = drawn.where("node is not null").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "spare")).alias("first"),
        F.max("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    classes = landed(classes.select("node", F.col("first.doc_id").alias("rep"), F.col("first.spare").alias("spare"),
                                    "n_shingles", "bands"), "classes")
    spots = candidate_clusters(classes)
    members = landed(classes.select("node", "rep", "spare", "n_shingles", F.xxhash64("node").alias("spot"))
                     .join(spots, "spot").select("node", "rep", "spare", "n_shingles", "cluster"), "members")
    links = connected_components(verified_links(docs, members, percent, block_shingles))
    ids = classes.select("node", "rep")
    linked = ids.join(links, "node")
    lowest = linked.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = linked.join(lowest, "label").select("node", "component_id")
    named = ids.join(named, "node", "left").select("node", F.coalesce("component_id", "rep").alias("component_id"))
    return (drawn.select("doc_id", "n_shingles", "node").join(named, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())))
