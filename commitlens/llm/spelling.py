"""Spelling variants: words one edit apart, the common form of each word, and the root its forms lead to.

Words are maximal runs of Latin letters, counted over all texts; a seeded error (a checksum of document and run) takes one
character out of some runs. The counted vocabulary is searched by :mod:`editscan`: dynamic programming over a sorted list
that reuses the rows of shared prefixes and skips ranges that already exceed one edit.

To spread the scan, a word goes to a list for each place its edit can be in. One edit leaves either what stands before it
or what stands behind it as it is, so with the shorter word's ``m`` characters cut into two segments, two near words share
all characters outside the segment ``[i, j)`` that holds the edit; that shared part is the list's key, and only the free
part within is scanned. A pair is reported by exactly one list: the segment that holds the end of the free parts' common
prefix. A list with too many words is cut again: its segment is halved, which gives longer keys and shorter lists, down to
one free character, where a list can only hold as many words as the alphabet allows. So no list, and no task, grows with the
vocabulary, no pair is lost, and pairs are not shuffled: a list sends one row for each word that has neighbours in it.

Results for odd input: null and empty texts have no words; a null doc_id is an empty string before the colon; repeated rows
count again; words of any length are handled; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
Everything between the steps is written to the shared folder.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import arrow_map, binary_texts, landed
from commitlens.llm.editscan import code_points, one_edit_pairs

#: Fixed values of the definition: letters A-Z a-z and U+00C0 to U+00FF (two UTF-8 bytes, the first of them 0xC3).
LEAST_CHARS, LEAST_COUNT, TIMES, NOISE = 7, 2, 10, 31
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf]){%d,}" % LEAST_CHARS)

#: Words counted in a task before it sends what it has.
COUNTER_WORDS = 1 << 18
#: A list above these is cut again.
LIST_ROWS, LIST_CHARS = 2048, 1 << 18
#: Cells of a padded block of lists that are scanned together, and rows of it.
BLOCK_CELLS, BLOCK_ROWS = 1 << 20, 1 << 14


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def out():
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), binary_texts(batch.column("text"))):
            head = zlib.crc32(b"" if doc is None else str(doc).encode())
            head = zlib.crc32(b":", head)
            # The error is the same for every occurrence in the document.
            for run, times in Counter(RUN.findall(text.lower())).items():
                h = zlib.crc32(run, head)
                if h % NOISE == 0:
                    letters = run.decode()
                    at = h % len(letters)
                    if len(letters) <= LEAST_CHARS:
                        continue
                    run = (letters[:at] + letters[at + 1:]).encode()
                counts[run] += times
            if len(counts) > COUNTER_WORDS:
                yield out()
                counts.clear()
    yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``(word, n)``: distinct words of at least 7 characters and 2 occurrences over all documents."""
    words = arrow_map(docs.select("doc_id", "text"), _count_words, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _keyed(rows: DataFrame) -> DataFrame:
    """``(h, key, free, word, n, m, i, j)`` of rows ``(word, n, m, i, j)``: ``key`` is what lies outside the segment."""
    tail = F.expr("m - j")
    size = F.length("word")
    key = F.concat_ws("|", "m", "i", "j", F.expr("substring(word, 1, i)"),
                      F.col("word").substr(size - tail + 1, tail))
    free = F.col("word").substr(F.col("i") + 1, size - F.col("i") - tail)
    rows = rows.select("word", "n", "m", "i", "j", key.alias("key"), free.alias("free"))
    return rows.select(F.xxhash64("key").alias("h"), "*")


def _halves(rows: DataFrame) -> DataFrame:
    """Both halves of every segment ``[i, j)``."""
    middle = F.expr("i + (j - i) div 2").cast("int")
    spans = F.array(F.struct(F.col("i").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("j").alias("b")))
    return rows.select("word", "n", "m", F.explode(spans).alias("s")).select(
        "word", "n", "m", F.col("s.a").alias("i"), F.col("s.b").alias("j"))


def segment_lists(words: DataFrame, list_rows: int = LIST_ROWS, list_chars: int = LIST_CHARS) -> DataFrame:
    """Every word in its lists, none of them larger than the bounds unless one free character is left.

    Lists are sized by a hash of their key: keys that share one are cut together, which loses nothing.
    """
    size = F.length("word")
    classes = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).where(F.col("m") >= LEAST_CHARS)
    rows = _keyed(_halves(classes.select("word", "n", "m", F.lit(0).alias("i"), F.col("m").alias("j"))))
    done = []
    while True:
        large = rows.groupBy("h").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("free")).alias("chars"),
                                      F.max(F.expr("j - i")).alias("width"))
        large = landed(large.where((F.col("width") > 1) & ((F.col("rows") > list_rows) | (F.col("chars") > list_chars)))
                       .select("h"), "long-lists")
        if large.isEmpty():
            break
        done.append(rows.join(large, "h", "left_anti"))
        # A colliding list of one free character stays one: its halves would be itself and nothing.
        again = rows.join(large, "h", "left_semi")
        done.append(again.where("j - i = 1"))
        rows = _keyed(landed(_halves(again.where("j - i > 1")), "halves"))
    for part in done:
        rows = rows.union(part.select(rows.columns))
    return rows


def _neighbours(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """One row ``(word, n_near, near_n, near)`` for each word of each list that has neighbours there."""
    key = rows.column("key").to_numpy(zero_copy_only=False)
    first = np.append(True, key[1:] != key[:-1])
    last = np.append(first[1:], True)
    keep = np.flatnonzero(~(first & last))                 # a list of one word has no pairs
    if not len(keep):
        return
    rows, first = rows.take(pa.array(keep)), first[keep]
    words, free, n = rows.column("word").to_pylist(), rows.column("free").to_pylist(), rows.column("n").to_numpy()
    width = (rows.column("j").to_numpy() - rows.column("i").to_numpy()).astype(np.int64)
    end = rows.column("j").to_numpy() == rows.column("m").to_numpy()
    sizes = np.fromiter(map(len, free), np.int64, len(free))
    starts = np.append(np.flatnonzero(first), len(free))
    a = 0
    while a < len(starts) - 1:
        b, widest = a, 0
        while b < len(starts) - 1:
            wider = max(widest, int(sizes[starts[b]:starts[b + 1]].max()))
            block = starts[b + 1] - starts[a]
            if b > a and (block > BLOCK_ROWS or block * wider > BLOCK_CELLS):
                break
            b, widest = b + 1, wider
        lo, hi = starts[a], starts[b]
        a = b
        out = _block(words[lo:hi], free[lo:hi], n[lo:hi], width[lo:hi], end[lo:hi], first[lo:hi])
        if out is not None:
            yield out


def _block(words, free, n, width, end, first) -> pa.RecordBatch | None:
    codes, sizes = code_points(free)
    q, r = one_edit_pairs(codes, sizes, first)
    # Both longer than the class: the pair belongs to the next class.
    use = (sizes[q] == width[q]) | (sizes[r] == width[r])
    q, r = q[use], r[use]
    # An insertion at the end of the free part belongs to the next segment, if there is one.
    short, long = np.where(sizes[q] <= sizes[r], q, r), np.where(sizes[q] <= sizes[r], r, q)
    at_end = (sizes[short] < sizes[long]) & ((codes[short] == codes[long]) | (codes[short] == 0)).all(axis=1)
    use = ~at_end | end[q]
    q, r = q[use], r[use]
    if not len(q):
        return None
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[r], -n[r], q))
    q, r = q[order], r[order]
    head = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
    many = np.diff(np.append(head, len(q)))
    return pa.RecordBatch.from_arrays(
        [pa.array([words[x] for x in q[head]], pa.string()), pa.array(many, pa.int64()), pa.array(n[r[head]], pa.int64()),
         pa.array([words[x] for x in r[head]], pa.string())], ["word", "n_near", "near_n", "near"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole lists of a sorted partition, a batch at a time."""
    rest: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        key = rows.column("key").to_numpy(zero_copy_only=False)
        same = key == key[-1]
        cut = 0 if same.all() else int(np.flatnonzero(~same)[-1]) + 1
        if cut == 0 and rest and rest[-1].column("key")[-1].as_py() != key[-1]:
            yield from _neighbours(pa.concat_tables(rest).combine_chunks())
            rest = []
        if cut:
            yield from _neighbours(pa.concat_tables([*rest, rows.slice(0, cut)]).combine_chunks())
            rest = []
        rest.append(rows.slice(cut))
    if rest:
        yield from _neighbours(pa.concat_tables(rest).combine_chunks())


def nearest_forms(words: DataFrame, list_rows: int = LIST_ROWS, list_chars: int = LIST_CHARS) -> DataFrame:
    """``(word, n, n_near, form, form_n)`` of a stored vocabulary ``(word, n)``."""
    lists = segment_lists(words, list_rows, list_chars).select("h", "key", "free", "word", "n", "m", "i", "j")
    lists = lists.repartition("h").sortWithinPartitions("h", "key", "free")
    near = arrow_map(lists, _scan, "word string, n_near long, near_n long, near string")
    own = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("near_n"),
                       F.lit(None).cast("string").alias("near"))
    found = near.select("word", F.lit(None).cast("long").alias("n"), "n_near", "near_n", "near")
    # Largest count first, then the smallest word; Spark compares strings by their UTF-8 bytes, as code points do.
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("order"), "near", "near_n")))
    every = own.union(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    formed = F.col("best.near_n") >= F.col("n") * TIMES
    return every.select("word", "n", "n_near", F.when(formed, F.col("best.near")).alias("form"),
                        F.when(formed, F.col("best.near_n")).alias("form_n"))


def spelling_variants(docs: DataFrame, list_rows: int = LIST_ROWS, list_chars: int = LIST_CHARS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of the documents.

    A form is at least ten times as frequent as its word, so a chain of forms has no more links than a 64-bit count has
    digits; the chains are followed by doubling, at most five joins of the words that have a form.
    """
    words = landed(vocabulary(docs), "vocabulary")
    forms = landed(nearest_forms(words, list_rows, list_chars), "forms")
    roots = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = landed(roots.join(step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
