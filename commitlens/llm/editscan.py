"""All pairs of strings one edit apart inside sorted lists, by dynamic programming over shared prefixes.

The rows of the edit matrix of a query against the sorted list belong to prefixes, not to words: a word takes over the
rows of its predecessor up to their longest common prefix (LCP) and adds rows for the rest. Only three cells of a row can
hold at most one edit (the band around the diagonal). A prefix whose three cells all exceed one edit cannot be mended by
more characters, so the whole range of words that share it is skipped. The scan runs over all queries at once, one
character deeper each round: a round's state is (query, prefix, three cells).
"""

from __future__ import annotations

import numpy as np

#: Cells saturate here: more than one edit is no pair.
TOO_FAR = 2


def code_points(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Matrix of code points, padded with 0, and the lengths."""
    boxed = np.array(strings, dtype=np.str_)
    width = max(boxed.dtype.itemsize // 4, 1)
    return boxed.view(np.uint32).reshape(len(strings), width), np.fromiter(map(len, strings), np.int64, len(strings))


def adjacent_lcp(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """LCP of every row with the one before; -1 where ``first`` marks the start of a list."""
    lcp = np.full(len(codes), -1, np.int64)
    if len(codes) > 1:
        lcp[1:] = (codes[1:] != codes[:-1]).argmax(axis=1)
    lcp[first] = -1
    return lcp


def _char(codes: np.ndarray, rows: np.ndarray, at: int) -> np.ndarray:
    """Character ``at`` of the rows; 0 outside the matrix, which no word holds."""
    if 0 <= at < codes.shape[1]:
        return codes[rows, at].astype(np.int64)
    return np.zeros(len(rows), np.int64)


def one_edit_pairs(codes: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ordered pairs (query row, found row) exactly one insertion, deletion or replacement apart, within each list.

    Rows are sorted by code points inside their list and distinct there; ``first`` marks the lists' first rows.
    """
    n = len(codes)
    lcp = adjacent_lcp(codes, first)
    starts = np.flatnonzero(first)
    query = np.arange(n)
    node = np.cumsum(first) - 1
    below, level, above = (np.full(n, v, np.int8) for v in (TOO_FAR, 0, 1))
    found_q, found_r = [], []
    for depth in range(codes.shape[1] + 1):
        # A word that ends at this prefix is the first of the prefix's range.
        row = starts[node]
        over = lengths[query] - depth
        cost = np.select([over == -1, over == 0, over == 1], [below, level, above], TOO_FAR)
        hit = (lengths[row] == depth) & (cost == 1)
        found_q.append(query[hit])
        found_r.append(row[hit])

        # Rows that begin a new prefix, one character longer; all others reuse the rows of the word before.
        new = np.flatnonzero((lcp <= depth) & (lengths > depth))
        if not len(new) or not len(query):
            break
        chars = codes[new, depth].astype(np.int64)
        keys = ((np.searchsorted(starts, new, "right") - 1) << 21) | chars
        near = np.minimum(np.minimum(below, level), above)

        # Nothing spent yet: every longer prefix is worth a look.
        free = np.flatnonzero(near == 0)
        a, b = np.searchsorted(keys, node[free] << 21), np.searchsorted(keys, (node[free] + 1) << 21)
        entry = np.repeat(free, b - a)
        child = np.arange(len(entry)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
        entries, children = [entry], [child]
        # One edit spent: only the characters that continue a cell without a further edit.
        spent = np.flatnonzero(near == 1)
        tried = []
        for k, cells in ((-1, below), (0, level), (1, above)):
            want = _char(codes, query[spent], depth + k)
            use = (cells[spent] == 1) & (want > 0)
            for other, used in tried:
                use &= ~(used & (other == want))
            tried.append((want, use))
            at = (node[spent] << 21) | want
            pos = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
            ok = use & (keys[pos] == at)
            entries.append(spent[ok])
            children.append(pos[ok])
        entry, child = np.concatenate(entries), np.concatenate(children)

        # One more row of the matrix, three cells of it.
        q, c = query[entry], chars[child]
        size = lengths[q]
        cells = []
        left = None
        for k, diagonal, up in ((-1, below, level), (0, level, above), (1, above, None)):
            cell = diagonal[entry] + (_char(codes, q, depth + k) != c)
            if up is not None:
                cell = np.minimum(cell, up[entry] + 1)
            if left is not None:
                cell = np.minimum(cell, left + 1)
            left = np.where((depth + 1 + k > size) | (cell > TOO_FAR), TOO_FAR, cell).astype(np.int8)
            cells.append(left)
        alive = np.minimum(np.minimum(cells[0], cells[1]), cells[2]) <= 1
        query, node = q[alive], child[alive]
        below, level, above = (x[alive] for x in cells)
        starts = new
    return np.concatenate(found_q), np.concatenate(found_r)
