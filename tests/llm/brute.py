"""Plain single-process versions of the operators' definitions, and odd inputs that every operator must handle."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names that operators use inside; inputs that carry them must not matter.
CLASH = ["node", "bands", "cluster", "host", "text_key", "w", "l", "g", "base", "added", "row_id", "match", "owner",
         "repo", "hash", "row", "begin", "words", "hits", "held_out", "shard", "block", "parts", "ids", "gone_id", "pii0"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return WORD.findall(text or "")


def prose(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


def odd_documents():
    """Null and empty texts, null ids and sources, ties, repeated rows, white space only, other scripts, long texts."""
    long = prose(60_000, 1, 5000)
    copy = prose(120, 2)
    return [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n\r\x0b\x0c ", "en", None, 7), (4, copy, "en", "a", 1),
        (5, copy, "en", "b", 1), (5, copy, "en", "b", 1), (6, copy + " x", None, "b", 1), (None, copy, "en", "c", 1),
        (7, long, "en", "c", 1), (8, "é ß 漢字 ▁ \U0001f600 ́a İ Σ", "fr", "c", 1), (9, "one two", "en", "c", 1),
        (10, "one two", "en", "d", 1), (11, "x" * 100_000, "en", "d", 1), (None, None, None, None, None)]


def frame(spark, rows, schema=DOC_SCHEMA, clash=False):
    df = spark.createDataFrame(rows, schema)
    for c in CLASH if clash else ():
        df = df.selectExpr("*", f"'clash' as {c}")
    return df


def shingles(text, k=5):
    w = words(lower(text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(docs, percent=85):
    """doc_id -> (n_shingles, component, kept) from all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = {}
    for i, s in sets.items():
        for x in s:
            having.setdefault(x, []).append(i)
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in having[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def quality(text):
    w = words(text)
    n = len(w)
    grams = Counter(tuple(w[i:i + 3]) for i in range(n - 2))
    covered = {p for i in range(n - 2) if grams[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


SECRETS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.I | re.A), 2, 8),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 16), "hex": (re.compile("[0-9a-f]+"), 0, 32)}


def secrets(text):
    found = sorted((m.start(), k, m.end()) for k, (p, g, least) in enumerate(SECRETS.values())
                   for m in p.finditer(text or "") if len(m[g]) >= least)
    joined = ",".join(f"{list(SECRETS)[k]}:{a}:{b}" for a, k, b in found)
    kinds = Counter(k for _, k, _ in found)
    return kinds[0], kinds[1], kinds[2], hashlib.sha256(joined.encode()).hexdigest(), joined


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def _digits(m):
    return re.sub("[^0-9]", "", m)


PERSONAL = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(_digits(m)) <= 15)}


def personal(text):
    found = [(k, m.start(), m.end()) for k, (p, good) in PERSONAL.items() for m in re.finditer(p, text or "") if good(m[0])]
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
    kinds = Counter(k for k, _, _ in found)
    return *(kinds[k] for k in PERSONAL), hashlib.sha256(joined.encode()).hexdigest(), joined


def bigram_scores(docs, mu):
    """Per document: (held_out, n_tokens, n_known, N), base score, model score."""
    tokens = [words(lower(t or "")) + ["\n"] for _, t in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in docs]
    one, two = Counter(), Counter()
    for t, h in zip(tokens, held):
        if not h:
            one.update(t)
            two.update(zip(["\n\n", *t], t))
    total, distinct = sum(one.values()), len(one)
    context = one | Counter({"\n\n": one["\n"]})
    out = []
    for t, h in zip(tokens, held):
        q = [(one[w] + 0.5) / (total + 0.5 * (distinct + 1)) for w in t]
        score = sum(math.log10((two[(v, w)] + mu * x) / (context[v] + mu)) for v, w, x in zip(["\n\n", *t], t, q))
        out.append(((h, len(t), sum(one[w] > 0 for w in t), total), sum(map(math.log10, q)), score))
    return out


def variant_words(docs, least=7):
    """Counted words of (doc_id, text) pairs, errors included."""
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants(counts):
    """word -> (form, root, n, n_near, form_n), all pairs compared."""
    form, near = {}, Counter()
    for w in counts:
        around = [x for x in counts if one_edit(w, x)]
        near[w] = len(around)
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 10 * counts[w]:
            form[w] = best
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, near[w], counts[form[w]] if w in form else None)
    return out


def collocations(docs, least=10, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) rows of (lang, text) pairs."""
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in good.items():
            if any(100 * b >= 50 * a for q, b in good.items() if len(q) > len(p)
                   and any(q[i:i + len(p)] == p for i in range(len(q)))):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return out


def leaks(docs, items, overlap=20, percent=65):
    """(doc, item) -> most equal words in a window, for all windows of all pairs that reach the threshold."""
    ids = {}

    def normal(text):
        return np.array([ids.setdefault(w, len(ids)) for w in re.findall(r"\w+", (text or "").casefold())], np.int64)

    found = {}
    for (d, a), (i, b) in itertools.product([(d, normal(t)) for d, t in docs], [(i, normal(t)) for i, t in items]):
        n = min(overlap, len(a), len(b))
        if not n or (n < 5 and len(a) != len(b)):
            continue
        best = 0
        for shift in range(1 - len(b), len(a)):
            same = b[max(0, -shift):len(a) - shift] == a[max(0, shift):shift + len(b)]
            total = np.concatenate([[0], np.cumsum(same)])
            width = min(n, len(same))
            best = max(best, int((total[width:] - total[:-width]).max()))
        if 100 * best >= (percent if n >= 8 else 100) * n:
            found[d, i] = best
    return found


def reliabilities(counts, kinds, iterations=25):
    """Expectation maximisation over ``(kind, votes, n)`` -> (share, hit, miss, posteriors), independent labelers."""
    no = np.array([k for k, _, _ in counts]) - 1
    votes = np.array([v for _, v, _ in counts])
    n = np.array([float(c) for _, _, c in counts])
    share, hit, miss = np.full(kinds, 0.5), np.full(votes.shape[1], 0.8), np.full(votes.shape[1], 0.3)

    def posterior():
        yes = share[no] * np.prod(np.where(votes == 1, hit, np.where(votes == -1, 1 - hit, 1)), axis=1)
        other = (1 - share[no]) * np.prod(np.where(votes == 1, miss, np.where(votes == -1, 1 - miss, 1)), axis=1)
        return yes / (yes + other)

    for _ in range(iterations):
        p = posterior()
        share = np.array([((n * p)[no == k].sum() + 1) / (n[no == k].sum() + 2) for k in range(kinds)])
        hit, miss = (((n * w) @ (votes == 1) + 1) / ((n * w) @ (votes != 0) + 2) for w in (p, 1 - p))
    return share, hit, miss, posterior()
