"""Reply trees and chat formatting."""

import hashlib
import random

import brute  # noqa: F401
from commitlens.llm import chat

MESSAGES = "tree string, node long, parent long, score double, role string, text string"
CONVERSATIONS = "conv_id long, turn long, role string, text string"


def paths_by_hand(rows, top_k):
    by = {(t, n): (p, s) for t, n, p, s, *_ in rows}
    inner = {(t, p) for (t, n), (p, _) in by.items() if (t, p) in by}
    out = {}
    for t, n in by:
        if (t, n) not in inner:
            path, at, seen = [], n, set()
            while at is not None and (t, at) in by and at not in seen:
                seen.add(at)
                path.append(at)
                at = by[(t, at)][0]
            if at in seen:
                continue
            out.setdefault(t, []).append((-sum(by[(t, x)][1] for x in path), n, path[::-1]))
    return {(t, rank + 1): path for t, each in out.items() for rank, (_, _, path) in enumerate(sorted(each)[:top_k])}


def test_paths_of_random_trees(spark):
    rng = random.Random(1)
    rows = []
    for t in range(8):
        for n in range(rng.choice([1, 2, 9, 60])):
            rows.append((f"t{t}", n, rng.choice([None, *range(n)]) if n else None, float(rng.randrange(5)), "user", f"m{n}"))
    rows += [("deep", n, n - 1 if n else None, 1.0, "user", "d") for n in range(70)]
    rows += [("loop", 1, 2, 1.0, "user", "x"), ("loop", 2, 1, 1.0, "user", "y"), ("orphan", 5, 99, 1.0, "user", "z")]
    df = spark.createDataFrame(rows, MESSAGES)
    got = {}
    for r in sorted(chat.chosen_paths(df, top_k=3).collect(), key=lambda r: r.depth):
        got.setdefault((r.tree, r.rank), []).append(r.node)
    assert got == paths_by_hand(rows, 3)
    assert ("loop", 1) not in got and got[("orphan", 1)] == [5] and len(got[("deep", 1)]) == 70


def test_format_and_mask(spark):
    rows = [("t", 1, None, 1.0, "user", "a <b> & [x] |"), ("t", 2, 1, 1.0, "assistant", "&lt;|end|>\n"), ("t", 3, 2, 0.0, None, None)]
    r = chat.format_paths(spark.createDataFrame(rows, MESSAGES)).collect()[0]
    assert r.formatted == ("<|user|>\na &lt;b> &amp; &#91;x] &#124;<|end|>\n"
                           "<|assistant|>\n&amp;lt;&#124;end&#124;>\n<|end|>\n<||>\n<|end|>\n")
    assert [r.formatted[s.start:s.end] for s in r.loss_spans] == ["&amp;lt;&#124;end&#124;>\n"]


def by_hand(rows):
    out = {}
    for c, turn, role, text in rows:
        out.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c, v in out.items():
        v.sort()
        loss = "".join(t for *_, r, t in v if r == "assistant")
        out[c] = (len(v), hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in v).encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_conversations_read_back(spark):
    rng = random.Random(2)
    bits = ["</s>", "[INST]", "<|end|>\n", "<|", "|>", "&amp;", "&#124;", "\\", "\n", "é\U0001f600", " ok "]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a|>\nb"]), "".join(rng.choice(bits) for _ in range(9)))
            for c in range(20) for t in range(rng.randrange(1, 9))]
    rows += [(50, None, None, None), (50, 1, "assistant", ""), (51, 3, "user", "x"), (51, 3, "user", "x"),
             (51, 3, "assistant", "tie"), (None, 1, "assistant", "null id"), (52, 0, "assistant", "long " * 50_000)]
    rows += [(53, t, "assistant" if t % 2 else "user", f"m{t}") for t in range(300)]
    df = spark.createDataFrame(rows, CONVERSATIONS).selectExpr("*", "1 as node", "'x' as tree", "2 as pieces")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in chat.formatted_conversations(df).collect()}
    assert got == by_hand(rows)
    assert chat.formatted_conversations(df.limit(0)).count() == 0
