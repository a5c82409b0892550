"""DuckDB SQL of the training-data queries that SQL can express on whole tables.

The others (spaced seeds, the recurrent labeller, tokenizers, expectation maximisation, quantised tries, piece models)
are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _secret_matches(no: int, pattern: str, least: int, value: int = 0, lead: int | None = None, where: str = "true"):
    """Rows (rid, no, start, end, value) of one kind; ``lead`` is the group that stands for a lookbehind."""
    pre = f"length(regexp_extract_all(t, '{pattern}', {lead})[i])" if lead is not None else "0"
    return f"""
      SELECT rid, {no} AS no, a + {pre} AS s, a + length(f[i]) AS e, v[i] AS v
      FROM (SELECT rid, t, f, v, i, coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
                   + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS a
            FROM (SELECT rid, t, regexp_extract_all(t, '{pattern}') AS f, regexp_extract_all(t, '{pattern}', {value}) AS v,
                         string_split_regex(t, '{pattern}') AS g, unnest(range(1, len(f) + 1)) AS i FROM d))
      WHERE length(v[i]) >= {least} AND {where.format('v[i]')}"""


_ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
           r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'""'r"]?\x20*[:=]\x20*["'""'r"]?([A-Za-z0-9+/_.=-]+)")
_JWT = r"(^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})"
_PREFIXED = r"(^|[^A-Za-z0-9_-])((?:gh[opusr]_|sk_live_|xox[abprs]-|AIza)[A-Za-z0-9_-]{16,})"
_MIXED = "regexp_matches({0}, '[A-Z]') AND regexp_matches({0}, '[a-z]') AND regexp_matches({0}, '[0-9]')"

OP1 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, source,
                  coalesce(source, '') || chr(31) || coalesce(lang, '') AS repo FROM documents),
m AS ({" UNION ALL ".join([
    _secret_matches(1, _ASSIGN, 8, 2), _secret_matches(2, "AKIA[A-Z0-9]+", 16), _secret_matches(3, "[0-9a-f]{32,}", 32),
    _secret_matches(4, _JWT, 32, 2, 1), _secret_matches(5, _PREFIXED, 20, 2, 1),
    _secret_matches(6, "[A-Za-z0-9+/_-]{24,}", 24, where=_MIXED)])}),
h AS (SELECT DISTINCT v, rid, coalesce('=' || source, rid::VARCHAR) AS owner, repo FROM m JOIN d USING (rid)),
o AS (SELECT v, count(*) AS docs, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repo)) AS repos
      FROM h GROUP BY v),
j AS (SELECT m.*, owners <= 2 AND repos <= 4 AND docs <= 100 AS live,
             (['assign', 'access', 'hex', 'jwt', 'prefixed', 'mixed'])[no] || ':' || s || ':' || e AS code
      FROM m JOIN o USING (v)),
g AS (SELECT rid, count(*) FILTER (no = 1) AS n_assign, count(*) FILTER (no = 2) AS n_access,
             count(*) FILTER (no = 3) AS n_hex, string_agg(code, ',' ORDER BY s, no) FILTER (no <= 3) AS base,
             string_agg(code, ',' ORDER BY s, no) FILTER (no <= 3 OR live) AS spans,
             count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied FROM j GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
       coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN g USING (rid)
"""

OP4 = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), '|', '&#124;') AS r,
             replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), '|', '&#124;') AS x FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(length(r) + length(x) + 13) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host FROM documents),
w AS (SELECT rid, {WORDS.format("t")} AS w, list_filter(string_split(t, chr(10)),
             lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l, t FROM d),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
      FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (
        SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (
          SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n >= 2) GROUP BY rid),
f AS (SELECT d.rid, doc_id, host, len(w) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(regexp_replace(d.t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
      FROM d JOIN w USING (rid) LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             [10 * n_symbols > n_words, 10 * n_dup_lines > 3 * n_lines,
              word_chars < 2 * n_words OR word_chars > 12 * n_words] AS soft FROM f),
h AS (SELECT host, rule, count(*) AS n, count(*) FILTER (soft[rule]) AS failed
      FROM b, (SELECT unnest([1, 2, 3]) AS rule) GROUP BY host, rule),
p AS (SELECT rule, sum(failed) / sum(n) AS m, sum(failed * failed / n) / sum(n) - (sum(failed) / sum(n)) ** 2 AS v
      FROM h GROUP BY rule),
q AS (SELECT rule, m, CASE WHEN v > 1e-12 THEN least(greatest(m * (1 - m) / v - 1, 1), 1e6) ELSE 1e6 END AS s FROM p),
e AS (SELECT host, rule, n, m, s, (failed + m * s) / (n + s) AS rate FROM h JOIN q USING (rule)),
z AS (SELECT host, list(rate - 2 * sqrt(greatest(rate * (1 - rate), 0) / (n + s + 1)) > 2 * m ORDER BY rule) AS bad
      FROM e GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ((bad[1] AND soft[1]) OR (bad[2] AND soft[2]) OR (bad[3] AND soft[3])) AS kept, n_lines,
       (bad[1] AND soft[1]) OR (bad[2] AND soft[2]) OR (bad[3] AND soft[3]) AS host_rejected
FROM b JOIN z USING (host)
"""

OP10 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
         AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 5
        THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH RECURSIVE c AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc),
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
             {_LOWER.format("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+'))")} AS run
      FROM documents),
b AS (SELECT run, flatten(list_transform(string_split(doc || ':' || run, ''), lambda ch: CASE WHEN ord(ch) < 128
               THEN [ord(ch)::BIGINT] ELSE [192::BIGINT + (ord(ch) >> 6), 128::BIGINT + (ord(ch) & 63)] END)) AS bytes
      FROM r WHERE length(run) >= 7),
h AS (SELECT run, xor(list_reduce(list_concat([4294967295::BIGINT], bytes),
               lambda x, y: xor(x >> 8, crc[1 + (xor(x, y) & 255)])), 4294967295::BIGINT) AS h FROM b, c),
v AS (SELECT word, count(*) AS n FROM (
        SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END
               AS word FROM h) WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
x AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
      FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT x.word, y.word AS near FROM x JOIN x y ON x.i = y.i AND x.cut = y.cut AND x.word <> y.word
      UNION SELECT x.word, v.word FROM x JOIN v ON v.word = x.cut
      UNION SELECT v.word, x.word FROM x JOIN v ON v.word = x.cut),
k AS (SELECT p.word, v.word AS near, v.n, count(*) OVER (PARTITION BY p.word) AS n_near,
             row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, v.word) AS place FROM p JOIN v ON v.word = near),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN k.n >= 10 * v.n THEN near END AS form,
             CASE WHEN k.n >= 10 * v.n THEN k.n END AS form_n FROM v LEFT JOIN k ON k.word = v.word AND place = 1),
t(word, root, depth) AS (SELECT word, word, 0 FROM f
                         UNION ALL SELECT t.word, f.form, depth + 1 FROM t JOIN f ON f.word = t.root AND form IS NOT NULL),
o AS (SELECT word, arg_max(root, depth) AS root FROM t GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN o USING (word)
"""

OP12 = rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?
-
]')) AS piece
           FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM t),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))
             AS phrase FROM w, (VALUES (1), (2), (3)) AS s(k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS s FROM f WHERE k > 1 AND a >= 10),
m AS (SELECT lang, sub, max(a) AS a FROM (
        SELECT lang, a, unnest([s[1] || ' ' || s[2], s[2] || ' ' || s[3]]) AS sub FROM c WHERE k = 3) GROUP BY ALL),
d AS (SELECT lang, phrase, a, unnest(range(1, k)) AS cut, s FROM c),
e AS (SELECT d.lang, d.phrase, d.a, cut, x.a AS l, y.a AS r,
             CAST((1000000::HUGEINT * d.a * d.a) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
      FROM d JOIN f x ON x.lang = d.lang AND x.phrase = array_to_string(s[:cut], ' ')
             JOIN f y ON y.lang = d.lang AND y.phrase = array_to_string(s[cut + 1:], ' ')),
q AS (SELECT e.* FROM e LEFT JOIN m ON m.lang = e.lang AND sub = phrase WHERE m.a IS NULL OR 100 * m.a < 50 * e.a
      QUALIFY row_number() OVER (PARTITION BY e.lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM q JOIN n USING (lang) QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {"op1_secret_scan": OP1, "op4_chat": OP4, "op9_quality": OP9, "op10_minhash": OP10,
                          "op11_spelling_variants": OP11, "op12_collocations": OP12}
