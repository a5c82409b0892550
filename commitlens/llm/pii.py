"""Operator 6, personal data by weak supervision. Built-in functions only.

Four base kinds (email, ip, card, phone) are always reported. Wider candidate kinds (``ADDED``) are reported where the
model accepts them. Four labelers vote on every candidate (1 personal, -1 not, 0 abstains), each on evidence of its own:
the match's own form (uniform separators, check digits, canonical parts), a gazetteer of prefixes and ranges, cue words in
the context, and what stands right beside the match (white space, brackets and quotes, or a longer run of numbers or code).

Vote patterns are counted over the whole corpus; there are at most ``kinds * 3^4`` of them, so the expectation
maximisation that estimates each labeler's reliability and each kind's share runs as one aggregate expression over a
bounded array. Its posteriors are soft labels for the final span classifier: a naive Bayes model over span features,
whose counts are one more aggregation over at most ``kinds * 3^4 * features`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import landed, quoted
from commitlens.llm.spans import found, gaps, kind_count, match_ends, prefix_max, span_text

#: Fixed patterns. A base match that fails its check is dropped, not retried. ``\G`` lets a match begin inside a run
#: right after the match before; otherwise runs are entered at their first character only, which keeps scans linear.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = {
    "obfuscated": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++"
                  r"(?:\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Za-z0-9-]++)++",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "local_phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
}
PATTERNS = {**BASE, **ADDED}
KINDS = list(PATTERNS)
CONTEXT = 32
ITERATIONS = 25

#: Fixed cue words around personal data, and around numbers that are not.
CUES = r"(?i)(e-?mail|mail|contact|call|phone|tel|mobile|fax|card|visa|account|iban|ssn|social|address|host|login|name)"
FOILS = r"(?i)(isbn|version|order|sku|page|chapter|part|serial|build|figure|table|hash|example)"
#: What stands beside a number that is part of something longer: code, paths, assignments, other numbers.
GLUED_LEFT = r"""(?:[A-Za-z0-9_#/=%+*.\\-]|=["']|[0-9][\x20,;|]{1,2})$"""
GLUED_RIGHT = r"^(?:[A-Za-z0-9_#/=%+*\\]|[.-][A-Za-z0-9]|[\x20,;|]{1,2}[0-9])"
#: Fixed gazetteers: country codes of long account numbers, top-level names, card issuer prefixes.
IBAN_CODES = ["AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE"]
TOP_LEVELS = r"(?i)[.\]) ](com|org|net|edu|gov|io|de|fr|es|it|uk|nl|ch|at|eu|info|dev)$"


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    reverse = F.filter(F.split(F.reverse(number), ""), lambda c: c != "")
    total = F.aggregate(
        F.transform(reverse, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int")))),
        F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def in_range(m: Column) -> Column:
    """Every dotted part at most 255, whatever its leading zeros."""
    return F.forall(F.split(m, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3)
                    & (F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255))


def check_97(m: Column) -> Column:
    """Whether an account number passes its check: its first four characters moved to the end, letters read as 10 to 35,
    the whole leaves 1 modulo 97. Folded character by character, so its length does not matter."""
    plain = F.regexp_replace(m, "[^0-9A-Z]", "")
    turned = F.split(F.concat(F.substring(plain, 5, 100), F.left(plain, F.lit(4))), "")
    return F.aggregate(
        F.filter(turned, lambda c: c != ""), F.lit(0),
        lambda a, c: F.when(c.between("0", "9"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97) == 1


def valid(kind: str, m: Column) -> Column:
    """The base check of a match (true for kinds without one)."""
    if kind == "ip":
        return in_range(m)
    if kind == "card":
        return F.when(F.length(digits(m)).between(16, 19), luhn(digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(digits(m)).between(8, 15)
    return F.lit(True)


def votes(kind: str, m: Column, before: Column, after: Column) -> list[Column]:
    """Pattern, gazetteer, context and boundary votes of a match."""
    def vote(yes: Column, no: Column | None = None) -> Column:
        no = ~yes if no is None else no
        return F.when(yes, 1).when(no, -1).otherwise(0)

    strict = {
        "email": m.rlike(r"^[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?@[^@]{1,189}\.[A-Za-z]{2,}$")
        & ~m.contains(".."),
        "ip": m.rlike(r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$"),
        "card": m.rlike(r"^(?:[0-9]{16,19}|[0-9]{4}(\x20|-)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?)$"),
        "phone": m.rlike(r"^\+[0-9]{1,3}(?:[\x20.-]?\(?[0-9]{1,5}\)?){1,5}$"),
        "obfuscated": m.rlike(r"^[A-Za-z0-9].*(?:\(at\).*\(dot\)|\[at\].*\[dot\])"), "iban": check_97(m),
        "ssn": ~m.rlike("^(000|666|9)") & ~m.rlike("-00-|-0000$"),
        "local_phone": m.rlike(r"^(?:\([2-9][0-9]{2}\)\x20|[2-9][0-9]{2}([\x20.-]))[0-9]{3}(?:\1|[.-])[0-9]{4}$"),
    }[kind]
    known = {
        "email": m.rlike(TOP_LEVELS), "obfuscated": m.rlike(TOP_LEVELS),
        "ip": ~m.rlike(r"^(0|10|127|255|169\.254|192\.168|224)\."), "card": m.rlike("^[3-6]"),
        "phone": m.rlike(r"^\+(1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"),
        "iban": F.left(m, F.lit(2)).isin(IBAN_CODES), "ssn": m.rlike("^[0-7]"),
        "local_phone": ~F.substring(digits(m), 4, 3).isin("000", "555"),
    }[kind]
    near = F.concat(before, F.lit(" "), after)
    glued = before.rlike(GLUED_LEFT) | after.rlike(GLUED_RIGHT)
    return [vote(strict), vote(known), vote(near.rlike(CUES), near.rlike(FOILS)), vote(~glued)]


def features(m: Column, before: Column, after: Column) -> Column:
    """Span features of the final classifier, as one string of small codes."""
    size = F.least(F.floor(F.length(m) / 4), F.lit(9)).cast("string")
    sep = F.when(m.rlike("[ ]"), "s").when(m.rlike("-"), "d").when(m.rlike(r"[.]"), "p").otherwise("n")
    left = F.when(before == "", "e").when(before.rlike(r"\s$"), "s").when(before.rlike("[:=(]$"), "o").otherwise("x")
    right = F.when(after == "", "e").when(after.rlike(r"^\s"), "s").when(after.rlike("^[.,;:)]"), "o").otherwise("x")
    return F.concat_ws("|", F.concat(F.lit("len"), size), F.concat(F.lit("sep"), sep), F.concat(F.lit("left"), left),
                       F.concat(F.lit("right"), right))


def judged_matches(kind: str, match: Column, gap: Column, end: Column) -> Column:
    """Array of ``(no, start, end, votes, features)`` of one kind's valid matches."""
    def one(m, i):
        before = F.right(F.get(gap, i), F.lit(CONTEXT))
        after = F.left(F.get(gap, i + 1), F.lit(CONTEXT))
        return F.struct(F.lit(KINDS.index(kind) + 1).alias("no"), (F.get(end, i) - F.length(m)).alias("start"),
                        F.get(end, i).alias("end"), valid(kind, m).alias("ok"),
                        F.concat_ws(",", *[v.cast("string") for v in votes(kind, m, before, after)]).alias("votes"),
                        features(m, before, after).alias("features"))
    return F.filter(F.transform(match, one), lambda s: s["ok"])


def candidates(docs: DataFrame, carry: bool = False) -> DataFrame:
    """One row per input row: ``(row_id, doc_id, base, added)``, with the whole input row as the struct ``doc`` where
    ``carry`` asks for it."""
    whole = [F.struct("*").alias("doc")] if carry else []
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *whole)
    rows = rows.select("*", *[found("text", p).alias(f"{k}_match") for k, p in PATTERNS.items()])
    rows = rows.select("*", *[gaps(F.col("text"), p, F.col(f"{k}_match")).alias(f"{k}_gap")
                              for k, p in PATTERNS.items()])
    rows = rows.select("*", *[match_ends(F.col(f"{k}_match"), F.col(f"{k}_gap")).alias(f"{k}_end") for k in PATTERNS])

    def spans(kinds):
        return F.flatten(F.array(*[judged_matches(k, F.col(f"{k}_match"), F.col(f"{k}_gap"), F.col(f"{k}_end"))
                                   for k in kinds]))

    return rows.select(F.monotonically_increasing_id().alias("row_id"), "doc_id",
                       spans(BASE).alias("base"), spans(ADDED).alias("added"), *(["doc"] if carry else []))


def reliabilities(patterns: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """``patterns(no, votes, n)`` (bounded) -> one row with ``rows`` (no, votes, n, p): ``p`` is the posterior after EM.

    Labelers are taken as independent given the truth; each has a rate of votes for personal data among true and among
    false candidates, and each kind has its own share of true ones. All start alike, with labelers better than chance.
    """
    one = patterns.agg(F.sort_array(F.collect_list(F.struct(
        "no", "votes", F.col("n").cast("double").alias("n")))).alias("rows"))
    one = one.select(F.transform("rows", lambda r: F.struct(
        r["no"].alias("no"), r["votes"].alias("votes"), r["n"].alias("n"),
        F.transform(F.split(r["votes"], ","), lambda v: v.cast("int")).alias("v"))).alias("rows"))
    kinds, labelers = F.sequence(F.lit(1), F.lit(len(KINDS))), F.sequence(F.lit(0), F.lit(3))

    def likelihood(r: Column, rate: Column) -> Column:
        return F.aggregate(F.zip_with(r["v"], rate, lambda v, x: F.when(v == 1, x).when(v == -1, 1 - x).otherwise(1.0)),
                           F.lit(1.0), lambda a, x: a * x)

    def posterior(r: Column, state: Column) -> Column:
        share = F.get(state["share"], r["no"] - 1)
        yes, no = share * likelihood(r, state["hit"]), (1 - share) * likelihood(r, state["miss"])
        return yes / (yes + no)

    def total(rows: Column, value) -> Column:
        return F.aggregate(F.transform(rows, value), F.lit(0.0), lambda a, x: a + x)

    def step(state: Column, _: Column) -> Column:
        soft = F.transform("rows", lambda r: F.struct(
            r["no"].alias("no"), r["v"].alias("v"), r["n"].alias("n"), posterior(r, state).alias("p")))

        def rate(j, weight):
            voted = total(soft, lambda r: F.when(F.get(r["v"], j) != 0, r["n"] * weight(r)).otherwise(0.0))
            yes = total(soft, lambda r: F.when(F.get(r["v"], j) == 1, r["n"] * weight(r)).otherwise(0.0))
            return (yes + 1) / (voted + 2)

        return F.struct(
            F.transform(kinds, lambda k: (total(soft, lambda r: F.when(r["no"] == k, r["n"] * r["p"]).otherwise(0.0)) + 1)
                        / (total(soft, lambda r: F.when(r["no"] == k, r["n"]).otherwise(0.0)) + 2)).alias("share"),
            F.transform(labelers, lambda j: rate(j, lambda r: r["p"])).alias("hit"),
            F.transform(labelers, lambda j: rate(j, lambda r: 1 - r["p"])).alias("miss"))

    start = F.struct(F.transform(kinds, lambda k: F.lit(0.5)).alias("share"),
                     F.transform(labelers, lambda j: F.lit(0.8)).alias("hit"),
                     F.transform(labelers, lambda j: F.lit(0.3)).alias("miss"))
    one = one.select("rows", F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, step).alias("state"))
    return one.select("state", F.transform("rows", lambda r: F.struct(
        r["no"].alias("no"), r["votes"].alias("votes"), r["n"].alias("n"),
        posterior(r, F.col("state")).alias("p"))).alias("rows"))


def accepted_keys(spans: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """``spans(no, votes, features)`` of the whole corpus -> the ``(no, votes, features)`` combinations that the final
    classifier accepts. Everything after the first aggregation is bounded by the number of combinations."""
    keys = landed(spans.groupBy("no", "votes", "features").agg(F.count("*").alias("n")), "keys")
    soft = (reliabilities(keys.groupBy("no", "votes").agg(F.sum("n").alias("n")), iterations)
            .select(F.explode("rows").alias("r")).select("r.no", "r.votes", "r.p"))
    weighed = landed(keys.join(soft, ["no", "votes"]), "weighed")
    parts = F.concat(F.split("features", r"\|"),
                     F.transform(F.split("votes", ","), lambda v, i: F.concat_ws(":", i.cast("string"), v)))
    long = weighed.select("no", "votes", "features", "n", "p", F.explode(parts).alias("part"))
    by_part = long.groupBy("no", "part").agg(F.sum(F.col("n") * F.col("p")).alias("yes"),
                                             F.sum(F.col("n") * (1 - F.col("p"))).alias("no_n"))
    by_kind = weighed.groupBy("no").agg(F.sum(F.col("n") * F.col("p")).alias("all_yes"),
                                        F.sum(F.col("n") * (1 - F.col("p"))).alias("all_no"))
    scored = long.join(by_part, ["no", "part"]).join(by_kind, "no").groupBy("no", "votes", "features").agg(
        F.sum(F.log((F.col("yes") + 1) / (F.col("all_yes") + 2)) - F.log((F.col("no_n") + 1) / (F.col("all_no") + 2)))
        .alias("evidence"),
        F.max(F.log((F.col("all_yes") + 1) / (F.col("all_no") + 1))).alias("prior"))
    return scored.where("evidence + prior > 0").select("no", "votes", "features")


def personal_spans(docs: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_confirmed)``, one row per input row.

    Null or empty text: no spans (the digest of an empty string). Repeated rows are judged one by one. Spans are in
    order of kind, then start. ``n_added`` counts accepted spans of the wider kinds, ``n_confirmed`` base spans that the
    classifier accepts too. Other columns are ignored; an empty table gives an empty result.
    """
    rows = landed(candidates(docs), "personal")
    each = rows.select("row_id", F.explode(F.concat("base", "added")).alias("s")).select("row_id", "s.*")
    accepted = landed(accepted_keys(each, iterations), "accepted")
    more = F.col("no") > len(BASE)
    judged = each.join(accepted, ["no", "votes", "features"]).groupBy("row_id").agg(
        F.count_if(more).alias("n_added"), F.count_if(~more).alias("n_confirmed"),
        F.collect_list(F.when(more, F.struct("no", "start", "end"))).alias("more"))
    plain = F.transform("base", lambda s: F.struct(s["no"], s["start"], s["end"]))
    every = F.when(F.size("more") > 0, F.concat(plain, F.sort_array("more"))).otherwise(plain)
    return rows.select("row_id", "doc_id", "base").join(judged, "row_id", "left").select(
        "doc_id", *[kind_count(F.col("base"), n + 1).alias(f"n_{k}") for n, k in enumerate(BASE)],
        F.sha2(span_text(F.col("base"), KINDS), 256).alias("base_sha256"),
        span_text(every, KINDS).alias("spans"),
        F.coalesce("n_added", F.lit(0)).cast("long").alias("n_added"),
        F.coalesce("n_confirmed", F.lit(0)).cast("long").alias("n_confirmed"))


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` with the spans ``(start, end, no)`` replaced by their kinds. Of spans that overlap, the first one (by start,
    then kind) names what is replaced, and all that any of them covers is replaced."""
    order = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["no"], s["end"])))
    ends = prefix_max(F.transform(order, lambda s: s["end"]))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def piece(s: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
        kept = F.when(s["start"] > before, F.substring(text, before + 1, s["start"] - before)).otherwise("")
        return F.concat(kept, F.when(s["start"] >= before, F.get(names, s["no"] - 1)).otherwise(""))

    rest = F.substring(text, F.get(ends, F.size(ends) - 1) + 1, F.length(text))
    return F.when(F.size(order) > 0, F.concat(F.array_join(F.transform(order, piece), ""), rest)).otherwise(text)


def redacted(docs: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """``docs`` with every base match and every accepted wider match in ``text`` replaced by its kind (``[EMAIL]``).

    The spans are those of :func:`personal_spans`, judged once on the text as it came. Null texts stay null, other columns
    are untouched whatever their names, rows are never dropped or merged; an empty table gives an empty result. What the
    classifier accepts is one array of at most ``kinds * 3^4 * features`` codes, read as a scalar subquery.
    """
    rows = landed(candidates(docs, carry=True), "personal")
    each = rows.select(F.explode(F.concat("base", "added")).alias("s")).select("s.*")
    accepted = landed(accepted_keys(each, iterations), "accepted")

    def code(no: Column, votes: Column, features: Column) -> Column:
        return F.concat_ws("/", no.cast("string"), votes, features)

    known = accepted.where(F.col("no") > len(BASE)).agg(F.collect_set(
        code(F.col("no"), F.col("votes"), F.col("features"))).alias("codes")).scalar()
    rows = rows.withColumn("codes", known)
    more = F.filter("added", lambda s: F.array_contains(F.col("codes"), code(s["no"], s["votes"], s["features"])))
    text = without_spans(F.col("doc.text").cast("string"), F.concat("base", more))
    return rows.select(*[text.alias("text") if c == "text" else F.col(f"doc.{quoted(c)}").alias(c)
                         for c in docs.columns])
