"""Bindings of the log (P15-P18, A18, O4) and text (A17, F7, F8) questions, with DuckDB oracles."""

from __future__ import annotations

from commitlens.operators import logs as L
from commitlens.operators.ordered import global_row_number
from commitlens.operators import text as X
from commitlens.plans.logview import ACCESS_LOG_CTE, ERROR_LOG_CTE, access_log, error_log
from commitlens.plans.registry import register
from commitlens.plans.testbed import table
from commitlens.session import landed_view, scratch_path
from commitlens.sources.sinks import write_csv
from commitlens.sources.text import read_lines

WA = "WITH " + ACCESS_LOG_CTE
# f(n): the n-th space-separated field of an access-log line, '' when absent (1-based).


def f(n: int, v: str = "value") -> str:
    return f"coalesce(string_split({v}, ' ')[{n}], '')"


_POST = f"""
, p AS (SELECT line, substr(concat_ws(',', {f(4)}, {f(1)}, {f(7)}, {f(9)}, {f(10)}), 2) AS csv FROM al
        WHERE contains(value, 'POST')),
pc AS (SELECT line, coalesce(string_split(csv, ',')[1], '') AS time, coalesce(string_split(csv, ',')[2], '') AS client,
              coalesce(string_split(csv, ',')[3], '') AS path, coalesce(string_split(csv, ',')[4], '') AS status,
              coalesce(string_split(csv, ',')[5], '') AS size FROM p)
"""


@register("log_csv", WA + f"""
SELECT line, {f(1)} AS client, substr({f(4)}, 2) AS time, substr({f(6)}, 2) AS method, {f(7)} AS path,
       {f(9)} AS status, {f(10)} AS size FROM al""")
def log_csv(spark, sf):
    return L.to_csv_columns(access_log(spark, sf)).drop("file")


@register("log_post_requests", WA + _POST + "SELECT line, time, client, path, status, size FROM pc")
def log_post_requests(spark, sf):
    return L.post_requests(access_log(spark, sf)).drop("file")


@register("log_largest_post", WA + _POST + """
SELECT client, path FROM pc
ORDER BY coalesce(TRY_CAST(regexp_extract(size, '^\\s*(-?[0-9]+(\\.[0-9]+)?)', 1) AS DOUBLE), 0) DESC,
         (client || ',' || path || ',' || size) DESC LIMIT 1""")
def log_largest_post(spark, sf):
    return L.largest_post(access_log(spark, sf))


@register("log_top_post_client", WA + _POST + """
SELECT client, count(*) AS n FROM pc GROUP BY client ORDER BY n DESC, client DESC LIMIT 1""")
def log_top_post_client(spark, sf):
    return L.top_post_client(access_log(spark, sf))


@register("log_file_missing", "WITH " + ERROR_LOG_CTE + """
SELECT line, value FROM el WHERE contains(value, 'File does not exist')""")
def log_file_missing(spark, sf):
    return L.lines_containing(error_log(spark, sf), "File does not exist").select("line", "value")


@register("log_first_gets", WA + """
SELECT line, regexp_extract(value, '"([^"]*)"', 1) AS request FROM al WHERE contains(value, 'GET')
ORDER BY line LIMIT 3""")
def log_first_gets(spark, sf):
    return L.first_requests(access_log(spark, sf)).drop("file")


def _log_files(spark, sf, view, name):
    """The rendered lines as text files in line order, read back through S4 (``read_lines``)."""
    path = landed_view(spark, name, sf, ["events"], lambda p: view(spark, sf).repartitionByRange("line")
                       .sortWithinPartitions("line").select("value").write.text(p))
    return read_lines(spark, path)


@register("log_file_csv", WA + f"""
SELECT {f(1)} AS client, substr({f(4)}, 2) AS time, substr({f(6)}, 2) AS method, {f(7)} AS path, {f(9)} AS status,
       {f(10)} AS size FROM al""")
def log_file_csv(spark, sf):
    """Log files read line by line, converted, written as CSV and read again."""
    rows = L.to_csv_columns(_log_files(spark, sf, access_log, "access-log")).drop("file", "line")
    path = scratch_path(spark, "log-csv")
    write_csv(rows, path)
    return spark.read.schema(rows.schema).option("emptyValue", "").option("nullValue", "\x00").csv(path)


@register("log_file_first_gets", WA + """
SELECT row_number() OVER (ORDER BY line) AS n, regexp_extract(value, '"([^"]*)"', 1) AS request FROM al
WHERE contains(value, 'GET') ORDER BY line LIMIT 3""")
def log_file_first_gets(spark, sf):
    """P18 in the order of files and lines."""
    first = L.first_requests(_log_files(spark, sf, access_log, "access-log"))
    return global_row_number(first, ["file", "line"], "n").select("n", "request")


@register("log_file_missing_lines", "WITH " + ERROR_LOG_CTE + """
SELECT row_number() OVER (ORDER BY line) AS n, value FROM el WHERE contains(value, 'File does not exist')""")
def log_file_missing_lines(spark, sf):
    """P17 over error-log files (S5), numbered in the order of files and lines."""
    found = L.lines_containing(_log_files(spark, sf, error_log, "error-log"), "File does not exist")
    return global_row_number(found, ["file", "line"], "n").select("n", "value")


# ---------------------------------------------------------------- text over documents / conversations

_PUNCT_DUCK = "[!-/:-@\\[-`{-~]"
_WORDS = f"""
, w AS (SELECT unnest(regexp_split_to_array(
            translate(regexp_replace(text, '{_PUNCT_DUCK}', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\\t\\n\\f\\r ]+')) AS word FROM src)
SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY word ORDER BY n DESC, word DESC LIMIT 10"""


@register("text_top_words", "WITH src AS (SELECT text FROM documents)" + _WORDS)
def text_top_words(spark, sf):
    return X.top_words(table(spark, sf, "documents"))


@register("text_top_words_conversations", "WITH src AS (SELECT text FROM conversations)" + _WORDS)
def text_top_words_conversations(spark, sf):
    return X.top_words(table(spark, sf, "conversations"))


@register("text_first_sentences", """
WITH s AS (SELECT doc_id, u.pos, trim(u.sentence) AS sentence FROM documents,
           unnest(regexp_split_to_array(text, '[.\\n]+')) WITH ORDINALITY AS u(sentence, pos))
SELECT doc_id, pos - 1 AS pos, sentence FROM s WHERE sentence <> '' ORDER BY doc_id, pos LIMIT 7""")
def text_first_sentences(spark, sf):
    return X.first_sentences(table(spark, sf, "documents"))


@register("text_first_sentences_cat", """
WITH s AS (SELECT list_filter(list_transform(regexp_split_to_array(string_agg(text, '' ORDER BY doc_id), '[.\\n]+'),
                  lambda x: trim(x)), lambda x: x <> '')[1:7] AS l FROM documents)
SELECT unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS sentence FROM s""")
def text_first_sentences_cat(spark, sf):
    """F7 with `cat` semantics: sentences may run on from one document into the next."""
    return X.first_sentences(table(spark, sf, "documents"), join_files=True)


@register("text_fix_i", """
SELECT doc_id, replace(replace(text, ' i ', ' I '), '"i ', '"I ') AS text FROM documents""")
def text_fix_i(spark, sf):
    return X.fix_lower_i(table(spark, sf, "documents").select("doc_id", "text"))


@register("text_top_words_cat", "WITH src AS (SELECT string_agg(text, '' ORDER BY doc_id) AS text FROM documents)"
          + _WORDS)
def text_top_words_cat(spark, sf):
    """A17 with `cat` semantics: documents are files concatenated in doc_id order, so a document that does not end
    with a blank glues its last word to the next document's first word (no whole-corpus string is built)."""
    return X.top_words(table(spark, sf, "documents"), join_files=True, order="doc_id")
