"""Log and text questions on hand-written files read through the text sources."""

from commitlens.operators import logs as L
from commitlens.operators import text as X
from commitlens.session import scratch_path
from commitlens.sources import sinks
from commitlens.functions.fields import BLANKS as BLANKS_RE
from commitlens.sources.text import list_files, read_files_in_order, read_lines

ACCESS = """10.0.0.153 - - [10/Mar/2004:12:02:59 -0800] "POST /cgi-bin/mailgraph2.cgi HTTP/1.1" 200 2987
10.0.0.1 - - [10/Mar/2004:12:03:00 -0800] "GET /search?q=POST HTTP/1.1" 200 100
10.0.0.2 - - [10/Mar/2004:12:03:01 -0800] "POST /a HTTP/1.1" 200 -
10.0.0.2 - - [10/Mar/2004:12:03:02 -0800] "POST /b HTTP/1.1" 200 2987
short POST line
10.0.0.3 - - [10/Mar/2004:12:03:03 -0800] "GET /x HTTP/1.1" 404 7
10.0.0.4 - - [10/Mar/2004:12:03:04 -0800] "GET /y HTTP/1.1" 200 8
"""


def _write(spark, name, text):
    import os
    folder = scratch_path(spark, name)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(text)
    return folder, path


def test_access_log_questions(spark):
    folder, path = _write(spark, "access_log", ACCESS)
    lines = read_lines(spark, path)
    post = [tuple(r) for r in L.post_requests(lines).orderBy("line").select("time", "client", "path", "status", "size").collect()]
    assert post[0] == ("10/Mar/2004:12:02:59", "10.0.0.153", "/cgi-bin/mailgraph2.cgi", "200", "2987")
    assert len(post) == 5  # POST anywhere in the line, the GET search line and the short line included
    assert [tuple(r) for r in L.largest_post(lines).collect()] == [("10.0.0.2", "/b")]
    assert [tuple(r) for r in L.top_post_client(lines).collect()] == [("10.0.0.2", 2)]
    gets = [r.request for r in L.first_requests(lines).collect()]
    assert gets == ["GET /search?q=POST HTTP/1.1", "GET /x HTTP/1.1", "GET /y HTTP/1.1"]
    csv = L.to_csv_columns(lines).orderBy("line").first()
    assert (csv.client, csv.time, csv.method, csv.path, csv.status, csv.size) == (
        "10.0.0.153", "10/Mar/2004:12:02:59", "POST", "/cgi-bin/mailgraph2.cgi", "200", "2987")
    out = scratch_path(spark, "csv-out")
    sinks.write_csv(L.to_csv_columns(lines).drop("file", "line"), out)
    assert spark.read.csv(out).count() == 7
    inv = list_files(spark, folder, "*_log*").collect()
    assert len(inv) == 1 and inv[0].length == len(ACCESS.encode())


def test_short_post_line_is_cut_like_the_pipeline(spark):
    _, path = _write(spark, "short_log", "short POST line\n")
    r = L.post_requests(read_lines(spark, path)).first()
    # fields 4, 1, 7, 9, 10 -> ",short,,," with the first character cut
    assert (r.time, r.client, r.path, r.status, r.size) == ("short", "", "", "", "")


BOOK1 = 'Far far away, behind the word mountains. Far-off lands\n"i think" said i i.\n... i am\nThe End'
BOOK2 = "Second file. It has i in it.\n"


def test_book_questions(spark):
    import os
    folder = scratch_path(spark, "book")
    os.makedirs(folder)
    for name, text in [("a_intro.txt", BOOK1), ("b_chapter.txt", BOOK2)]:
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(text)
    docs = read_files_in_order(spark, folder + "/*.txt").withColumnRenamed("file", "doc")
    top = {r.word: r.n for r in X.top_words(docs, k=100).collect()}
    assert top["far"] == 2 and top["faroff"] == 1 and top["i"] == 5 and "" not in top
    first = [r.sentence for r in X.first_sentences(docs, n=4, order="doc").collect()]
    assert first == ["Far far away, behind the word mountains", "Far-off lands", '"i think" said i i', "i am"]
    fixed = {os.path.basename(r.doc): r.text for r in X.fix_lower_i(docs).collect()}
    assert fixed["a_intro.txt"].splitlines()[1] == '"I think" said I i.'
    assert fixed["a_intro.txt"].splitlines()[2] == "... I am"
    assert fixed["b_chapter.txt"] == "Second file. It has I in it.\n"
    wb = {os.path.basename(r.doc): r.text for r in X.fix_lower_i(docs, word_boundary=True).collect()}
    assert wb["a_intro.txt"].splitlines()[1] == '"I think" said I I.'


def test_line_order_survives_many_splits(spark):
    lines = [f"10.0.0.{i % 250} - - [10/Mar/2004:12:00:{i % 60:02d} -0800] \"{'GET' if i % 3 else 'POST'} /p{i} HTTP/1.1\" 200 {i}"
             for i in range(20000)]
    _, path = _write(spark, "big_log", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_lines(spark, path)
        assert df.rdd.getNumPartitions() > 10
        got = [r.value for r in df.orderBy("file", "line").collect()]
        first = [r.request for r in L.first_requests(df, "GET", 4).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == lines
    assert first == ["GET /p1 HTTP/1.1", "GET /p2 HTTP/1.1", "GET /p4 HTTP/1.1", "GET /p5 HTTP/1.1"]


def test_book_questions_as_one_concatenated_stream(spark):
    import os
    folder = scratch_path(spark, "book-cat")
    os.makedirs(folder)
    files = [("a_intro.txt", BOOK1), ("b_chapter.txt", BOOK2), ("c_glue.txt", "Glue"), ("d_end.txt", "word. tail")]
    for name, text in files:
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(text)
    docs = read_files_in_order(spark, folder + "/*.txt")
    top = {r.word: r.n for r in X.top_words(docs, k=100, join_files=True, order="file").collect()}
    # "The End" + "Second file." -> "endsecond"; "... in it.\n" + "Glue" + "word. tail" -> "glueword"
    assert top.get("endsecond") == 1 and "end" not in top and "second" not in top
    assert top.get("glueword") == 1 and "glue" not in top and top["i"] == 5
    per_record = {r.word: r.n for r in X.top_words(docs.withColumnRenamed("file", "doc"), k=100).collect()}
    assert per_record["end"] == 1 and "endsecond" not in per_record
    sents = [r.sentence for r in X.first_sentences(docs, n=10, order="file", join_files=True).collect()]
    assert sents == ["Far far away, behind the word mountains", "Far-off lands", '"i think" said i i', "i am",
                     "The EndSecond file", "It has i in it", "Glueword", "tail"]


def test_concatenated_tokens_of_glued_files(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", "c", "", "d e f", "g", "h i"])], "doc long, text string")
    for parts in (1, 5):
        got = sorted(map(tuple, X.concatenated_tokens(docs.repartition(parts), "doc", "text", BLANKS_RE).collect()))
        assert [t for _, _, t in got] == ["a", "bcd", "e", "fgh", "i"]  # cat: "a bcd e fgh i"


def test_cat_word_counts_equal_duckdb_concatenation(spark):
    import oracle
    from commitlens.plans.testbed import table
    sf = "/root/testdata/sf0.001"
    got = X.top_words(table(spark, sf, "documents"), k=10_000_000, join_files=True, order="doc_id")
    sql = r"""
    WITH src AS (SELECT string_agg(text, '' ORDER BY doc_id) AS text FROM documents),
    w AS (SELECT unnest(regexp_split_to_array(
              translate(regexp_replace(text, '[!-/:-@\[-`{-~]', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\t\n\f\r ]+')) AS word FROM src)
    SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY word"""
    ok, msg = oracle.compare(got, sql, sf)
    assert ok, msg
    # and the gluing is visible: some words exist only in the concatenation
    per_record = {r.word for r in X.top_words(table(spark, sf, "documents"), k=10_000_000).collect()}
    assert {r.word for r in got.collect()} - per_record
