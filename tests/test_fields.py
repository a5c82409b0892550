import hashlib
import uuid


from commitlens.functions import fields as FF
from commitlens.functions.labels import fizzbuzz, traffic_light_rule


def test_extension_rules(spark):
    # D-3 fixture names
    names = ["a.java", "a.b/README", "foo.", "...", "README", ".gitignore", "x.myjava", None]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = [tuple(r) for r in df.select(FF.extension("f", "unknown"), FF.extension("f", "self")).collect()]
    assert got == [("java", "java"), ("b/README", "b/README"), ("foo", "foo"), ("unknown", "unknown"),
                   ("unknown", "README"), ("gitignore", "gitignore"), ("myjava", "myjava"), ("unknown", None)]


def _msb(h1: str) -> int:
    # name-based UUID (version 3) of the text, most significant 64 bits as a signed long
    u = uuid.UUID(bytes=hashlib.md5(h1.encode("utf-8")).digest(), version=3)
    v = u.int >> 64
    return v - (1 << 64) if v >= (1 << 63) else v


def test_md5_long_matches_reference_rule(spark):
    names = ["GitHub", "Oscar Näzell", "", "repo/x", "torvalds/linux"]
    # add names whose MD5 hex starts with 0
    i = 0
    while sum(1 for n in names if hashlib.md5(n.encode()).hexdigest().startswith("0")) < 3:
        n = f"user{i}"
        if hashlib.md5(n.encode()).hexdigest().startswith("0"):
            names.append(n)
        i += 1
    df = spark.createDataFrame([(n,) for n in names], "s string")
    got = dict(df.select("s", FF.md5_long("s").alias("id")).collect())
    for n in names:
        assert got[n] == _msb(format(int(hashlib.md5(n.encode("utf-8")).hexdigest(), 16), "x")), n


def test_day_label_and_url_parts(spark):
    df = spark.createDataFrame([(h,) for h in [4, 5, 11, 12, 16, 17, 20, 21, 0]], "h int")
    assert [r[0] for r in df.select(FF.day_label("h")).collect()] == [
        "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night", "night"]
    u = spark.createDataFrame([("https://api.github.com/repos/foo/foobar/commits/abc",), ("short",)], "url string")
    got = [tuple(r) for r in u.select(FF.owner(), FF.repo_name(), FF.owner_repo_between()).collect()]
    assert got == [("foo", "foobar", "foo/foobar"), (None, None, "")]


def test_label_rules(spark):
    df = spark.createDataFrame([(15,), (9,), (10,), (7,)], "n int")
    assert [r[0] for r in df.select(fizzbuzz("n")).collect()] == ["FizzBuzz", "Fizz", "Buzz", "7"]
    t = spark.createDataFrame([("green", 9), ("orange", 3), ("orange", 4), ("red", 0), ("blue", 1)], "s string, t int")
    got = [tuple(r[0]) for r in t.select(traffic_light_rule("s", "t")).collect()]
    assert got == [(False, "ok: nothing wrong here"), (False, "ok: we allow it"), (True, "ok: too late"),
                   (True, "ok: waaay too late"), (False, "ERROR: (blue,1)")]


def test_punctuation_and_case(spark):
    df = spark.createDataFrame([("Far-off, ÉTÉ's \"i\"!",)], "t string")
    assert df.select(FF.ascii_lower(FF.strip_punctuation("t"))).first()[0] == "faroff ÉtÉs i"
