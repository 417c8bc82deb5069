"""Labels, scores and URL expressions."""

import os
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from veracity_prep.functions import labels as L
from veracity_prep.functions import scores as S
from veracity_prep.functions import urls as U


def test_statement_labels(each):
    raw = ["pants-fire", "false", "barely-true", "half-true", "mostly-true", "true", "TRUE", "other", None]
    assert each(L.statement_label, raw) == ["false", "false", "false", "mixed", "true", "true", "unknown", "unknown", "unknown"]


FLAGS = ["0", "1", "2", "x", "1.5", None, "absent"]


def verdict(m, t):
    """The truth table, written out."""
    there_m, there_t = m != "absent", t != "absent"
    if there_m and there_t:
        return {("0", "0"): "unverified", ("0", "1"): "true", ("1", "0"): "false"}.get((m, t))
    if there_m:
        return {"0": "unverified", "1": "false"}.get(m)
    return None


def test_annotation_truth_table(spark):
    cases = [(m, t) for m in FLAGS for t in FLAGS]
    df = spark.createDataFrame([(None if m == "absent" else m, None if t == "absent" else t, m != "absent", t != "absent", verdict(m, t)) for m, t in cases], "m string, t string, hm boolean, ht boolean, want string")
    got = L.annotation_label(F.col("m"), F.col("t"), F.col("hm"), F.col("ht"))
    assert df.where(~got.eqNullSafe(F.col("want"))).count() == 0
    codes = {r[0]: r[1] for r in df.select(got, L.label_code(got)).distinct().collect()}
    assert codes == {None: None, "false": 0, "true": 1, "unverified": 2}


def test_other_labels(each):
    assert each(L.article_label, ["fake", "real", "FAKE", None]) == ["false", "true", "true", "true"]
    assert each(L.annotation_bucket, ["Fake", "REAL", "humor", None]) == ["fake", "real", "unknown", "unknown"]
    assert each(L.splittable, ["true", "mixed", "unknown", None]) == [True, True, False, False]
    assert each(lambda c: L.thread_label(F.lit("non-rumours"), c), ["false", None]) == ["true", "true"]
    assert each(lambda c: L.thread_label(F.lit("rumours"), c), ["false", None]) == ["false", "unknown"]


def test_reliability(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 5.0), (None, float("nan"), None, 0.0, None), (0.0, 0.0, 0.0, 0.0, 2.9)], "a double, b double, c double, d double, e double")
    names = dict(zip("abcde", ("barely_true", "false", "half_true", "mostly_true", "pants_on_fire"), strict=True))
    history = {n: S.count_or_zero(F.col(c)) for c, n in names.items()}
    rows = df.select(S.speaker_total(history), S.reliability_score(history)).collect()
    assert [tuple(r) for r in rows] == [(15, (3 + 1.5 + 0.25 - 2.5) / 15), (0, None), (2, -0.5)]


def test_formats(spark):
    df = spark.createDataFrame([(640, 480, {"Make": "m"}), (1, 3, {}), (5, 0, None)], "w int, h int, t map<string, string>")
    w, h = F.col("w"), F.col("h")
    rows = df.select(S.size_text(w, h), S.two_decimals(S.aspect_ratio(w, h)), S.has_tags(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("640x480", "1.33", True), ("1x3", "0.33", False), ("5x0", None, False)]


def test_two_decimals_like_python(spark):
    sizes = [(w, h) for w in range(1, 400, 3) for h in (1, 3, 7, 8, 40, 80, 200, 333, 1000, 8000)]
    df = spark.createDataFrame(sizes, "w int, h int")
    rows = df.select("w", "h", S.two_decimals(S.aspect_ratio(F.col("w"), F.col("h")))).collect()
    assert [r[2] for r in rows] == [f"{w / h:.2f}" for w, h, _ in rows]


URLS = [
    "http://a.org/x/pic.png", "https://a.org/pic", "http://a.org/", "http://a.org", "http://a.org/a%20b%2Bc+d.jpg?x=1#f", "http://a.org/%zz%e9.gif",
    "http://a.org/caf%C3%A9.jpeg", "http://a.org/d/p;v=1.png", "//a.org/n.gif?q=/z", "pic.one.two", "/only/path.", "http://a.org/.hidden", "http://a.org/..x",
    "http://a.org/a%2Fb.png", "http://a.org/q%3Fr.png", "http://a.org/" + "n" * 120 + ".jpeg", "http://a.org/ab:cd,é_-.png", " http://a.org/\tx.png", "http://a.org/x y.png",
    "http://a.org/???", "data:image/png", "",
]


def python_name(url):
    name = os.path.basename(unquote(urlparse(url).path))
    if not name:
        return None
    root, ext = os.path.splitext(name)
    name = (name if ext else f"{root}.jpg").split("?")[0]
    name = "".join(c for c in name if c.isalnum() or c in "._-")
    root, ext = os.path.splitext(name)
    return root[:95] + ext if len(name) > 100 else name


def test_file_names(each):
    got = each(U.file_name, URLS)
    fallback = each(U.fallback_name, URLS)
    want = [python_name(u) for u in URLS]
    assert got == [f if w is None else w for w, f in zip(want, fallback, strict=True)]
    assert all(len(f) == len("image_0000.jpg") for f in fallback)


def test_extensions(each):
    ext = [os.path.splitext(u)[1] for u in URLS]
    assert each(U.extension_or_jpg, URLS) == [e or ".jpg" for e in ext]
    assert each(U.format_name, URLS) == [e.lower()[1:] for e in ext]
    assert each(U.stem, ["a.b.c", ".x", "..x", "a..b", "a.", "a"]) == [os.path.splitext(n)[0] for n in ("a.b.c", ".x", "..x", "a..b", "a.", "a")]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<img src="a.png"><img alt="x" src=" b.png ">', ["a.png", "b.png"]),
        ('<img src="data:x"><img src=""><img src=\'c\'><img alt="n"> src="late"', ["late"]),
        ('src="before" <IMG src="upper">', []),
        ('<img src="open', []),
        (None, []),
    ],
)
def test_image_sources(value, html, want):
    assert value(U.html_image_urls, html) == want


def test_url_lists(spark):
    df = spark.createDataFrame([(["b", "a", "b"], '<img src="c">', "a"), (None, None, None), ([], "", "")], "l array<string>, h string, i string")
    assert [r[0] for r in df.select(U.all_image_urls(F.col("l"), F.col("h"), F.col("i"))).collect()] == [["a", "b", "c"], [], []]
    assert [r[0] for r in df.select(U.declared_image_urls(F.col("l"), F.col("i"))).collect()] == [["b", "a", "b", "a"], [], []]


def test_fetchable(each):
    assert each(U.is_http, ["http://a", "https://a", "ftp://a", "HTTP://a", "", None]) == [True, True, False, False, False, False]
