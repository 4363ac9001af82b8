import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presswerk.functions import similarity as s
from presswerk.functions import text as t


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()[0]


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for c in a:
        last = 0
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if c == d else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abcé 文", max_size=40), st.text("abcé 文", max_size=40))
def test_indel_ratio_is_lcs(a, b):
    expected = 2 * brute_lcs(a, b) / (len(a) + len(b)) if a and b else 0.0
    assert abs(s.indel_ratio(a, b) - expected) < 1e-12


def test_scalars(spark):
    assert one(spark, t.norm_text(F.col("a")), a="  Été \t À\nParis ") == "été à paris"
    assert one(spark, t.unicode_tokens(F.col("a")), a="Été à Paris_2") == ["été", "à", "paris_2"]
    assert one(spark, t.ascii_tokens(F.col("a")), a="Été a well-known x2") == ["well-known", "x2"]
    assert one(spark, t.normal_url(F.col("a")), a=" HTTP://U@Ex.ORG:80/A/b/?q=1#f ") == "http://u@ex.org:80/A/b"
    assert one(spark, t.url_domain(F.col("a")), a="https://www.News.example/x") == "news.example"
    assert one(spark, t.wall_clock(F.col("a")), a="2025-01-02T03:04:05+02:00") == "2025-01-02 03:04:05"
    assert one(spark, t.charset_of(F.col("a")), a='text/html; CHARSET="ISO-8859-1"') == "iso-8859-1"
    assert one(spark, t.themes_of(F.col("a")), a="TAX_A; ECON_B;TAX_C;;") == ["ECON", "TAX"]
    assert one(spark, t.tidy_lines(F.col("a")), a="a  b\r\n\n  c") == "a b\nc"
    assert one(spark, t.stable_excerpt(F.col("a"), 10), a="x" * 30) == "xxxxxxx\n...\nxxx"
    assert s.text_key("Été, 2024!") == "ete2024"


def test_article_id_falls_back_to_title_and_lead(spark):
    h = hashlib.md5(b"T||body").hexdigest()
    want = "-".join([h[:8], h[8:12], h[12:16], h[16:20], h[20:]])
    assert one(spark, t.article_id(F.col("u"), F.col("a"), F.col("b")), u="  ", a="T", b="body") == want


def test_jaccard_and_nulls(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], ["a"])], "x array<string>, y array<string>")
    assert [round(r[0], 6) for r in df.select(t.jaccard(F.col("x"), F.col("y"))).collect()] == [0.333333, 0.0]
    null = spark.createDataFrame([(None,)], "a string")
    assert null.select(t.norm_text(F.col("a")), t.normal_url(F.col("a")), t.tidy_lines(F.col("a"))).first() == ("", "", "")
