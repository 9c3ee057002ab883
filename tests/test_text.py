"""Scalar functions against the Python functions they stand for."""

from __future__ import annotations

import os
import re
from urllib.parse import urlparse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions import text
from corpusmill.functions.html import html_to_markdown
from corpusmill.functions.templates import template_column

settings.register_profile(
    "spark", max_examples=4, deadline=None, derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow, HealthCheck.large_base_example,
                           HealthCheck.data_too_large],
)
settings.load_profile("spark")


def batch(alphabet, max_size=30):
    return st.lists(st.text(alphabet=alphabet, max_size=max_size), min_size=200, max_size=300)


def apply(spark, values, fn):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in rows.select("i", fn(F.col("v"))).orderBy("i").collect()]


@given(batch("ab./ \n"))
def test_extension_is_splitext(spark, paths):
    assert apply(spark, paths, text.extension) == [os.path.splitext(p)[1] for p in paths]


def uris():
    scheme = st.sampled_from(["", "store:", "file:", "http:", "https:", "HTTP:", "x-y.z:", "1a:", "ftp:"])
    rest = st.text(alphabet="ab/;?#:. %\t\n", max_size=25)
    return st.lists(st.builds(lambda s, r: s + r, scheme, rest), min_size=200, max_size=300)


@given(uris())
def test_doc_uri_is_urlparse_path(spark, paths):
    assert apply(spark, paths, text.doc_uri) == [urlparse(p).path.lstrip("/") for p in paths]


@given(batch("a \n\t\r\x0b\x1c\x1f\x85\xa0 　"))
def test_blank_lines_and_tokens(spark, values):
    assert apply(spark, values, text.squeeze_blank_lines) == [re.sub(r"\n{3,}", "\n\n", v.strip()) for v in values]
    assert apply(spark, values, text.tokens) == [v.split() for v in values]


def test_user_slug(spark):
    mails = ["First.Last@example.com", "A.B.C@x@y", "x" * 50 + "@z", "no-at.sign", ""]
    want = [m.split("@")[0].replace(".", "").lower()[:35] for m in mails]
    assert apply(spark, mails, text.user_slug) == want


def test_flag_is_case_sensitive(spark):
    assert apply(spark, ["a test", "contested", "TEST", ""], text.flag_test) == ["test", "test", "not test", "not test"]


def test_unquote(spark):
    assert apply(spark, ["`a`.`b c`", "plain"], text.unquote) == ["a.b c", "plain"]


def test_invalid_utf8_is_null(spark):
    rows = spark.createDataFrame([(b"caf\xc3\xa9",), (b"\xff\xfe",), (b"",)], "c binary")
    assert [r[0] for r in rows.select(text.utf8_text("c")).collect()] == ["café", None, ""]


def test_ordered_join(spark):
    rows = spark.createDataFrame([(1, 2, "b"), (1, 10, "c"), (1, 1, "a"), (2, 0, "z")], "d int, o int, t string")
    got = rows.groupBy("d").agg(text.ordered_join("o", "t").alias("t")).collect()
    assert {r["d"]: r["t"] for r in got} == {1: "a\nb\nc", 2: "z"}


def test_template(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    assert df.select(template_column("{{k}} {a}|{b}|{a}", a="a", b="b")).first()[0] == "{k} x||x"


def test_template_unknown_field():
    import pytest

    with pytest.raises(KeyError):
        template_column("{nope}")


def test_markdown(spark):
    page = (
        "<html><head><title>T</title></head><script>var t='</p>';</script><body><!-- no --><h1>One</h1><h3 id=x>Three</h3>"
        "<p>a &amp;lt; b<b>bold</b> <em>it</em></p><ul><li><a class=q href=\"/u\">link</a><li>two</ul>x<hr>y</body></html>"
    )
    want = "T\n\n# One\n\n### Three\n\na &lt; b**bold** *it*\n\n* [link](/u)\n* two\n\nx\n\n---\n\ny"
    assert apply(spark, [page], html_to_markdown) == [want]


def test_markdown_loses_no_text(spark):
    pages = {
        "<body><nav>menu<h1>Title</h1><p>whole article text</p><footer>foot</footer></body>": "menu\n\n# Title\n\nwhole article text\n\nfoot",
        "<head><script>gone</script><title>T</title></head><script>kept": "T\n\nkept",
        "<table><tr><td>alpha</td><td>beta</td></tr></table>": "| alpha | beta |",
        "&#8211; &#x1F600; &#0; &#55296; &#99; x&#y": "\u2013 \U0001f600 &#0; &#55296; c x&#y",
        "<a href='u'>l</a> <img src=\"s\" alt=\"a\"> <img src=\"s\"> <code>c</code>": "[l](u) ![a](s) ![](s) `c`",
        "<pre><code>a\nb</code></pre>": "```\na\nb\n```",
    }
    assert apply(spark, list(pages), html_to_markdown) == list(pages.values())


def test_white_space_is_cut_in_linear_time(spark):
    import time

    page = "a" + " " * 100_000 + "b" + "\u3000\x1f\n" * 10
    apply(spark, ["x"], html_to_markdown)
    start = time.perf_counter()
    assert apply(spark, [page], text.strip) == ["a" + " " * 100_000 + "b"]
    assert apply(spark, [page], html_to_markdown) == ["a" + " " * 100_000 + "b"]
    assert time.perf_counter() - start < 5
