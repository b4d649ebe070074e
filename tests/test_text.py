import html
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from abstractmill.functions.text import (
    WS,
    WS_CHARS,
    WS_RUN,
    contains_any,
    csv_items,
    decode_entities,
    last_sentence,
    normalize,
    preview,
    strip,
)


def plain_normalize(text):
    if not text:
        return ""
    return re.sub(r"\s+", " ", re.sub(r"<[^>]+>", "", html.unescape(text))).strip()


def test_whitespace_list_is_what_str_strip_removes():
    assert set(WS_CHARS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_white_space_patterns_match_what_str_isspace_says(spark):
    df = spark.createDataFrame([(c,) for c in map(chr, range(1, 0x3100))], "x string")
    got = df.select("x", F.col("x").rlike(WS).alias("a"), F.col("x").rlike(WS_RUN).alias("b"))
    assert all(r.a == r.b == r.x.isspace() for r in got.collect())


def test_normalize_examples(evaluate):
    got = evaluate(
        normalize,
        [
            None, "", "<p>a <b>bold</b> move</p>", "5 &gt; 3 &amp; 2 &lt; 4", "a \t\n  b ",
            "p &lt; 0.05 and q &gt; 0.1", "p < 0.05 and q > 0.1", "x  y\u0085",
            "&eacute;&#233;&#xe9;&notit;", "<div><span>in</span></div>", "AT&T", "<>",
        ],
    )
    assert got == [
        "", "", "a bold move", "5 > 3 & 2 < 4", "a b", "p 0.1", "p 0.1", "x y",
        "ééé¬it;", "in", "AT&T", "<>",
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(
            alphabet=st.sampled_from(list("ab <>&;#x39lgtampnbs\t\n  \u0085\u001cé")),
            max_size=40,
        ),
        min_size=30,
        max_size=60,
    )
)
def test_normalize_equals_plain_python(evaluate, texts):
    assert evaluate(normalize, texts) == [plain_normalize(t) for t in texts]


def test_strip_removes_unicode_space(evaluate):
    texts = ["  a b　\n", "", "\x1c", None]
    assert evaluate(strip, texts) == ["a b", "", "", None]


def test_contains_any_is_literal_and_null_safe(evaluate):
    got = evaluate(lambda x: contains_any(x, ["5-fu", "pd-l1"]), ["5xfu", "a 5-fu", "pd-l1", None, ""])
    assert got == [False, True, True, False, False]


def test_last_sentence(evaluate):
    filler = "An opening sentence that goes on and on so that the text is long enough to count. "
    got = evaluate(
        last_sentence,
        [
            filler + "  The second sentence is the finding. Short. ",
            filler + "It ends without a dot but is long enough",
            "One long sentence but the text is short.",
            "." * 150,
            None,
        ],
    )
    assert got == [
        "The second sentence is the finding",
        "It ends without a dot but is long enough",
        None, None, None,
    ]


def test_preview_cuts_only_long_text(evaluate):
    assert evaluate(lambda x: preview(x, 3), ["abc", "abcd", None, ""]) == ["abc", "abc...", "", ""]


def test_csv_items(evaluate):
    got = evaluate(csv_items, ["a, b ,,  c", "", None, " , "])
    assert got == [["a", "b", "c"], [], [], []]


def test_entities_decode_as_in_plain_python(evaluate):
    texts = [
        "&amp;", "&amp;lt; &amp;amp;", "&lt;&gt;&lt;", "a&amp;b&amp;c", "&&amp;&", "&#;&#x;&#38;&#x26;&#X26", "&",
        "&#0;&#1;&#128;&#xD800;&#1114112;&#128512;", "&notit;&notin;&not", "&" + "a" * 32 + ";", "&" + "a" * 40 + ";&lt;",
        "&CounterClockwiseContourIntegral;", "😀&😀;😀&eacute;", "&amp\n&lt\t&gt\f&quot\r&nbsp", "&\u0085amp;&　;", "", None,
        "x & y", "plain", "&Tab;&NewLine;&#32;&#13;", "&copy=1&reg=2&amp=3", "\x01&foo\x01bar;",
    ] + [f"{'&lt;' * i}{i}&#{i};" for i in range(300)]
    assert evaluate(decode_entities, texts) == [t and html.unescape(t) for t in texts]


def test_only_references_travel_to_python(spark, python_bytes):
    texts = spark.range(0, 400, 1, 2).selectExpr("concat(repeat('long text ', 5000), '&amp; ', id) as x")
    assert 0 < python_bytes(texts.select(decode_entities(F.col("x")))) < 200_000  # of 20 MB
