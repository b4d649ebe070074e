import json

from pyspark.sql import functions as F

from abstractmill.operators.cleaning import clean_abstracts


def _raw(spark, *payloads):
    rows = [(str(i), p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "pmid string, raw_json string")


def test_clean_rows(spark):
    good = {
        "pmid": "other", "title": " <i>T</i>\n1 ", "abstract_text": "<p>Long &gt; enough&nbsp;text</p>",
        "authors": ["A, B"], "journal": None, "pub_date": "2023-02-28", "mesh_terms": ["X"],
    }
    df = clean_abstracts(
        _raw(
            spark,
            good,
            {**good, "pub_date": "2023-02-30", "authors": None},
            {**good, "abstract_text": "<p>0123456789</p>"},
            {**good, "abstract_text": "<p>0123456789a</p>"},
            {**good, "abstract_text": None},
            {**good, "abstract_text": "<b><i></i></b>         "},
            "not json",
            {**good, "mesh_terms": "oops", "pub_date": "soon"},
        ),
        F.lit("2024-01-01"),
    )
    rows = {r.pmid: r for r in df.collect()}
    assert sorted(rows) == ["0", "1", "3", "7"]
    assert rows["0"].title == "T 1" and rows["0"].abstract_text == "Long > enough text"
    assert rows["0"].journal == "" and rows["0"].authors == ["A, B"]
    assert str(rows["0"].pub_date) == "2023-02-28" and str(rows["0"].cleaned_at)[:10] == "2024-01-01"
    assert rows["1"].pub_date is None and rows["1"].authors is None
    assert rows["7"].pub_date is None and rows["7"].mesh_terms is None and rows["7"].authors == ["A, B"]


def test_one_parse_and_one_python_step(spark):
    plan = clean_abstracts(_raw(spark, {"abstract_text": "x"}))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1
    assert text.count("from_json") == 1
    assert text.count("regexp_replace") == 6  # tags and white space of three texts


def test_only_references_of_all_texts_travel_to_python(spark, python_bytes):
    long = {c: f"<p>{'long text ' * 10}&amp; more</p> " * 200 for c in ("title", "abstract_text", "journal")}
    raw = _raw(spark, *[long] * 40)
    got = clean_abstracts(raw)
    assert python_bytes(got) < 500_000  # of 2.9 MB
    assert {len(set(r)) for r in got.select("title", "abstract_text", "journal").collect()} == {1}
    assert got.first().abstract_text == " ".join(["long text " * 10 + "& more"] * 200)
