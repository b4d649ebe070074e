from pyspark.sql import functions as F

from abstractmill.functions.agreement import parse_record
from abstractmill.operators import review
from abstractmill.schemas import RECORD

REC = RECORD.simpleString()
EDIT = ("Stage IV", ["surgery"], [], 7, None)
OLD = ("Stage I", [], [], None, None)


def _ext(spark, rows):
    return spark.createDataFrame(
        rows,
        f"pmid string, extracted {REC}, original {REC}, confidence_score double, "
        "human_verified boolean, reviewer_notes string",
    )


def _decisions(spark, rows):
    return spark.createDataFrame(
        rows, f"pmid string, action string, edited {REC}, notes string, at int"
    )


def _click_in_order(ext, decisions):
    """What one update per decision, in order, leaves behind."""
    state = {k: [e, v, n] for k, e, _, _, v, n in ext}
    for k, action, edited, notes, _ in sorted(decisions, key=lambda d: d[4]):
        if k not in state or action == "skip":
            continue
        if action == "approve" and edited is not None:
            state[k][0] = edited
        state[k][1:] = [action == "approve", notes]
    return state


def test_decisions_equal_clicks_in_order(spark):
    ext = [(str(i), OLD, OLD, 0.2, None if i % 2 else False, "old") for i in range(9)]
    decisions = [
        ("0", "approve", EDIT, "a", 1),
        ("1", "approve", EDIT, "a", 1), ("1", "reject", None, "b", 2),
        ("2", "reject", None, "a", 1), ("2", "approve", None, "b", 2),
        ("3", "approve", EDIT, "a", 1), ("3", "approve", None, None, 2),
        ("4", "skip", EDIT, "a", 1),
        ("5", "approve", EDIT, "a", 3), ("5", "approve", OLD, "b", 2), ("5", "skip", None, "c", 9),
        ("6", "reject", EDIT, "a", 1),
        ("7", "approve", (None, None, None, None, None), "", 1),
        ("nobody", "approve", EDIT, "a", 1),
    ]
    got = review.apply_reviews(_ext(spark, ext), _decisions(spark, decisions), ["at"])
    state = {
        r.pmid: [tuple(r.extracted), r.human_verified, r.reviewer_notes] for r in got.collect()
    }
    assert state == _click_in_order(ext, decisions)
    assert all(tuple(r.original) == OLD for r in got.collect())


def _queue(spark):
    ext = [
        ("1", OLD, None, 0.4, True, None), ("2", OLD, None, None, False, None),
        ("3", OLD, None, 0.8, False, None), ("4", OLD, None, 0.2, None, None),
        ("5", OLD, None, 0.8, False, None), ("6", OLD, None, 0.1, False, None),
    ]
    cleaned = spark.createDataFrame(
        [(str(i), "T" * 90, "x" * 500 if i == 1 else "y" * 501) for i in range(1, 6)],
        "pmid string, title string, abstract_text string",
    )
    notes = spark.createDataFrame([("3", "note")], "pmid string, summary_text string")
    return review.review_queue(_ext(spark, ext), cleaned, notes)


def test_queue_order_and_join(spark):
    rows = review.with_previews(review.in_review_order(_queue(spark))).collect()
    assert [r.pmid for r in rows] == ["3", "5", "2", "1", "4"]
    by = {r.pmid: r for r in rows}
    assert by["3"].summary_text == "note" and by["5"].summary_text is None
    assert by["1"].title_preview == "T" * 80 + "..."
    assert by["1"].abstract_preview == "x" * 500 and by["2"].abstract_preview == "y" * 500 + "..."


def test_queue_filter(spark):
    keys = lambda df: sorted(r.pmid for r in df.collect())
    assert keys(review.filter_queue(_queue(spark))) == ["2", "3", "4", "5"]
    assert keys(review.filter_queue(_queue(spark), True)) == ["1", "2", "3", "4", "5"]
    assert keys(review.filter_queue(_queue(spark), False, 0.2)) == ["3", "4", "5"]


def test_edited_record(spark):
    df = spark.createDataFrame(
        [("", "a, b ,,", None, "12", ""), ("S", "", "x", "1x", "C"), ("S", "", "x", "", None)],
        "s string, t string, b string, n string, c string",
    )
    r = df.select(review.edited_record(*[F.col(c) for c in "stbnc"]).alias("r")).collect()
    assert tuple(r[0].r) == (None, ["a", "b"], [], 12, None)
    assert tuple(r[1].r) == ("S", [], ["x"], None, "C") and r[2].r.sample_size is None


def test_statistics(spark):
    rows = [
        ("1", OLD, None, 1.0, True, None), ("2", OLD, None, 0.8, False, None),
        ("3", OLD, None, 0.4, None, None), ("4", OLD, None, 0.39, True, None),
        ("5", OLD, None, None, False, None),
    ]
    ext = _ext(spark, rows)
    s = review.dashboard_stats(ext).first()
    assert (s.total, s.verified, s.avg_confidence, s.verification_rate) == (5, 2, 0.65, 0.4)
    bands = [tuple(r) for r in review.confidence_bands(ext).collect()]
    assert bands == [("High (0.8-1.0)", 2), ("Low (0.0-0.4)", 2), ("Medium (0.4-0.8)", 1)]
    empty = review.dashboard_stats(ext.limit(0)).first()
    assert tuple(empty) == (0, 0, 0.0, None)


def _pairs(spark, rows):
    return spark.createDataFrame(
        [(str(i), a, b) for i, (a, b) in enumerate(rows)],
        f"pmid string, original {REC}, final {REC}",
    )


CASES = [
    (("A", ["x", "y"], [], 100, "C"), (" a ", ["Y", " x"], None, 111, "c"), []),
    (("A", [], [], 100, None), ("B", [], [], 112, ""), ["tnm_stage", "sample_size"]),
    ((None, ["x"], ["b"], None, "C"), ("", ["x", "z"], [" B ", "b", ""], None, "D"),
     ["treatment_modality", "cancer_type"]),
    ((None, [], [], 5, None), (None, [], [], None, None), ["sample_size"]),
    ((None, [], [], 0, None), (None, [], [], 1, None), []),
    ((None, [], [], 3, None), (None, [], [], 1, None), ["sample_size"]),
    ((None, [], [], 2**62, None), (None, [], [], -(2**62), None), ["sample_size"]),
    ((" A\n", [], [], None, None), ("a", [" "], [], None, None), []),
]


def test_field_matches(spark):
    pairs = _pairs(spark, [c[:2] for c in CASES])
    got = {r.pmid: r.fields for r in review.disagreements(pairs).collect()}
    assert got == {str(i): c[2] for i, c in enumerate(CASES) if c[2]}
    assert [r.pmid for r in review.top_disagreements(pairs, 2).collect()] == ["1", "2"]


def test_agreement_rates(spark):
    pairs = _pairs(spark, [c[:2] for c in CASES[:3]])
    rates = {r.field: (r.agreed, r.n, r.agreement_display)
             for r in review.field_agreement_rates(pairs).collect()}
    assert rates["tnm_stage"] == (2, 3, 0.6667) and rates["biomarkers"] == (3, 3, 1.0)
    assert review.field_agreement_rates(pairs.limit(0)).count() == 0


def test_verified_pairs(spark):
    ext = _ext(
        spark,
        [("1", OLD, OLD, 1.0, True, None), ("2", OLD, None, 1.0, True, None),
         ("3", OLD, OLD, 1.0, False, None), ("4", OLD, OLD, 1.0, None, None)],
    )
    assert [r.pmid for r in review.verified_pairs(ext).collect()] == ["1"]


def test_parse_record(evaluate):
    got = evaluate(parse_record, [None, '{"tnm_stage": "A", "biomarkers": ["b"], "sample_size": 3}'])
    assert tuple(got[0]) == (None,) * 5
    assert tuple(got[1]) == ("A", None, ["b"], 3, None)
