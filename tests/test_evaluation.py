import pytest
from pyspark.sql import functions as F

from abstractmill.operators import evaluation
from abstractmill.schemas import RECORD, VALIDATION_RUNS


def _score(spark, preds, golds):
    def table(rows):
        return spark.createDataFrame(
            [(str(i), r) for i, r in enumerate(rows)],
            f"pmid string, record {RECORD.simpleString()}",
        )

    pairs = evaluation.pair_by_key(table(preds), table(golds))
    return {r.field: r for r in evaluation.validation_metrics(pairs).collect()}


FULL = ("Stage III", ["chemotherapy", "radiation"], ["EBV DNA"], 100, "Lung Cancer")
NONE = (None, [], [], None, None)


def test_perfect(spark):
    m = _score(spark, [FULL, NONE], [FULL, NONE])
    for f in ("tnm_stage", "cancer_type", "treatment_modality", "biomarkers"):
        assert (m[f].precision, m[f].recall, m[f].f1, m[f].accuracy) == (1.0, 1.0, 1.0, None)
    assert (m["sample_size"].accuracy, m["sample_size"].n) == (1.0, 1)
    assert m["sample_size"].f1 is None


def test_wrong_value_is_a_false_positive_only(spark):
    m = _score(spark, [("Stage I", ["surgery"], [], 50, "")], [FULL])
    assert (m["tnm_stage"].tp, m["tnm_stage"].fp, m["tnm_stage"].fn) == (0, 1, 0)
    assert (m["tnm_stage"].precision, m["tnm_stage"].recall, m["tnm_stage"].f1) == (0.0, 0.0, 0.0)
    assert (m["cancer_type"].fp, m["cancer_type"].fn) == (0, 1)
    t = m["treatment_modality"]
    assert (t.tp, t.fp, t.fn) == (0, 1, 2)
    assert (m["biomarkers"].fp, m["biomarkers"].fn) == (0, 1)
    assert m["sample_size"].accuracy == 0.0


def test_case_repeats_and_nulls(spark):
    m = _score(
        spark,
        [("stage iii", ["Chemotherapy", "chemotherapy"], None, 90, "x"), NONE, FULL],
        [FULL, FULL, NONE],
    )
    assert (m["tnm_stage"].tp, m["tnm_stage"].fp, m["tnm_stage"].fn) == (1, 1, 1)
    t = m["treatment_modality"]
    assert (t.tp, t.fp, t.fn) == (1, 2, 3)
    assert t.precision == pytest.approx(1 / 3) and t.precision_display == 0.333
    assert (m["sample_size"].n, m["sample_size"].correct) == (2, 1)


def test_size_tolerance(spark):
    sizes = [(90, 100, 1), (89, 100, 0), (2, 1, 1), (3, 1, 0), (0, 0, 1), (11, 10, 1), (None, 5, 0),
             (2**62, 5, 0)]
    m = _score(
        spark,
        [(None, [], [], p, None) for p, _, _ in sizes],
        [(None, [], [], g, None) for _, g, _ in sizes],
    )
    assert (m["sample_size"].n, m["sample_size"].correct) == (8, sum(s[2] for s in sizes))


def test_no_pairs(spark):
    m = _score(spark, [], [])
    assert all(m[f].f1 == 0.0 for f in ("tnm_stage", "biomarkers"))
    assert (m["sample_size"].accuracy, m["sample_size"].n) == (0.0, 0)


def test_pairs_need_a_key_on_both_sides(spark):
    m = _score(spark, [FULL], [FULL, FULL])
    assert m["tnm_stage"].tp == 1 and m["tnm_stage"].fn == 0


def test_run_log_schema(spark):
    df = spark.createDataFrame([("1", FULL)], f"pmid string, record {RECORD.simpleString()}")
    metrics = evaluation.validation_metrics(evaluation.pair_by_key(df, df))
    log = evaluation.validation_run(metrics, "r1", F.lit("2024-01-01"), "v1")
    assert log.columns == VALIDATION_RUNS.fieldNames() and log.count() == 5
