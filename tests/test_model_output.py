import json
import re

import pytest

from abstractmill.operators.extraction import extract, with_model
from abstractmill.operators.inference import with_model_output

TEXT = "This abstract mentions surgery in 33 patients with lung cancer."
RULES = (None, ["surgery"], [], 33, "Lung Cancer")
EMPTY = (None, [], [], None, None)

CASES = [
    ('{"tnm_stage": "Stage II", "sample_size": 80}', ("Stage II", [], [], 80, None)),
    ('Sure:\n{"cancer_type":\n"Other"} done', (None, [], [], None, "Other")),
    ("no json", RULES),
    ("{broken", RULES),
    ("{'tnm_stage': 'x'}", RULES),
    ("{}", EMPTY),
    ("", RULES),
    (None, RULES),
    ('{"tnm_stage": 3}', RULES),
    ('{"tnm_stage": ""}', ("", [], [], None, None)),
    ('{"tnm_stage": null, "cancer_type": null, "sample_size": null}', EMPTY),
    ('{"cancer_type": ["a"]}', RULES),
    ('{"treatment_modality": null}', RULES),
    ('{"treatment_modality": "a"}', RULES),
    ('{"treatment_modality": []}', EMPTY),
    ('{"treatment_modality": [null]}', RULES),
    ('{"treatment_modality": ["a", null]}', RULES),
    ('{"treatment_modality": [1]}', RULES),
    ('{"treatment_modality": ["a", 1]}', RULES),
    ('{"treatment_modality": [["a"]]}', RULES),
    ('{"biomarkers": ["b", "a", "b"]}', (None, [], ["b", "a", "b"], None, None)),
    ('{"sample_size": 100.0}', (None, [], [], 100, None)),
    ('{"sample_size": 1e3}', (None, [], [], 1000, None)),
    ('{"sample_size": 100.5}', RULES),
    ('{"sample_size": true}', (None, [], [], 1, None)),
    ('{"sample_size": false}', (None, [], [], 0, None)),
    ('{"sample_size": "100"}', (None, [], [], 100, None)),
    ('{"sample_size": " 100 "}', (None, [], [], 100, None)),
    ('{"sample_size": "100.0"}', (None, [], [], 100, None)),
    ('{"sample_size": "+5"}', (None, [], [], 5, None)),
    ('{"sample_size": "-5"}', (None, [], [], -5, None)),
    ('{"sample_size": "1_000"}', (None, [], [], 1000, None)),
    ('{"sample_size": "1,000"}', RULES),
    ('{"sample_size": "100.5"}', RULES),
    ('{"sample_size": ""}', RULES),
    ('{"sample_size": "many"}', RULES),
    ('{"sample_size": [5]}', RULES),
    ('{"sample_size": 3000000000}', (None, [], [], 3000000000, None)),
    ('{"other": 1, "tnm_stage": "X"}', ("X", [], [], None, None)),
    ('{"tnm_stage": "A"} {"tnm_stage": "B"}', ("A", [], [], None, None)),
    ('{"a": {"tnm_stage": "in"}}', ("in", [], [], None, None)),
    ('{"sample_size": 1, "tnm_stage": 2}', RULES),
]


def test_cases(spark):
    df = spark.createDataFrame(
        [(i, raw, TEXT) for i, (raw, _) in enumerate(CASES)],
        "i int, raw string, abstract_text string",
    )
    rows = with_model(df, "raw").orderBy("i").collect()
    got = [tuple(r["extracted"]) for r in rows]
    wrong = [(c[0], g) for c, g in zip(CASES, got) if c[1] != g]
    assert not wrong


def test_cases_agree_with_a_record_validator():
    """The expected values above, checked against a typed record class."""
    pydantic = pytest.importorskip("pydantic")
    Record = pydantic.create_model(
        "Record",
        tnm_stage=(str | None, None),
        treatment_modality=(list[str], []),
        biomarkers=(list[str], []),
        sample_size=(int | None, None),
        cancer_type=(str | None, None),
    )
    for raw, expected in CASES:
        span = re.search(r"\{[^{}]*\}", raw or "")
        try:
            got = tuple(Record(**json.loads(span.group())).model_dump().values())
        except Exception:
            got = RULES
        assert got == expected, raw


def test_short_text_ignores_the_model(spark):
    df = spark.createDataFrame([('{"tnm_stage": "X"}', "short")], "raw string, abstract_text string")
    assert tuple(with_model(df, "raw").first()["extracted"]) == EMPTY


def _abstracts(spark):
    return spark.createDataFrame(
        [("1", TEXT), ("2", TEXT + " FAIL"), ("3", "short"), ("4", TEXT + " odd")],
        "pmid string, abstract_text string",
    )


def test_bad_rows_alone_fall_back(spark):
    def factory():
        def predict(prompts):
            if any("FAIL" in p for p in prompts):
                raise RuntimeError("cannot answer")
            return ['{"tnm_stage": "M"}' if "odd" not in p else "prose" for p in prompts]

        return predict

    rows = {r.pmid: r for r in extract(_abstracts(spark), None, factory, "m1").collect()}
    assert tuple(rows["1"].extracted) == ("M", [], [], None, None)
    assert tuple(rows["2"].extracted) == RULES
    assert tuple(rows["3"].extracted) == EMPTY
    assert tuple(rows["4"].extracted) == RULES
    assert rows["1"].model_version == "m1"


def test_predictor_that_cannot_be_made(spark):
    def factory():
        raise OSError("no weights here")

    rows = {r.pmid: tuple(r.extracted) for r in extract(_abstracts(spark), None, factory).collect()}
    assert rows["1"] == RULES and rows["3"] == EMPTY


def test_prompt_cap(spark):
    def factory():
        return lambda prompts: [str(len(p)) for p in prompts]

    df = spark.createDataFrame([("1", "x" * 4000)], "pmid string, abstract_text string")
    capped = int(with_model_output(df, factory, max_chars=1500).first()["model_output"])
    whole = int(with_model_output(df, factory, partitions=2).first()["model_output"])
    assert whole - capped == 2500


def test_a_failing_batch_is_halved(spark):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def predict(prompts):
            calls.add(1)
            if any("bad" in p for p in prompts):
                raise ValueError("no answer")
            return ["fine"] * len(prompts)

        return predict

    texts = [(str(i), f"{'bad' if i == 37 else 'good'} " * 10) for i in range(64)]
    df = spark.createDataFrame(texts, "pmid string, abstract_text string").coalesce(1)
    out = {r["pmid"]: r["model_output"] for r in with_model_output(df, factory).collect()}
    assert [k for k, v in out.items() if v is None] == ["37"]
    assert calls.value <= 1 + 2 * 6
