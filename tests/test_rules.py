from pyspark.sql import functions as F

from abstractmill.functions.rules import confidence, with_rule_record
from abstractmill.operators.extraction import extract, with_rules
from abstractmill.schemas import RECORD

#: text -> stage, treatments, biomarkers, size, cancer type
CASES = [
    ("Nasopharyngeal growths of stage II, code T3N2M1, in 88 participants had gemcitabine, then IMRT; epstein-barr and p53 were read.",
     "T3N2M1", ["chemotherapy", "radiation"], ["EBV DNA", "p53"], 88, "Nasopharyngeal Carcinoma"),
    ("The disease was of stage IVA and its origin unknown.", "Stage IVA", [], [], None, None),
    ("Nivolumab for lung cancer was open to 2,318 individuals.", None, ["immunotherapy"], [], 318, "Lung Cancer"),
    ("Nothing at this stage is settled: breast carcinoma, irradiation, erbb2.", "Stage I", ["radiation"], ["HER2"], None, "Breast Cancer"),
    ("One stage 10 mass in 7654321 cases; stage 3a came later.", "Stage 1", [], [], 54321, None),
    ("A stage x mass beside one of STAGE iiib, and T4bN3M1.", "T4bN3M1", [], [], None, None),
    ("t1n1m1 is no code. We saw 19 Subjects and 77 patients.", None, [], [], 19, None),
    ("Breast tissue without the other word; 5-FU by mouth.", None, ["chemotherapy"], [], None, None),
    ("Lung and breast cancer after a dissection, anti-PD agents, TP53.", None, ["immunotherapy", "surgery"], ["p53"], None, "Lung Cancer"),
    ("stage\u00a0II across a hard space for 6 cases.", "Stage II", [], [], 6, None),
    ("Not one clinical variable stands in this line.", None, [], [], None, None),
    ("T1N0M0, 9 patients", None, [], [], None, None),
    ("", None, [], [], None, None),
    (None, None, [], [], None, None),
]


def _records(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, abstract_text string")
    return [r["extracted"] for r in with_rules(df).orderBy("i").collect()]


def test_rules_by_case(spark):
    for case, record in zip(CASES, _records(spark), strict=True):
        found = (record.tnm_stage, record.treatment_modality, record.biomarkers, record.sample_size, record.cancer_type)
        assert found == case[1:], case[0]


def test_size_pattern_is_a_parameter(spark):
    df = spark.createDataFrame([("One mass in 7654321 cases of the series.",)], "t string")
    wide = with_rule_record(df, "t", "r", size_pattern=r"(\d+) cases").first()["r"]
    assert wide.sample_size == 7654321


def test_confidence(spark):
    rows = [
        ("Stage I", ["a"], ["b"], 5, "Lung Cancer"),
        (None, [], [], None, None),
        ("", None, [], 0, ""),
        ("Stage I", ["a"], [], None, "Lung Cancer"),
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)],
                               "i int, r " + RECORD.simpleString())
    got = [x[0] for x in df.orderBy("i").select(confidence(F.col("r"))).collect()]
    assert got == [1.0, 0.0, 0.0, 0.6]


def test_extract_rows(spark):
    df = spark.createDataFrame([("1", CASES[0][0]), ("2", "short")], "pmid string, abstract_text string")
    rows = {r.pmid: r for r in extract(df, F.lit("2024-01-01")).collect()}
    assert rows["1"].confidence_score == 1.0 and rows["1"].original == rows["1"].extracted
    assert rows["2"].confidence_score == 0.0 and rows["2"].extracted.biomarkers == []


def test_own_vocabulary(spark):
    from abstractmill.functions.rules import labels

    df = spark.createDataFrame([("aspirin and statins",)], "x string")
    lexicon = {"B": ["statin"], "A": ["aspirin", "ibuprofen"], "C": ["none"]}
    assert df.select(labels(F.col("x"), lexicon)).first()[0] == ["B", "A"]
