import datetime as dt

from pyspark.sql import functions as F

from abstractmill.operators import quality
from abstractmill.plans import models

SCHEMA = (
    "pmid string, title string, abstract_text string, authors array<string>, pub_date date, "
    "mesh_terms array<string>, journal string, cleaned_at timestamp"
)
D = dt.date(2020, 5, 1)


def _cleaned(spark, rows):
    return spark.createDataFrame(
        [(str(i), "t", text, [], date, mesh, journal, None)
         for i, (text, date, mesh, journal) in enumerate(rows)],
        SCHEMA,
    )


ROWS = [
    ("EBV and pd-l1 with Cisplatin and radiotherapy", D, ["Nasopharyngeal Neoplasms"], "J"),
    ("No therapy, only epstein-barr here", D, ["Humans", "LUNG NEOPLASMS"], "J"),
    ("irradiation, p53, docetaxel is no flag", D, ["Breast Neoplasms", "Lung Neoplasms"], "K"),
    ("nivolumab or a checkpoint inhibitor", D, None, "K"),
    ("short text", D, [], "K"),
    (None, D, [], "K"),
    ("long enough but without any date", None, [], "K"),
    ("chemotherapy as the last of the rows", D, [], "K"),
]


def test_flags(spark):
    rows = {r.pmid: r for r in models.flagged(models.staged(_cleaned(spark, ROWS))).collect()}
    assert sorted(rows) == ["0", "1", "2", "3", "6", "7"]
    flags = lambda k: {f.removeprefix("mentions_") for f in models.FLAG_TERMS if rows[k][f]}
    assert flags("0") == {"ebv", "pdl1", "chemotherapy", "radiation"}
    assert flags("1") == {"ebv"} and flags("2") == {"radiation", "p53"}
    assert flags("3") == {"immunotherapy"} and flags("6") == set()
    assert rows["0"].cancer_type == "Nasopharyngeal Carcinoma"
    assert rows["1"].cancer_type == "Lung Cancer" and rows["2"].cancer_type == "Lung Cancer"
    assert rows["3"].cancer_type == rows["6"].cancer_type == "Other/Unspecified"
    assert rows["0"].publication_year == 2020 and rows["6"].publication_year is None


def test_marts(spark, tmp_path):
    built = models.build_models(_cleaned(spark, ROWS), str(tmp_path))
    studies = {(r.cancer_type, r.journal): r for r in built["mart_cancer_studies"].collect()}
    assert studies["Other/Unspecified", "K"].study_count == 2
    assert studies["Other/Unspecified", "K"].avg_abstract_length == 35.5
    assert studies["Lung Cancer", "J"].ebv_studies == 1
    outcomes = {r.cancer_type: r for r in built["mart_treatment_outcomes"].collect()}
    lung = outcomes["Lung Cancer"]
    assert (lung.total_abstracts, lung.radiation_count, lung.radiation_pct) == (2, 1, 50.0)
    assert outcomes["Nasopharyngeal Carcinoma"].chemoradiation_count == 1
    assert spark.table("int_abstracts_parsed").count() == 6
    assert spark.table("stg_abstracts").count() == 6


def test_percentages_round_half_up(spark):
    base = spark.createDataFrame(
        [(2020, "x", "j", 16, 160, 0, 0, 0, 1, 15, 0, 0), (2021, "x", "j", 2000, 1, 0, 0, 0, 1, 3, 0, 0)],
        "publication_year int, cancer_type string, journal string, studies long, total_length long, "
        "mentions_ebv long, mentions_pdl1 long, mentions_p53 long, mentions_chemotherapy long, "
        "mentions_radiation long, mentions_immunotherapy long, chemoradiation long",
    )
    rows = models.mart_treatment_outcomes(base).collect()
    assert [r.publication_year for r in rows] == [2021, 2020]
    assert (rows[0].chemo_pct, rows[0].radiation_pct) == (0.1, 0.2)
    assert (rows[1].chemo_pct, rows[1].radiation_pct) == (6.3, 93.8)


def test_mart_scan_reads_only_needed_columns(spark, tmp_path):
    _cleaned(spark, ROWS).write.parquet(str(tmp_path / "c"))
    cleaned = spark.read.parquet(str(tmp_path / "c"))
    base = models.study_base(models.flagged(models.staged(cleaned)))
    plan = base._jdf.queryExecution().executedPlan().toString()
    assert "title" not in plan and "authors" not in plan
    assert "IsNotNull(pub_date)" in plan


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", None), ("b", None, 2), (None, "z", None), (None, "x", 3), ("c", "x", 4)],
        "k string, v string, n int",
    )
    got = {
        (r.check_name, r.column_name): (r.failures, r.passed)
        for r in quality.check_table(df, "t", ["k", "n"], "k", {"v": ["x", "y"]}).collect()
    }
    assert got == {
        ("not_null", "k"): (2, False), ("not_null", "n"): (2, False),
        ("unique", "k"): (1, False), ("accepted_values", "v"): (1, False),
    }
    plain = quality.check_table(df, "t", ["v"]).collect()
    assert [(r.check_name, r.failures) for r in plain] == [("not_null", 1)]
    empty = quality.check_table(df.limit(0), "t", ["k"], "k").collect()
    assert all(r.passed and r.failures == 0 for r in empty)


def test_references(spark):
    parent = spark.createDataFrame([("1",), ("2",)], "pmid string")
    child = spark.createDataFrame([("1",), ("9",), ("9",), (None,)], "pmid string")
    bad = quality.check_reference(child, parent, "c").first()
    assert (bad.failures, bad.passed) == (2, False)
    good = quality.check_reference(parent, parent, "c").first()
    assert (good.failures, good.passed) == (0, True)
    assert quality.report(
        quality.check_reference(child, parent, "c"), quality.check_table(child, "c", ["pmid"])
    ).count() == 2
