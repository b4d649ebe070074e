from pyspark.sql import functions as F

from abstractmill.functions.summary import note_text
from abstractmill.schemas import RECORD


def test_note_text(spark):
    finding = "The first sentence has to be long enough to pass. Overall survival improved with treatment."
    rows = [
        (("Stage III", ["chemotherapy", "radiation"], ["EBV DNA", "PD-L1"], 245, "Lung Cancer"), "x",
         "This study examined 245 patients with Stage III Lung Cancer, treated with chemotherapy, "
         "radiation. Biomarkers assessed: EBV DNA, PD-L1."),
        ((None, [], None, 0, ""), None,
         "This study investigated oncology condition (unspecified stage), with treatment involving "
         "unspecified treatment. Biomarkers assessed: none reported."),
        ((None, ["surgery"], [], None, "Breast Cancer"), finding + " " * 20,
         "This study investigated Breast Cancer (unspecified stage), with treatment involving "
         "surgery. Biomarkers assessed: none reported. "
         "Key finding: Overall survival improved with treatment."),
    ]
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        f"i int, r {RECORD.simpleString()}, t string, want string",
    )
    got = df.select("i", "want", note_text(F.col("r"), F.col("t")).alias("got")).orderBy("i").collect()
    assert [r.got for r in got] == [r.want for r in got]
