"""Table schemas and the fixed vocabularies of the abstraction rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())

RECORD = T.StructType(
    [
        T.StructField("tnm_stage", T.StringType()),
        T.StructField("treatment_modality", _STRINGS),
        T.StructField("biomarkers", _STRINGS),
        T.StructField("sample_size", T.LongType()),
        T.StructField("cancer_type", T.StringType()),
    ]
)
RECORD_FIELDS = tuple(RECORD.fieldNames())
TEXT_FIELDS = ("tnm_stage", "cancer_type")
LIST_FIELDS = ("treatment_modality", "biomarkers")

PAYLOAD = T.StructType(
    [
        T.StructField("pmid", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract_text", T.StringType()),
        T.StructField("authors", _STRINGS),
        T.StructField("journal", T.StringType()),
        T.StructField("pub_date", T.StringType()),
        T.StructField("mesh_terms", _STRINGS),
    ]
)

RAW = T.StructType(
    [
        T.StructField("pmid", T.StringType(), False),
        T.StructField("raw_json", T.StringType(), False),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

CLEANED = T.StructType(
    [
        T.StructField("pmid", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("abstract_text", T.StringType(), False),
        T.StructField("authors", _STRINGS),
        T.StructField("pub_date", T.DateType()),
        T.StructField("mesh_terms", _STRINGS),
        T.StructField("journal", T.StringType()),
        T.StructField("cleaned_at", T.TimestampType()),
    ]
)

EXTRACTIONS = T.StructType(
    [
        T.StructField("pmid", T.StringType(), False),
        T.StructField("extracted", RECORD, False),
        T.StructField("original", RECORD),
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("model_version", T.StringType(), False),
        T.StructField("extracted_at", T.TimestampType()),
        T.StructField("human_verified", T.BooleanType()),
        T.StructField("reviewer_notes", T.StringType()),
    ]
)

NOTES = T.StructType(
    [
        T.StructField("pmid", T.StringType(), False),
        T.StructField("summary_text", T.StringType(), False),
        T.StructField("model_version", T.StringType(), False),
        T.StructField("generated_at", T.TimestampType()),
    ]
)

VALIDATION_RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("run_at", T.TimestampType()),
        T.StructField("model_version", T.StringType(), False),
        T.StructField("field", T.StringType(), False),
        T.StructField("tp", T.LongType()),
        T.StructField("fp", T.LongType()),
        T.StructField("fn", T.LongType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("correct", T.LongType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("n", T.LongType()),
        T.StructField("sample_size", T.LongType()),
    ]
)

TABLES = {
    "raw": RAW,
    "cleaned": CLEANED,
    "extractions": EXTRACTIONS,
    "notes": NOTES,
    "validation_runs": VALIDATION_RUNS,
}

# Label -> terms looked for in lower-cased text, in output order.
TREATMENT_TERMS = {
    "chemotherapy": [
        "chemotherapy", "cisplatin", "carboplatin", "gemcitabine", "docetaxel", "5-fu",
    ],
    "radiation": ["radiation", "radiotherapy", "imrt", "proton therapy"],
    "immunotherapy": [
        "immunotherapy", "checkpoint inhibitor", "pembrolizumab", "nivolumab", "anti-pd",
    ],
    "surgery": ["surgery", "surgical", "resection", "dissection"],
}
BIOMARKER_TERMS = {
    "EBV DNA": ["ebv", "epstein-barr", "ebv dna"],
    "PD-L1": ["pd-l1", "programmed death-ligand"],
    "p53": ["p53", "tp53"],
    "VEGF": ["vegf", "vascular endothelial"],
    "HER2": ["her2", "erbb2"],
}
# Mention flags of the analytic model (narrower than the rules above).
FLAG_TERMS = {
    "mentions_ebv": ["ebv", "epstein-barr", "ebv dna"],
    "mentions_pdl1": ["pd-l1", "programmed death-ligand"],
    "mentions_p53": ["p53", "tp53"],
    "mentions_chemotherapy": ["chemotherapy", "cisplatin", "carboplatin", "gemcitabine"],
    "mentions_radiation": ["radiation", "radiotherapy", "imrt"],
    "mentions_immunotherapy": [
        "immunotherapy", "checkpoint inhibitor", "pembrolizumab", "nivolumab",
    ],
}
# Subject term fragment -> cancer type, first match wins.
SUBJECT_CANCER_TYPES = {
    "nasopharyngeal": "Nasopharyngeal Carcinoma",
    "lung neoplasm": "Lung Cancer",
    "breast neoplasm": "Breast Cancer",
}
OTHER_CANCER_TYPE = "Other/Unspecified"


def empty_record():
    """Record with null scalars and empty lists."""
    return F.struct(
        *[
            (F.array() if isinstance(f.dataType, T.ArrayType) else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in RECORD.fields
        ]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns with its types; a missing column is an analysis error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
