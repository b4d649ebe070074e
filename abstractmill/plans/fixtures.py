"""Inputs for the catalog: clinical tables derived row by row from the given tables.

The given texts hold no clinical words, so each row's text gets one clinical sentence
appended; keys of the state tables come from tables that overlap only in part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.plan import spread
from ..operators.extraction import with_rules
from ..operators.review import edited_record
from ..schemas import RECORD_FIELDS

SENTENCES = [
    "Tumours of the nasopharyngeal wall, Stage III and coded T2N1M0, were seen in 318 patients. "
    "Carboplatin came first and IMRT after it. "
    "Plasma held ebv copies and stained cells showed programmed death-ligand",
    "A checkpoint inhibitor was compared with nivolumab where lung carcinoma had come back. "
    "After two years every third tumour had shrunk",
    "Patients with stage IVA breast carcinoma underwent surgical resection. "
    "HER2 and p53 status was reported in 1,245 patients",
    "At this stage is unclear whether VEGF matters. "
    "A total of 12 Participants were followed after proton therapy",
    "IMRT alone for 1234567 subjects. TP53 mutated tumours recurred",
    "No clinical variable is mentioned in this passage at all",
]
SUBJECTS = [
    ["Neoplasms of Throat", "Nasopharyngeal Diseases"],
    ["Lung Neoplasms"],
    ["Breast Neoplasms", "Receptor, ErbB-2"],
    [],
]
STAGES = ["Stage I", "Stage III", "T2N1M0", None]
CANCERS = ["Lung Cancer", None, "Breast Cancer"]
TREATMENTS = [["chemotherapy"], ["radiation", "surgery"], []]
BIOMARKERS = [["EBV DNA", "PD-L1"], ["p53"], []]
#: Markup of an article's first section, and below its text.
ARTICLE_MARKUP = [
    " and <DispFormula>x=1</DispFormula>.",
    " and <mml:math xmlns:mml='m'><mml:mi>y</mml:mi>=2</mml:math>.",
    " and <strong>all <em class='x'>of</em> it</strong>.",
    "<br/>.",
]
ARTICLE_MARKUP_TEXT = [" and x=1.", " and y=2.", " and all of it.", "."]
MODEL_OUTPUTS = [
    '{"tnm_stage": "Stage II", "treatment_modality": ["chemotherapy", "surgery"], '
    '"biomarkers": ["p53"], "sample_size": 80, "cancer_type": "Lung Cancer"}',
    'Here is the answer: {"tnm_stage": "T1N0M0", "sample_size": 7} as asked',
    "I could not find any variable",
    '{"tnm_stage": "Stage II", ',
    "{}",
    '{"tnm_stage": 3, "sample_size": 9}',
    '{"treatment_modality": null}',
    '{"biomarkers": ["p53", null]}',
    '{"sample_size": "100"}',
    '{"sample_size": 100.0, "cancer_type": ""}',
    '{"sample_size": 100.5}',
    '{"sample_size": true}',
    '{"cancer_type": "Other", "confidence": "high"}',
    '{"tnm_stage": "Stage I"} {"tnm_stage": "Stage IV"}',
    '{"outer": {"tnm_stage": "Stage III"}}',
    '{"treatment_modality": [], "biomarkers": "p53"}',
]
STAMP = "2024-06-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(value) -> str:
    """A literal in Spark SQL."""
    if value is None:
        return "cast(null as string)"
    if isinstance(value, list):
        return f"cast(array({', '.join(map(_sql, value))}) as array<string>)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pick(values, index: str) -> str:
    """SQL for the entry of a short literal list that ``index`` (from 0) points at."""
    items = ", ".join(map(_sql, values))
    return f"element_at(array({items}), cast({index} + 1 as int))"


def _clinical(df: DataFrame, key: str, text: str, title: str, journal: str) -> DataFrame:
    # One SQL text per column: a column tree built call by call takes longer than the query.
    return df.selectExpr(
        f"cast({key} as string) as pmid",
        f"{title} as title",
        f"concat({text}, ' ', {_pick(SENTENCES, f'{key} % 6')}) as abstract_text",
        f"array({journal}, 'Roe, R') as authors",
        f"case when {key} % 17 <> 0 then date_add(date'2015-01-01', "
        f"cast({key} * 37 % 3650 as int)) end as pub_date",
        f"{_pick(SUBJECTS, f'{key} % 4')} as mesh_terms",
        f"{journal} as journal",
        f"timestamp'{STAMP}' as cleaned_at",
    )


def abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned-abstract rows of every document."""
    documents = table(spark, sf_dir, "documents")
    title = "concat('Study ', cast(doc_id as string), ' of ', lang)"
    return _clinical(documents, "doc_id", "text", title, "source")


def page_abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned-abstract rows of every web page: the batch that meets older rows."""
    pages = table(spark, sf_dir, "pages")
    return _clinical(pages, "page_id", "html", "url", "'web'")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON rows of every document, with markup, an entity and some invalid dates."""
    rows = abstracts(spark, sf_dir)
    bad_date = F.col("pmid").cast("bigint") % 19 == 0
    payload = F.struct(
        "pmid",
        F.concat(F.lit("  <b>"), "title", F.lit("</b> ")).alias("title"),
        F.concat(F.lit("<p>"), "abstract_text", F.lit(" &amp; more</p>")).alias("abstract_text"),
        "authors",
        "journal",
        F.when(bad_date, "2023-02-30")
        .otherwise(F.date_format("pub_date", "yyyy-MM-dd"))
        .alias("pub_date"),
        "mesh_terms",
    )
    return rows.select(
        "pmid",
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("raw_json"),
        F.lit(STAMP).cast("timestamp").alias("fetched_at"),
    )


def _record(k: str) -> dict[str, str]:
    return {
        "tnm_stage": _pick(STAGES, f"{k} % 4"),
        "treatment_modality": _pick(TREATMENTS, f"{k} % 3"),
        "biomarkers": _pick(BIOMARKERS, f"{k} % 5 % 3"),
        "sample_size": f"case when {k} % 6 <> 0 then {k} % 500 end",
        "cancer_type": _pick(CANCERS, f"{k} % 3"),
    }


def _reviewed(k: str, record: dict[str, str] | None = None) -> dict[str, str]:
    """A record, that of ``_record`` if none is given, after a reviewer went over it."""
    r = record or _record(k)
    return {
        "tnm_stage": f"case when {k} % 5 = 0 then 'Stage II' "
        f"when {k} % 5 = 1 then concat(' ', lower({r['tnm_stage']})) "
        f"when {k} % 5 <> 2 then {r['tnm_stage']} end",
        "treatment_modality": f"case when {k} % 4 = 0 then array('Surgery', ' radiation') "
        f"when {k} % 4 <> 1 then {r['treatment_modality']} end",
        "biomarkers": f"case when {k} % 3 = 0 then array('pd-l1', 'ebv dna', 'EBV DNA') "
        f"else {r['biomarkers']} end",
        "sample_size": f"case when {k} % 7 = 0 then null "
        f"when {k} % 7 < 3 then ({r['sample_size']}) + {k} % 60 else {r['sample_size']} end",
        "cancer_type": f"case when {k} % 4 = 1 then upper({r['cancer_type']}) "
        f"when {k} % 4 = 2 then '' else {r['cancer_type']} end",
    }


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {sql}" for n, sql in fields.items()) + ")"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record that the rules read from every document."""
    read = with_rules(spread(abstracts(spark, sf_dir)))
    return read.select("pmid", F.col("extracted").alias("record"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record that the rules read from every document, and what a reviewer made of it."""
    read = {f: f"record.{f}" for f in RECORD_FIELDS}
    return predictions(spark, sf_dir).selectExpr(
        "pmid",
        "record as original",
        f"{_struct(_reviewed('cast(pmid as bigint)', read))} as final",
    )


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold record of every label."""
    return table(spark, sf_dir, "labels").selectExpr(
        "cast(doc_id as string) as pmid", f"{_struct(_reviewed('doc_id'))} as record"
    )


def extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction state: one row per label, some without a snapshot or a score."""
    return table(spark, sf_dir, "labels").selectExpr(
        "cast(doc_id as string) as pmid",
        f"{_struct(_reviewed('doc_id'))} as extracted",
        f"case when toxic = 0 then {_struct(_record('doc_id'))} end as original",
        "case when doc_id % 10 <> 0 then cast(doc_id % 6 as double) / 5.0D end "
        "as confidence_score",
        "'v0' as model_version",
        f"timestamp'{STAMP}' as extracted_at",
        "case when doc_id % 8 <> 0 then quality = 1 end as human_verified",
        "case when quality = 1 then 'looks right' end as reviewer_notes",
    )


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Note state: one row per page."""
    return table(spark, sf_dir, "pages").selectExpr(
        "cast(page_id as string) as pmid", "url as summary_text", "'v0' as model_version",
        f"timestamp'{STAMP}' as generated_at",
    )


def label_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw state: one row per label."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("pmid"), F.lit("stored").alias("raw_json")
    )


def turn_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw batch with repeated keys: one row per conversation turn."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("pmid"),
        F.concat("role", F.lit(": "), "text").alias("raw_json"),
        F.col("turn").alias("arrival"),
    )


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review decisions: one per event, many per key; some approvals carry edits."""
    e = F.col("event_id")
    edited = edited_record(
        F.concat(F.lit("Stage "), "event_type"),
        F.lit("surgery, , radiation"),
        F.lit(""),
        F.col("value").cast("bigint").cast("string"),
        F.lit("Lung Cancer"),
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("pmid"),
        F.expr(_pick(["approve", "reject", "skip"], "event_id % 3")).alias("action"),
        F.when(e % 2 == 0, edited).alias("edited"),
        F.concat(F.lit("note "), e.cast("string")).alias("notes"),
        F.col("ts").alias("decided_at"),
        e.alias("seq"),
    )


def model_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abstracts with one of sixteen kinds of model output each."""
    return abstracts(spark, sf_dir).select(
        "pmid",
        "abstract_text",
        F.expr(_pick(MODEL_OUTPUTS, "cast(pmid as bigint) % 16")).alias("raw_output"),
    )


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year, month and day text of every document, in the shapes records use."""
    k = F.col("doc_id")
    months = ["Mar", "11", "7", "Summer", None, "Dec"]
    days = ["15", "5", None, "31", "x"]
    return table(spark, sf_dir, "documents").select(
        k.cast("string").alias("pmid"),
        F.when(k % 9 != 0, (k % 40 + 1985).cast("string")).alias("year"),
        F.expr(_pick(months, "doc_id % 6")).alias("month"),
        F.expr(_pick(days, "doc_id % 5")).alias("day"),
    )


def article_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One XML article of two sections per document, split over lines like real files."""
    rows = abstracts(spark, sf_dir)

    def esc(c):
        for raw, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            c = F.replace(c, F.lit(raw), F.lit(coded))
        return c

    k = F.col("pmid").cast("bigint")
    subjects = F.array_join(
        F.transform(
            "mesh_terms",
            lambda t: F.concat(
                F.lit("<MeshHeading><DescriptorName>"), t,
                F.lit("</DescriptorName></MeshHeading>"),
            ),
        ),
        "",
    )
    return rows.select(
        F.concat(
            F.lit("<PubmedArticle>\n<MedlineCitation Status='x'><PMID Version='1'>"), "pmid",
            F.lit("</PMID>\n<Article><Journal><JournalIssue><PubDate><Year>"),
            (k % 40 + 1985).cast("string"),
            F.lit("</Year><Month>Mar</Month></PubDate></JournalIssue><Title>"), esc("journal"),
            F.lit("</Title></Journal>\n<ArticleTitle>"), esc("title"),
            F.lit(" <i>in <b>vivo</b></i></ArticleTitle>\n<Abstract><AbstractText Label='AIM'>H<sub>2"
                  "</sub>O<!-- a > b -->"),
            F.expr(_pick(ARTICLE_MARKUP, "cast(pmid as bigint) % 4")),
            F.lit("</AbstractText><AbstractText>"),
            esc("abstract_text"),
            # A bare ampersand is no well-formed XML.
            F.when(k % 29 == 0, " & ").otherwise(""),
            F.lit("</AbstractText></Abstract>\n<AuthorList><Author><LastName>Roe</LastName>"
                  "<ForeName>R</ForeName></Author><Author><CollectiveName>Group"
                  "</CollectiveName></Author><Author><LastName>"),
            esc("journal"),
            F.lit("</LastName></Author></AuthorList></Article>\n<MeshHeadingList>"), subjects,
            F.lit("</MeshHeadingList></MedlineCitation></PubmedArticle>"),
        ).alias("value")
    )
