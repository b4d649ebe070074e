"""Bulk scan of article XML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import publication_date
from ..functions.plan import pin

# Element names of the article format.
RECORD_END = "</PubmedArticle>"
RECORD_PATTERN = r"(?s)<PubmedArticle(?=[\s>]).*"
COMMENT_PATTERN = r"(?s)<!--.*?-->"
# Any tag inside a title or an abstract section: it follows the opening tag or the last
# match, with text but no other tag between.
MARKUP_PATTERN = (
    r"(<(?:ArticleTitle|AbstractText)(?:\s[^<>]*)?(?<!/)>|\G(?!^))([^<]*)"
    r"<(?!/(?:ArticleTitle|AbstractText)\s*>|!)[^<>]*>"
)

_S = T.StringType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


ARTICLE_XML = _struct(
    MedlineCitation=_struct(
        PMID=_S,
        Article=_struct(
            Journal=_struct(
                Title=_S,
                JournalIssue=_struct(PubDate=_struct(Year=_S, Month=_S, Day=_S)),
            ),
            ArticleTitle=_S,
            Abstract=_struct(AbstractText=T.ArrayType(_struct(_Label=_S, _VALUE=_S))),
            AuthorList=_struct(Author=T.ArrayType(_struct(LastName=_S, ForeName=_S))),
        ),
        MeshHeadingList=_struct(MeshHeading=T.ArrayType(_struct(DescriptorName=_S))),
    )
)


def _parsed(lines: DataFrame, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """The article's XML and its citation ``c``, null in a row that is no well-formed XML.

    All markup and comments inside titles and abstracts are removed before parsing,
    because the XML parser drops text that surrounds child elements.
    """
    article = F.regexp_replace(F.regexp_extract(F.col(value), RECORD_PATTERN, 0), COMMENT_PATTERN, "")
    closed = F.concat(F.regexp_replace(article, MARKUP_PATTERN, "$1$2"), F.lit(RECORD_END))
    read = F.from_xml(
        "xml",
        T.StructType([*ARTICLE_XML.fields, T.StructField("_corrupt_record", _S)]),
        {"rowTag": "PubmedArticle", "ignoreSurroundingSpaces": "false"},
    )
    records = lines.where(F.col(value).rlike(r"<PubmedArticle[\s>]")).select(
        closed.alias("xml"), *keep
    )
    whole = pin(records, "read", read)
    return whole.select("xml", *keep, F.col("read._corrupt_record").alias("corrupt"), F.col("read.MedlineCitation").alias("c"))


def rejected_articles(lines: DataFrame, value: str = "value") -> DataFrame:
    """Articles that are no well-formed XML: their key, as far as it can be read, and their text."""
    key = F.regexp_extract("xml", r"<PMID(?:\s[^<>]*)?>\s*(\d+)", 1)
    bad = _parsed(lines, value).where(F.col("corrupt").isNotNull())
    return bad.select(F.nullif(key, F.lit("")).alias("pmid"), "xml")


def parse_articles(
    lines: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Flat records from one XML article per row, and the columns ``keep`` of its line.

    Rows without an article, a key or an article body are skipped; those that are no
    well-formed XML are the rows of ``rejected_articles``.
    """
    kept = _parsed(lines, value, keep).where(
        F.col("corrupt").isNull() & (F.col("c.PMID") != "") & F.col("c.Article").isNotNull()
    )
    a = F.col("c.Article")
    date = a["Journal"]["JournalIssue"]["PubDate"]
    return kept.select(
        F.col("c.PMID").alias("pmid"),
        _blank(a["ArticleTitle"]).alias("title"),
        F.array_join(
            F.transform(_list(a["Abstract"]["AbstractText"]), _section), "\n"
        ).alias("abstract_text"),
        F.transform(
            F.filter(_list(a["AuthorList"]["Author"]), lambda x: x["LastName"] != ""), _author
        ).alias("authors"),
        _blank(a["Journal"]["Title"]).alias("journal"),
        publication_date(date["Year"], date["Month"], date["Day"]).alias("pub_date"),
        F.filter(
            _list(F.col("c.MeshHeadingList.MeshHeading.DescriptorName")), lambda x: x != ""
        ).alias("mesh_terms"),
        *keep,
    )


def _blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _list(values: Column) -> Column:
    return F.coalesce(values, F.array())


def _section(s: Column) -> Column:
    text = _blank(s["_VALUE"])
    return F.when(
        s["_Label"] != "", F.concat(s["_Label"], F.lit(": "), text)
    ).otherwise(text)


def _author(a: Column) -> Column:
    return F.btrim(F.concat(a["LastName"], F.lit(", "), _blank(a["ForeName"])), F.lit(", "))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Scan a directory of article files (plain or compressed), split at record ends.

    The record terminator is the line separator, so large files are read in parallel
    from any offset and no file has to fit in memory.
    """
    return parse_articles(article_lines(spark, path))


def article_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per article of a directory of files, as text without its end tag."""
    return spark.read.option("lineSep", RECORD_END).text(path)


def to_raw(articles: DataFrame, fetched_at: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Raw-table rows: the record without ``keep`` as JSON text under its key, and ``keep``."""
    record = [c for c in articles.columns if c not in keep]
    return articles.select(
        "pmid",
        F.to_json(F.struct(*record), {"ignoreNullFields": "false"}).alias("raw_json"),
        fetched_at.cast("timestamp").alias("fetched_at"),
        *keep,
    )
