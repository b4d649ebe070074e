import os

from pyspark.sql import functions as F

from abstractmill.functions.dates import publication_date
from abstractmill.operators.cleaning import clean_abstracts
from abstractmill.sources.articles import read_articles, to_raw

HEAD = """<?xml version="1.0" ?>
<PubmedArticleSet>
"""
TAIL = "</PubmedArticleSet>\n"
FULL = """<PubmedArticle>
  <MedlineCitation Status="MEDLINE"><PMID Version="1">111</PMID>
    <Article PubModel="Print">
      <Journal><ISSN>1</ISSN><JournalIssue CitedMedium="Print"><PubDate>
        <Year>2019</Year><Month>Oct</Month><Day>7</Day></PubDate></JournalIssue>
        <Title>Journal of Examples</Title></Journal>
      <ArticleTitle>Role of <i>TP53</i> in <b>rare</b> tumours &amp; more.</ArticleTitle>
      <Abstract>
        <AbstractText Label="WHY" NlmCategory="BACKGROUND">CO<sub>2</sub> is p &lt; 0.05.</AbstractText>
        <AbstractText Label="HOW">Of 31 cases <mml:mi xmlns:mml="m">n</mml:mi>=<x><y>9</y></x> were <!-- not > --> followed.</AbstractText>
        <AbstractText>Plain section.</AbstractText>
      </Abstract>
      <AuthorList><Author><LastName>Doe</LastName><ForeName>Jane A</ForeName></Author>
        <Author><LastName>Solo</LastName></Author>
        <Author><CollectiveName>The Group</CollectiveName></Author></AuthorList>
    </Article>
    <MeshHeadingList>
      <MeshHeading><DescriptorName UI="D1">Lung Neoplasms</DescriptorName>
        <QualifierName UI="Q1">genetics</QualifierName></MeshHeading>
      <MeshHeading><DescriptorName UI="D2">Humans</DescriptorName></MeshHeading>
    </MeshHeadingList>
  </MedlineCitation>
  <PubmedData><ArticleIdList><ArticleId IdType="pubmed">111</ArticleId></ArticleIdList></PubmedData>
</PubmedArticle>
"""
BARE = """<PubmedArticle><MedlineCitation><PMID>222</PMID><Article>
<Journal><JournalIssue><PubDate><Year>2020</Year></PubDate></JournalIssue></Journal>
<ArticleTitle>No abstract</ArticleTitle></Article></MedlineCitation></PubmedArticle>
"""
NO_KEY = """<PubmedArticle><MedlineCitation><Article><ArticleTitle>x</ArticleTitle></Article>
</MedlineCitation></PubmedArticle>
"""
NO_ARTICLE = "<PubmedArticle><MedlineCitation><PMID>9</PMID></MedlineCitation></PubmedArticle>\n"
NO_CITATION = "<PubmedArticle><PubmedData/></PubmedArticle>\n"
BOOK = "<PubmedBookArticle><BookDocument><PMID>7</PMID></BookDocument></PubmedBookArticle>\n"


def test_article_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text(HEAD + FULL + NO_KEY + BARE + TAIL)
    (tmp_path / "b.xml").write_text(
        HEAD + BOOK + FULL.replace(">111<", ">333<") + NO_ARTICLE + NO_CITATION + TAIL
    )
    (tmp_path / "c.xml").write_text(HEAD + TAIL)
    rows = {r.pmid: r for r in read_articles(spark, str(tmp_path)).collect()}
    assert sorted(rows) == ["111", "222", "333"]
    full = rows["111"]
    assert full.title == "Role of TP53 in rare tumours & more."
    assert full.abstract_text == (
        "WHY: CO2 is p < 0.05.\nHOW: Of 31 cases n=9 were  followed.\nPlain section."
    )
    assert full.authors == ["Doe, Jane A", "Solo"]
    assert full.journal == "Journal of Examples" and full.pub_date == "2019-10-07"
    assert full.mesh_terms == ["Lung Neoplasms", "Humans"]
    bare = rows["222"]
    assert (bare.abstract_text, bare.pub_date, bare.journal) == ("", "2020-01-01", "")
    assert bare.authors == [] and bare.mesh_terms == []


def test_compressed_file_with_many_articles(spark, tmp_path):
    import gzip

    body = HEAD + "".join(FULL.replace(">111<", f">{i}<") for i in range(500)) + TAIL
    with gzip.open(os.path.join(tmp_path, "many.xml.gz"), "wt") as f:
        f.write(body)
    articles = read_articles(spark, str(tmp_path))
    assert articles.select("pmid").distinct().count() == 500


def test_large_file_is_split_between_records(spark, tmp_path):
    body = HEAD + "".join(FULL.replace(">111<", f">{i}<") for i in range(2000)) + TAIL
    (tmp_path / "big.xml").write_text(body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        articles = read_articles(spark, str(tmp_path))
        assert articles.rdd.getNumPartitions() > 10
        assert articles.select("pmid", "abstract_text").distinct().count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_xml_to_cleaned(spark, tmp_path):
    (tmp_path / "a.xml").write_text(HEAD + FULL + BARE + TAIL)
    raw = to_raw(read_articles(spark, str(tmp_path)), F.lit("2024-01-01"))
    rows = clean_abstracts(raw, F.lit("2024-01-02")).collect()
    assert [r.pmid for r in rows] == ["111"]
    assert rows[0].authors == ["Doe, Jane A", "Solo"]
    assert str(rows[0].pub_date) == "2019-10-07"
    assert rows[0].abstract_text.endswith("n=9 were followed. Plain section.")


def test_publication_dates(spark):
    cases = [
        ("2023", "Mar", "15", "2023-03-15"),
        ("2023", "3", "5", "2023-03-05"),
        ("2023", None, None, "2023-01-01"),
        ("2023", "Dec", None, "2023-12-01"),
        ("2023", None, "9", "2023-01-09"),
        ("2023", "Summer", "9", "2023-01-01"),
        ("2023", "Feb", "31", "2023-02-31"),
        ("2023", "Mar", "x", "2023-01-01"),
        (None, "Mar", "1", None),
        ("", "Mar", "1", None),
    ]
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(cases)],
        "i int, y string, m string, d string, want string",
    )
    date = publication_date(F.col("y"), F.col("m"), F.col("d"))
    rows = df.select("i", "want", date.alias("got"), F.try_to_date(date).alias("d")).orderBy("i")
    got = rows.collect()
    assert [r.got for r in got] == [r.want for r in got]
    assert got[6].d is None and got[0].d is not None
