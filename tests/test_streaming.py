import os
from pyspark.sql import functions as F

from abstractmill.streaming.arrivals import ingest_stream, read_raw

ARTICLE = (
    "<PubmedArticle><MedlineCitation><PMID>{}</PMID><Article><ArticleTitle>{}</ArticleTitle>"
    "</Article></MedlineCitation></PubmedArticle>\n"
)


def _titles(spark, raw):
    rows = read_raw(spark, raw).select("pmid", F.get_json_object("raw_json", "$.title").alias("t"))
    return {r.pmid: r.t for r in rows.collect()}


def test_files_are_ingested_once_and_first_record_wins(spark, tmp_path):
    incoming, raw, marks = (str(tmp_path / n) for n in ("in", "raw", "marks"))
    (tmp_path / "in").mkdir()

    def arrive(name, *articles):
        body = "".join(ARTICLE.format(*a) for a in articles)
        (tmp_path / "in" / name).write_text(f"<PubmedArticleSet>\n{body}</PubmedArticleSet>")

    def run(checkpoint=marks):
        query = ingest_stream(spark, incoming, raw, checkpoint, F.lit("2024-01-01"), max_files=1)
        assert query.awaitTermination(120)

    arrive("a.xml", ("1", "a"), ("2", "b"))
    run()
    assert _titles(spark, raw) == {"1": "a", "2": "b"}
    arrive("b.xml", ("2", "later"), ("3", "c"))
    run()
    assert _titles(spark, raw) == {"1": "a", "2": "b", "3": "c"}
    run()
    assert read_raw(spark, raw).count() == 3


def test_replayed_batches_replace_themselves(spark, tmp_path):
    incoming, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(ARTICLE.format("1", "a") + ARTICLE.format("2", "b"))
    for attempt in ("first", "second"):
        query = ingest_stream(spark, incoming, raw, str(tmp_path / attempt), F.lit("2024-01-01"))
        assert query.awaitTermination(120)
        assert _titles(spark, raw) == {"1": "a", "2": "b"}
        assert read_raw(spark, raw).count() == 2


def test_earliest_file_of_a_batch_wins(spark, tmp_path):
    incoming, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    (tmp_path / "in").mkdir()
    for name, title, time in (("b.xml", "z first", 1000), ("a.xml", "a later", 2000)):
        (tmp_path / "in" / name).write_text(ARTICLE.format("1", title))
        os.utime(tmp_path / "in" / name, (time, time))
    query = ingest_stream(spark, incoming, raw, str(tmp_path / "marks"), F.lit("2024-01-01"))
    assert query.awaitTermination(120)
    assert _titles(spark, raw) == {"1": "z first"}
