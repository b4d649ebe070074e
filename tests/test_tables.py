import json

import pytest
from pyspark.sql import functions as F

from abstractmill.schemas import CLEANED, TABLES
from abstractmill.sources.tables import empty_table, jdbc_ready, read_table


def test_empty_tables(spark):
    for name, schema in TABLES.items():
        df = empty_table(spark, name)
        assert df.columns == schema.fieldNames() and df.count() == 0


def test_read_table_selects_and_casts(spark, tmp_path):
    row = spark.range(1).select(
        F.lit("1").alias("pmid"), F.lit("t").alias("title"), F.lit("x").alias("abstract_text"),
        F.array(F.lit("a")).alias("authors"), F.lit("2024-01-01").alias("pub_date"),
        F.array(F.lit("m")).alias("mesh_terms"), F.lit("j").alias("journal"),
        F.lit("2024-01-01").alias("cleaned_at"), F.lit(1).alias("extra"),
    )
    row.write.parquet(str(tmp_path / "full"))
    df = read_table(spark, "cleaned", str(tmp_path / "full"))
    assert df.columns == CLEANED.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in CLEANED]
    assert str(df.first().pub_date) == "2024-01-01"
    row.drop("title").write.parquet(str(tmp_path / "part"))
    with pytest.raises(Exception, match="title"):
        read_table(spark, "cleaned", str(tmp_path / "part"))


def test_nested_columns_become_json_for_a_database(spark):
    df = spark.sql("select '1' pmid, array('a', 'b') authors, named_struct('x', 1) r, 2 n")
    r = jdbc_ready(df).first()
    assert (r.pmid, json.loads(r.authors), json.loads(r.r), r.n) == ("1", ["a", "b"], {"x": 1}, 2)
