"""The queries of the operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat_format, containment, filter_audit, jaccard, langid, line_index, lm_score, packing, quality, rlz, token_count, vector_codes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id_checksum(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document, learned from rows that are not held out."""
    return lm_score.document_scores(_table(spark, sf_dir, "documents"), _id_checksum(10) == 0)


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest rows by cosine of every row whose id is divisible by 50."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, dim=64)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    held_out = _id_checksum(4) == 2
    return langid.languages(docs, langid.fit(docs, ~held_out), held_out)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of 35 words that occur elsewhere."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return rlz.remove_repeats(docs, window=35).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains."""
    return containment.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings, formatted and read back."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    control = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat_format.read_back(chat_format.prefix_examples(rows.unionByName(control)))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set and the component it is linked to."""
    return jaccard.shingle_components(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document, learned from labels of those that are not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = _id_checksum(4) == 2
    return quality.scores(docs, quality.fit(docs, labels, ~held_out), held_out)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return token_count.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of every vector after four rounds over 256 entries of four parts."""
    codes, books = vector_codes.compressed(_table(spark, sf_dir, "embeddings"), dim=64, parts=4, entries=256, rounds=4)
    return vector_codes.with_label_errors(codes).withColumn("codebooks_sha256", F.lit(vector_codes.codebooks_sha256(books)))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of five filters in every order and step, by language."""
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that at least three documents hold, but for the last one of these."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_index.drop_repeated_lines(docs, least_chars=20, min_docs=3).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_ann": op2_ann,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_chat_format": op6_chat_format,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_quality": op8_quality,
    "op9_token_counts": op9_token_counts,
    "op10_packing": op10_packing,
    "op11_vector_codes": op11_vector_codes,
    "op12_filter_audit": op12_filter_audit,
    "op13_line_dedup": op13_line_dedup,
}

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(key: str, table: str) -> str:
    """SQL of the distinct five-word shingles of a table's texts, as (key, s)."""
    words = _WORDS.format(_LOWER)
    return f"""
        SELECT DISTINCT {key}, array_to_string(w[i : i + 4], ' ') AS s
        FROM (
            SELECT {key}, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i
            FROM (SELECT {key}, {words} AS w FROM {table})
        )"""


_ESCAPED = r"""regexp_replace(replace({}, '\', '\\'), '(<\|start\|>|<\|end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|endoftext\|>)', '.\1', 'g')"""



def _vector_codes(rounds: int) -> str:
    """SQL of product codes: each round is an assignment and new entries."""

    def assignment(n: int) -> str:
        return f"""
            a{n} AS MATERIALIZED (
                SELECT r, p, x, b.e, b.d FROM (
                    SELECT r, p, x, min(struct_pack(
                        d := (list_inner_product(x, x) - 2 * list_inner_product(x, y) + list_inner_product(y, y))::BIGINT, e := entry)) AS b
                    FROM v JOIN c{n} USING (p) GROUP BY r, p, x
                )
            )"""

    steps = []
    for n in range(rounds):
        steps += [
            assignment(n),
            f"""
            c{n + 1} AS MATERIALIZED (
                SELECT p, entry, coalesce(z, y) AS y FROM c{n} LEFT JOIN (
                    SELECT p, entry, list(floor(s / n) ORDER BY i) AS z FROM (
                        SELECT p, e AS entry, i, sum(x[i]) AS s, count(*) AS n FROM a{n}, (SELECT unnest(range(1, 17)) AS i) GROUP BY ALL
                    ) GROUP BY ALL
                ) USING (p, entry)
            )""",
        ]
    return f"""
        WITH kept AS (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label,
                   list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) = 64
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        v AS MATERIALIZED (SELECT r, p, e[16 * p + 1 : 16 * p + 16] AS x FROM kept, (SELECT unnest(range(4)) AS p)),
        c0 AS MATERIALIZED (SELECT p, r AS entry, x AS y FROM v WHERE r < 256),
        {",".join(steps)},
        {assignment(rounds)},
        rows AS (
            SELECT r, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY r
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(list_transform(y, lambda z: z::BIGINT), ','), ',' ORDER BY p, entry)) FROM c{rounds})
                   AS codebooks_sha256
        FROM kept JOIN rows USING (r)"""


#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op2_ann": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) = 64
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        n AS (SELECT vec_id, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b)) AS size FROM v),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_reduce(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]), lambda a, b: a + b) / (q.size * c.size) AS score
            FROM n q JOIN n c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 5""",
    "op4_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
        words AS (SELECT doc_id, len(w) AS size, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
        windows AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY sequence) AS n
            FROM (
                SELECT doc_id, i, size,
                       string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS sequence
                FROM words
            ) WHERE i + 34 <= size
        ),
        marked AS (
            SELECT words.doc_id, words.i, word,
                   coalesce(max(n) OVER (PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) > 1 AS gone
            FROM words LEFT JOIN windows USING (doc_id, i)
        )
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN (
            SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
            FROM marked GROUP BY doc_id
        ) USING (doc_id)""",
    "op5_decontamination": f"""
        WITH a AS ({_shingles("doc_id", "documents")}), b AS ({_shingles("item_id", "benchmark")}),
        n AS (SELECT item_id, count(*) AS item_shingles FROM b GROUP BY item_id)
        SELECT doc_id, item_id, item_shingles, shared, shared / item_shingles AS containment
        FROM (SELECT doc_id, item_id, count(*) AS shared FROM a JOIN b USING (s) GROUP BY ALL) JOIN n USING (item_id)
        WHERE 5 * shared >= 4 * item_shingles""",
    "op6_chat_format": f"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ),
        sized AS (
            SELECT *, 9 + length({_ESCAPED.format("role")}) + 1 + length({_ESCAPED.format("said")}) + 8 AS size,
                   lead(1) OVER o IS NULL AS last
            FROM said WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, said)
        ),
        upto AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn, role, said ROWS UNBOUNDED PRECEDING) AS chars FROM sized)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn, role, said)) AS turns_sha256,
               coalesce(sum(length(said)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(said, '' ORDER BY turn, role, said) FILTER (role = 'assistant'), '')) AS loss_sha256,
               (sum(chars) FILTER (role = 'assistant' OR last))::BIGINT AS formatted_chars
        FROM upto GROUP BY conv_id""",
    "op7_jaccard_join": f"""
        WITH RECURSIVE a AS ({_shingles("doc_id", "documents")}),
        n AS (SELECT doc_id, count(s) AS n FROM documents LEFT JOIN a USING (doc_id) GROUP BY doc_id),
        pairs AS (
            SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS shared
            FROM a x JOIN a y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
        ),
        links AS (
            SELECT u, v FROM pairs JOIN n p ON p.doc_id = u JOIN n q ON q.doc_id = v
            WHERE 100 * shared >= 80 * (p.n + q.n - shared)
        ),
        reach AS (
            SELECT doc_id AS u, doc_id AS v FROM documents
            UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
        )
        SELECT u AS doc_id, n AS n_shingles, min(v) AS component_id FROM reach JOIN n ON n.doc_id = u GROUP BY ALL""",
    "op11_vector_codes": _vector_codes(4),
    "op12_filter_audit": f"""
        WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        counted AS (
            SELECT doc_id, part, t, {_WORDS.format("t")} AS w, length(t) AS points,
                   length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS capitals,
                   doc_id > min(doc_id) OVER (PARTITION BY t) AS copy
            FROM d
        ),
        said AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        failed AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT + 4 * (100 * capitals > 10 * points)::INT
                   + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(copy, false)::INT AS f
            FROM counted LEFT JOIN said USING (doc_id)
        ),
        g AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY ALL),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ),
        s AS (
            SELECT filter_order, step, (1 << (ascii(filter_order[step]) - 65))::INT AS own,
                   list_sum(list_transform(range(1, step), lambda i: (1 << (ascii(filter_order[i]) - 65))::INT))::INT AS earlier
            FROM o, (SELECT unnest(range(1, 6)) AS step)
        )
        SELECT part, filter_order, step::INTEGER AS step,
               coalesce(sum(n) FILTER (f & (own | before) = 0), 0)::BIGINT AS kept,
               coalesce(sum(n) FILTER (f & own <> 0 AND f & before = 0), 0)::BIGINT AS removed,
               coalesce(sum(n) FILTER (f & own <> 0 AND f & before <> 0), 0)::BIGINT AS redundant,
               coalesce(sum(n) FILTER (f = own), 0)::BIGINT AS unique_fails,
               coalesce(sum(good) FILTER (f & own <> 0 AND f & before = 0), 0)::BIGINT AS good_lost,
               coalesce(sum(toxic) FILTER (f & own <> 0 AND f & before = 0), 0)::BIGINT AS toxic_lost,
               coalesce(sum(n * 120 // greatest(bit_count(f), 1)) FILTER (f & own <> 0), 0)::BIGINT AS shapley
        FROM g, (SELECT filter_order, step, own, coalesce(earlier, 0) AS before FROM s)
        GROUP BY part, filter_order, step""",
    "op13_line_dedup": f"""
        WITH l AS (
            SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i, unnest(keys) AS key
            FROM (
                SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines,
                       list_transform(string_split({_LOWER}, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS keys
                FROM documents
            )
        ),
        found AS (
            SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ),
        marked AS (SELECT l.*, keeper IS NOT NULL AND l.doc_id <> keeper AS gone FROM l LEFT JOIN found USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
}
