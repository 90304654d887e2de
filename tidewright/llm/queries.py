"""The registered queries of this subpackage: thin wrappers and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, code_compression, decontaminate, embedding_dedup, jaccard_join, language_model, license_scan, line_dedup, packing, personal_data, quality, token_counts, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_common_lines(_read(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH lines AS (
  SELECT d.rowid AS r, d.doc_id, u.pos, u.line,
         translate(trim(u.line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT row_number() OVER () AS rowid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       LATERAL (SELECT unnest(d.ls) AS line, unnest(range(1, len(d.ls) + 1)) AS pos) u
), common AS (
  SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10
), marked AS (
  SELECT l.*, c.k IS NOT NULL AS gone FROM lines l LEFT JOIN common c ON l.k = c.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "start", "end", "edits")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = language_model.score(docs, quality.fold("doc_id", 7) == 2)
    return found.withColumnRenamed("id", "doc_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(_read(spark, sf_dir, "pages"))
    return back.select(F.col("key").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")


OP4_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), h AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN holder END AS refers_to
FROM h
"""


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = personal_data.search(docs, personal_data.fit(docs))

    def text(column: str):  # noqa: ANN202
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):  # noqa: ANN202
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in personal_data.KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.classes(_read(spark, sf_dir, "documents"), jaccard_join.JaccardRule(words=3, num=9, den=10))
    return found.select(F.col("id").alias("doc_id"), F.col("n_grams").alias("n_shingles"), F.col("class_id").alias("component_id"))


OP6_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 90 * (p.n + q.n - k)
), reach(v, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.v, links.b FROM reach JOIN links ON reach.r = links.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.c AS component_id
FROM documents d JOIN (SELECT v, min(r) AS c FROM reach GROUP BY v) c ON c.v = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.context_table(token_counts.histogram(_read(spark, sf_dir, "documents")))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), size=2048)


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.classes(_read(spark, sf_dir, "embeddings"), threshold=0.93)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("class_id").alias("component_id"), (F.col("id") == F.col("class_id")).alias("kept"))


OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
), n AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach(v, r) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.v, links.b FROM reach JOIN links ON reach.r = links.a
), comp AS (
  SELECT v, min(r) AS c FROM reach GROUP BY v
)
SELECT e.vec_id, coalesce(l.n, 0) AS n_links, c.c AS component_id, e.vec_id = c.c AS kept
FROM embeddings e JOIN comp c ON c.v = e.vec_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = e.vec_id
"""


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    trees = quality.train(docs, _read(spark, sf_dir, "labels"))
    held_out = F.coalesce(quality.fold("doc_id", 5) == 0, F.lit(False))
    return quality.score(docs.select("doc_id", "text"), trees).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.score_links(_read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(_read(spark, sf_dir, "documents"))
    named = lambda *columns: F.array_join(F.array_sort(F.array_distinct(F.concat(*(F.transform(c, lambda d: d["label"]) for c in columns)))), ",")
    start = F.transform("base", lambda d: d["start"])
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
        named("base").alias("base_labels"), named("base", "found").alias("labels"), "score",
    )


def op13_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = code_compression.compress(_read(spark, sf_dir, "embeddings"))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    rows = code_compression.with_label_error(coded)
    return rows.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(code_compression.books_sha256(books)).alias("codebooks_sha256"))


def _op13_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    # The nearest entry of each part; of equal distances the lower entry.
    near = """SELECT v.r, v.p, min_by(b.e, (list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) ** 2))::HUGEINT * 1000 + b.e)) AS e,
              min(list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) ** 2)))::BIGINT AS d FROM parts v JOIN {book} b ON b.p = v.p GROUP BY v.r, v.p"""
    steps = []
    for k in range(rounds):
        mean = f"""SELECT p, e, list(c ORDER BY j) AS x FROM (
            SELECT v.p, n.e, j, floor(sum(v.x[j])::DOUBLE / count(*))::BIGINT AS c FROM near{k} n JOIN parts v ON v.r = n.r AND v.p = n.p, range(1, (SELECT max(len(x)) FROM parts) + 1) t(j) GROUP BY v.p, n.e, j
            ) GROUP BY p, e"""
        steps += [f"near{k} AS MATERIALIZED ({near.format(book=f'book{k}')})", f"mean{k} AS MATERIALIZED ({mean})", f"book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN mean{k} m ON m.p = b.p AND m.e = b.e)"]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, p, list_slice(x, (p * len(x) / {parts})::BIGINT + 1, ((p + 1) * len(x) / {parts})::BIGINT) AS x FROM kept, range({parts}) t(p)
), book0 AS MATERIALIZED (
  SELECT p, r - 1 AS e, x FROM parts WHERE r <= {entries}
), {', '.join(steps)}, coded AS MATERIALIZED ({near.format(book=f'book{rounds}')}
), vectors AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM coded GROUP BY r
), books AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS s FROM book{rounds}
)
SELECT k.vec_id, v.code, v.error, (sum(v.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, b.s AS codebooks_sha256
FROM kept k JOIN vectors v ON v.r = k.r, books b
"""


OP13_SQL = _op13_sql()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_warc": op4_warc,
    "op5_personal_data": op5_personal_data,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_token_counts": op7_token_counts,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_license_scan": op12_license_scan,
    "op13_code_compression": op13_code_compression,
}

ORACLE_SQL: dict[str, str] = {"op1_line_dedup": OP1_SQL, "op4_warc": OP4_SQL, "op6_ngram_jaccard_join": OP6_SQL, "op9_embedding_near_dedup": OP9_SQL, "op13_code_compression": OP13_SQL}
