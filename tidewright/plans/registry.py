from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import doc_ids as DI
from ..operators import documents as D
from ..operators import registry as R
from ..sources.tables import Tables
from .views import sql


def _sets(t: Tables):  # noqa: ANN202
    d = t.documents().select("doc_id", "source", "n")
    slug_map = d.filter("n % 6 <> 5").select(F.col("source").alias("source_id")).distinct()
    graph = d.select(F.when(F.col("doc_id") % 50 == 7, None).otherwise(F.concat("source", F.when(F.col("n") == 3, "x").otherwise(""))).alias("source_id"))
    return slug_map, graph, t.source_policy()


def _resolve(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    reg = t.source_policy().filter("n % 3 <> 1").select(F.col("source_id").alias("slug"), F.concat(F.lit("Name "), "n").alias("name"), F.concat(F.lit("https://a.example/"), "n").alias("url"))
    return R.resolve(t.documents().select(F.col("source").alias("slug")).distinct(), reg)


def _upsert(s, d):  # noqa: ANN001, ANN202
    p = Tables(s, d).source_policy()
    old = p.filter("n % 3 <> 0").select(F.col("source_id").alias("slug"), F.concat(F.lit("old_"), "n").alias("source_id"), F.lit("x").alias("policy"))
    new = p.filter("n % 3 <> 1").select(F.col("source_id").alias("slug"), F.concat(F.lit("new_"), "n").alias("source_id"), F.col("archive_policy").alias("policy"))
    return R.upsert(old, new)


def _shares(s, d):  # noqa: ANN001, ANN202
    rows = Tables(s, d).documents().withColumn("perspective", F.element_at(F.array(*map(F.lit, ("neutral", "risk", "opportunity", "mixed"))), F.least(F.col("n") % 5, F.lit(3)) + 1))
    return R.shares(rows, "perspective", {"risk": (0, 50), "opportunity": (25, 100), "neutral": (15, 100)})


def _edges(t: Tables):  # noqa: ANN202
    e = t.doc_source_edge().select("source_id", "doc_id", "snap_id")
    old = e.withColumn("snap_id", F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("old_"), "snap_id")).otherwise(F.col("snap_id")))
    return old, e


def _missing(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    return D.missing_parents(t.documents().select("doc_id", F.col("source").alias("source_id")), "source_id", t.source_policy())


def _created(s, d):  # noqa: ANN001, ANN202
    h = Tables(s, d).hashed()
    changed = F.sha2(F.concat(F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" "), "source")).otherwise("")), 256)
    return D.merge_created(h, h.withColumn("content_hash", changed), "content_hash")


def _survivors(s, d):  # noqa: ANN001, ANN202
    from ..operators.audit import survivors

    return survivors(Tables(s, d).hashed().select("doc_id", "content_hash"), "content_hash", "doc_id").select("doc_id", "survivor")


def _membership(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    return t.documents().join(t.source_policy().filter("llm_policy = 'allowed'").select(F.col("source_id").alias("source")), "source", "left_semi").select("doc_id", F.coalesce(F.col("lang").isin("en", "fr"), F.lit(False)).alias("known_lang"))


def _pollable(s, d):  # noqa: ANN001, ANN202
    p = Tables(s, d).source_policy()
    reg = p.select(F.col("source_id").alias("slug"), F.when(F.col("n") % 4 == 0, "api").otherwise("rss").alias("access_method"), (F.col("n") % 3).cast("int").alias("reliability_tier"), F.when(F.col("n") % 7 == 6, "ftp://x").otherwise(F.concat(F.lit("https://a.example/rss/"), "n")).alias("rss_url"), (F.col("n") % 5 != 4).alias("active_v0"))
    return R.pollable(reg, p.select(F.col("source_id").alias("slug"), F.concat(F.lit("src_"), "n").alias("source_id")))


def _versions(s, d):  # noqa: ANN001, ANN202
    return R.latest_version(s.createDataFrame([("v1",), ("v9",), ("v10",), ("v2",)], "version string"))


def _ids(s, d):  # noqa: ANN001, ANN202
    i = F.col("doc_id")
    number = i + F.floor(i / 9) - F.when(i % 25 < 4, i % 25).otherwise(0)
    return D.gaps(Tables(s, d).documents().select(F.col("lang").alias("prefix"), number.cast("long").alias("number")))


def _terms(s, d):  # noqa: ANN001, ANN202
    rows = Tables(s, d).base("conversations").select(F.transform(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z]{5,}"), F.lit(0)), F.lower).alias("terms"))
    return D.term_usage(rows, "terms")


def _refs(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d).documents()
    definitions = t.select(F.concat(F.lit("REF-"), F.col("doc_id") * 2 % 300).alias("ref"))
    return D.references(definitions, t.select(F.concat(F.lit("REF-"), F.col("doc_id") % 310).alias("ref")), "ref")


def _doc_ids(s, d):  # noqa: ANN001, ANN202
    """Every document's text with headings, tables, links and code that name ids."""
    i = F.col("doc_id")
    n = lambda k, mod: F.lpad((i * k % mod + 100).cast("string"), 3, "0")
    text = F.concat(
        F.coalesce("text", F.lit("")), F.lit("\n\n## `REQ-"), n(1, 700), F.lit("`: title\n| DEC-"), n(3, 500), F.lit(" | row |\nsee AC-"), n(7, 300), F.lit(" and [the DEC-"), n(5, 600), F.lit("](https://a.example/NFR-101)\n"),
        F.lit("```\nTASK-123\n```\n    SPIKE-123\n<!-- TRACE-123 -->\n- ASM-"), n(11, 800), F.lit(": so\nhttps://a.example/TEST-123 ![NFR-102](x)\n"),
    )
    path = F.when(i % 10 == 0, F.concat(F.lit("docs/adr/"), F.lpad((i % 4000 + 100).cast("string"), 4, "0"), F.lit("-x.md"))).otherwise(F.concat(F.lit("docs/"), i.cast("string"), F.lit(".md")))
    found = DI.found_ids(Tables(s, d).documents().select(path.alias("path"), text.alias("text")))
    return DI.problems(found)


QUERIES = {
    "doc_id_problems": _doc_ids,
    "registry_preflight": lambda s, d: R.preflight(*_sets(Tables(s, d))),
    "registry_id_counts": lambda s, d: R.id_counts(_sets(Tables(s, d))[1]),
    "registry_resolve": _resolve,
    "registry_upsert": _upsert,
    "registry_pollable": _pollable,
    "perspective_share": _shares,
    "relink_edges": lambda s, d: D.relinked(*_edges(Tables(s, d))),
    "missing_parents": _missing,
    "merge_created": _created,
    "duplicate_survivors": _survivors,
    "id_membership": _membership,
    "latest_version": _versions,
    "id_uniqueness_gaps": _ids,
    "term_usage": _terms,
    "def_ref_resolution": _refs,
}

_SETS = """sm AS (SELECT DISTINCT source AS source_id FROM docs WHERE n % 6 <> 5), gr AS (SELECT CASE WHEN doc_id % 50 = 7 THEN NULL ELSE source || CASE WHEN n = 3 THEN 'x' ELSE '' END END AS source_id FROM docs), po AS (SELECT source_id FROM source_policy)"""


def _minus(a: str, b: str, name: str) -> str:
    return f"SELECT '{name}' AS difference, source_id FROM (SELECT source_id FROM {a} WHERE source_id IS NOT NULL EXCEPT SELECT source_id FROM {b})"


SQL = {
    "doc_id_problems": """WITH c AS (SELECT 'REQ-' || (doc_id % 700 + 100) AS id, 'c' AS role FROM documents UNION ALL SELECT 'ASM-' || (doc_id * 11 % 800 + 100), 'c' FROM documents
            UNION ALL SELECT 'ADR-' || lpad((doc_id % 4000 + 100)::VARCHAR, 4, '0'), 'c' FROM documents WHERE doc_id % 10 = 0 UNION ALL SELECT 'DEC-' || (doc_id * 3 % 500 + 100), 't' FROM documents),
        r AS (SELECT 'AC-' || (doc_id * 7 % 300 + 100) AS id, 'r' AS role FROM documents UNION ALL SELECT 'DEC-' || (doc_id * 5 % 600 + 100), 'r' FROM documents UNION ALL SELECT id, 'r' FROM c WHERE id NOT LIKE 'ADR%'),
        g AS (SELECT id, count(*) FILTER (role = 'c') AS c, count(*) FILTER (role = 't') AS t, count(*) FILTER (role = 'r') AS r FROM (SELECT * FROM c UNION ALL SELECT * FROM r) GROUP BY 1), d AS (SELECT *, CASE WHEN c > 0 THEN c ELSE t END AS n FROM g)
        SELECT id, CASE WHEN n > 1 THEN 'duplicate_definition' ELSE 'dangling_reference' END AS problem, CASE WHEN n > 1 THEN n ELSE r END AS places FROM d WHERE n <> 1""",
    "registry_preflight": sql(f"WITH {_SETS} {_minus('sm', 'gr', 'slug_map_minus_graph')} UNION ALL {_minus('gr', 'sm', 'graph_minus_slug_map')} UNION ALL {_minus('po', 'sm', 'policy_minus_slug_map')} UNION ALL {_minus('sm', 'po', 'slug_map_minus_policy')}"),
    "registry_id_counts": sql(f"WITH {_SETS} SELECT source_id, count(*) AS n FROM gr WHERE source_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT NULL, count(*) - count(source_id) FROM gr"),
    "registry_resolve": sql("WITH r AS (SELECT source_id AS slug, 'Name ' || n AS name, 'https://a.example/' || n AS url FROM source_policy WHERE n % 3 <> 1) SELECT d.slug, coalesce(r.name, d.slug) AS name, r.url FROM (SELECT DISTINCT source AS slug FROM docs) d LEFT JOIN r USING (slug)"),
    "registry_upsert": sql("SELECT source_id AS slug, CASE WHEN n % 3 <> 0 THEN 'old_' || n ELSE 'new_' || n END AS source_id, CASE WHEN n % 3 <> 1 THEN archive_policy ELSE 'x' END AS policy, CASE n % 3 WHEN 0 THEN 'inserted' WHEN 1 THEN 'kept' ELSE 'updated' END AS change FROM source_policy"),
    "registry_pollable": sql("SELECT 'src_' || n AS source_id, 'https://a.example/rss/' || n AS feed_url FROM source_policy WHERE n % 4 <> 0 AND n % 3 = 0 AND n % 7 <> 6 AND n % 5 <> 4"),
    "perspective_share": sql("""WITH g AS (SELECT (['neutral', 'risk', 'opportunity', 'mixed'])[least(n % 5, 3) + 1] AS value, count(*) AS n FROM docs GROUP BY 1), p AS (SELECT value, n, n * 100 / sum(n) OVER () AS percent FROM g)
        SELECT value, n, percent, CASE value WHEN 'risk' THEN percent <= 50 WHEN 'opportunity' THEN percent >= 25 WHEN 'neutral' THEN percent >= 15 ELSE true END AS within FROM p"""),
    "relink_edges": sql("WITH e AS (SELECT DISTINCT source_id, doc_id, snap_id FROM doc_source_edge) SELECT source_id, doc_id, snap_id, doc_id % 4 = 0 AS added FROM e UNION ALL SELECT source_id, doc_id, 'old_' || snap_id, false FROM e WHERE doc_id % 4 = 0"),
    "missing_parents": sql("SELECT doc_id, source AS source_id FROM docs WHERE source NOT IN (SELECT source_id FROM source_policy)"),
    "merge_created": sql("WITH w AS (SELECT DISTINCT sha256(coalesce(text, '') || CASE WHEN doc_id % 3 = 0 THEN ' ' || source ELSE '' END) AS content_hash FROM documents) SELECT content_hash, CASE WHEN content_hash IN (SELECT content_hash FROM hashed) THEN 'matched' ELSE 'created' END AS outcome FROM w"),
    "duplicate_survivors": sql("SELECT doc_id, min(doc_id) OVER (PARTITION BY content_hash) AS survivor FROM hashed"),
    "id_membership": sql("SELECT doc_id, coalesce(lang IN ('en', 'fr'), false) AS known_lang FROM docs WHERE source IN (SELECT source_id FROM source_policy WHERE llm_policy = 'allowed')"),
    "latest_version": "SELECT 'v10' AS version",
    "id_uniqueness_gaps": """WITH r AS (SELECT lang AS prefix, doc_id + doc_id // 9 - CASE WHEN doc_id % 25 < 4 THEN doc_id % 25 ELSE 0 END AS number FROM documents), n AS (SELECT prefix, number, count(*) AS times FROM r GROUP BY 1, 2),
        g AS (SELECT *, coalesce(lead(number) OVER (PARTITION BY prefix ORDER BY number) - number - 1, 0) AS gap FROM n) SELECT * FROM g WHERE times > 1 OR gap > 0""",
    "term_usage": "SELECT lower(t) AS term, count(*) AS uses FROM (SELECT unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z]{5,}')) AS t FROM conversations) GROUP BY 1",
    "def_ref_resolution": """WITH d AS (SELECT 'REF-' || (doc_id * 2 % 300) AS ref FROM documents), u AS (SELECT DISTINCT 'REF-' || (doc_id % 310) AS ref FROM documents)
        SELECT ref, 'duplicate_definition' AS problem FROM d GROUP BY ref HAVING count(*) > 1 UNION ALL SELECT ref, 'dangling_reference' FROM u WHERE ref NOT IN (SELECT ref FROM d)""",
}
