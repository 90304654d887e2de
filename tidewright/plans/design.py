from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import design as G
from ..operators import documents as D
from ..operators import extraction as E
from ..operators import metric_specs as M
from ..operators.modularity import modular_communities
from ..operators.search_index import SearchIndex
from ..operators.vector_index import VectorIndex
from ..scratch import Scratch
from ..sources.tables import Tables
from .views import sql


def _at(text: str):  # noqa: ANN202
    return F.lit(dt.datetime.fromisoformat(text)).cast("timestamp_ntz")


def _pick(values, index):  # noqa: ANN001, ANN202
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


def _stale(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    e = t.base("events").select("event_id", "ts", F.concat(F.lit("/p"), F.col("user_id")).alias("url"), F.when(F.col("value") < 20, "h1").otherwise("h2").alias("hash"))
    claims = e.select(F.col("event_id").alias("claim_id"), "url", "hash", F.col("ts").alias("at"), F.when(F.col("event_id") % 3 == 0, 10).alias("stale_after"))
    return G.stale_claims(claims, e.select("url", "hash", F.col("ts").alias("at")), t.base("events").filter("event_type = 'error' and value > 150").select(F.col("event_id").alias("claim_id")), _at("2024-02-05"))


def _routed(t: Tables):  # noqa: ANN202
    return G.auto_confirm(t.claim_quote().withColumn("tier", F.col("n") % 4))


def _scenarios(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    lines = t.base("lineitem").select("l_orderkey", F.struct("l_linenumber", F.when(F.col("l_quantity") > 2, F.col("l_discount")).alias("weight"), F.when(F.col("l_tax") > 0.0, F.array(F.lit("f"))).otherwise(F.array().cast("array<string>")).alias("falsifiers"), F.when(F.col("l_returnflag") != "R", F.array(F.lit("s"))).otherwise(F.array().cast("array<string>")).alias("signals")).alias("b"))
    b = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("b")).alias("branches"))
    o = t.base("orders").select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.array().cast("array<string>")).otherwise(F.array(F.lit("c"))).alias("counterclaims"))
    return G.scenario_checks(o.join(b, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderkey").alias("scenario_id"), "branches", "counterclaims"))


def _cites(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    i = F.col("doc_id")
    claims = t.documents().select(F.concat(F.lit("clm_"), "doc_id").alias("claim_id"), "source", (i % 53 == 1).alias("stale"), (i % 59 == 1).alias("retracted"), (i % 61 == 1).alias("horizon"), (i % 67 == 1).alias("unit"), (i % 71 == 1).alias("overclaim"))
    cites = t.documents().select(F.concat(F.lit("drf_"), F.floor(i / 5).cast("long")).alias("draft_id"), F.concat(F.when(i % 41 == 40, "gone_").otherwise("clm_"), "doc_id").alias("claim_id"))
    blocked = t.intervention().filter("status = 'pending_user_review' and gate_mode = 'inline_block' and importance >= 1.2").select(F.col("source_id").alias("source"))
    return G.cite_check(cites, claims, blocked)


def _recall(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    v = t.base("embeddings")
    near = G.knn(v, v.filter("vec_id % 50 = 0"), 10)
    same = v.select(F.col("vec_id").alias("other_id"), "label")
    got = near.join(same, "other_id").groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "other_id", "label"))), lambda x: x["other_id"]).alias("retrieved"), F.array_sort(F.collect_list(F.when(F.col("other_id") % 2 == 0, F.col("other_id")))).alias("expected"))
    return G.recall_at_k(got.withColumnRenamed("query_id", "case_id"), 5)


def _knn(s, d):  # noqa: ANN001, ANN202
    v = Tables(s, d).base("embeddings")
    return G.knn(v, v.filter("vec_id % 50 = 0"), 5).select("query_id", "other_id", F.col("rank").cast("long").alias("rank"), F.round("cosine", 9).alias("cosine"))


def _ann(s, d):  # noqa: ANN001, ANN202
    """Each query's neighbours over the index; what share of the exact ones they are is tested."""
    v = Tables(s, d).base("embeddings")
    found = VectorIndex(v).search(v.filter("vec_id % 50 = 0"), 5)
    return found.select("query_id", "other_id", F.col("rank").cast("long").alias("rank"), F.round("cosine", 9).alias("cosine"))


def _graph(t: Tables):  # noqa: ANN202
    n = t.documents().count()
    return t.documents().select(F.col("doc_id").alias("src"), ((F.col("doc_id") * 7 + 1) % n).alias("dst"))


def _lineage(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    return D.lineage(_graph(t), t.documents().select(F.col("doc_id").alias("node")), 5).withColumn("hops", F.col("hops").cast("long"))


def _revisions(s, d):  # noqa: ANN001, ANN202
    """Each document supersedes the one at a third of its number: a forest as deep as the logarithm of its size."""
    docs = Tables(s, d).documents()
    edges = docs.filter("doc_id > 0").select(F.col("doc_id").alias("src"), F.floor(F.col("doc_id") / 3).cast("long").alias("dst"))
    return D.lineage(edges, docs.select(F.col("doc_id").alias("node"))).withColumn("hops", F.col("hops").cast("long"))


_TRACE = ("draft", "thesis", "revision", "claim", "snapshot")


def _trace(s, d):  # noqa: ANN001, ANN202
    """Two theses a publication; claims that were entered by hand have no snapshot."""
    t = Tables(s, d)
    claims = t.claim_quote().select("thesis_id", "claim_id", "doc_id")
    n = F.regexp_extract("thesis_id", "([0-9]+)", 1).cast("long")
    theses = claims.select("thesis_id").distinct().withColumn("n", n)
    link = lambda rows, src, dst, kind: rows.select(F.expr(src).alias("src"), F.expr(dst).alias("dst"), F.lit(kind).alias("type"))
    edges = link(theses, "'pub_' || (n div 2)", "'drf_' || n", "draft")
    edges = edges.unionByName(link(theses, "'drf_' || n", "thesis_id", "thesis")).unionByName(link(theses, "thesis_id", "'scn_' || n || '_r1'", "revision"))
    edges = edges.unionByName(link(claims.withColumn("n", n), "'scn_' || n || '_r1'", "claim_id", "claim"))
    edges = edges.unionByName(link(claims.filter("doc_id % 20 <> 0").join(t.documents().select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h")), "doc_id"), "claim_id", "'snap_' || substr(h, 1, 16)", "snapshot"))
    return D.trace(edges, edges.filter("type = 'draft'").select(F.col("src").alias("node")).distinct(), _TRACE)


def _cited_bodies(s, d):  # noqa: ANN001, ANN202
    """Promoted claims that no scenario cites, in its list or its body; ids of every fifth hold a dash."""
    t = Tables(s, d)
    name = lambda i: F.concat(F.lit("clm_"), i.cast("string"), F.when(i % 5 == 0, "-b").otherwise(""))
    i = F.col("doc_id")
    promoted = t.claim_quote().filter("confidence_pct >= 85").select(name(i).alias("claim_id"))
    body = F.concat(F.coalesce("text", F.lit("")), F.lit(" see "), name(i * 3), F.lit(", ("), name(i * 5), F.lit("); not x"), name(i * 2), F.lit(" nor "), name(i * 7), F.lit("_c"))
    return promoted.join(D.cited(promoted, t.documents().select(F.array(name(i * 11)).alias("listed"), body.alias("body"))), "claim_id", "left_anti")


def _search(s, d):  # noqa: ANN001, ANN202
    found = claim_index(s, d).one_hop("the with")
    return found.select(F.col("id").cast("long").alias("id"), F.col("score").cast("long").alias("score"), "neighbours")


def _one_sided(s, d):  # noqa: ANN001, ANN202
    x = Tables(s, d).claim_quote().select("thesis_id", _pick(("positive", "negative", "neutral", "positive", "positive"), F.floor(F.col("doc_id") / 3)).alias("direction"))
    return G.one_sided(x)


def _review_coverage(s, d):  # noqa: ANN001, ANN202
    runs = Tables(s, d).run_ledger().select("run_id", "tier", "vendor")
    reviews = runs.select("run_id", F.when((F.col("run_id") % 30 == 4) | (F.col("run_id") % 20 == 3), F.col("vendor")).otherwise(F.lit("vendor9")).alias("vendor"))
    return G.review_coverage(runs, reviews)


def _session(s, d):  # noqa: ANN001, ANN202
    c = Tables(s, d).base("conversations").select(F.col("conv_id").alias("session"), F.col("turn").alias("round"), (F.length("text") % 3).alias("answer"), (F.length("text") % 100 / 100).alias("confidence"))
    return G.session_stop(c, 0.97, 4)


def _tiers(s, d):  # noqa: ANN001, ANN202
    i = F.col("doc_id")
    yes = lambda k: F.when(i % k == 0, "no").otherwise("yes")
    rows = Tables(s, d).documents().select("doc_id", F.struct(yes(3).alias("access"), yes(5).alias("stability"), yes(7).alias("terms"), yes(2).alias("structure")).alias("collectability"))
    return G.tier_rules(rows).select("doc_id", "tier")


def _superseded(s, d):  # noqa: ANN001, ANN202
    e = Tables(s, d).base("events").select(F.concat(F.lit("snap_"), "event_id").alias("snap_id"), F.concat(F.lit("/p"), F.col("user_id")).alias("url"), F.col("ts").alias("at"), "event_type")
    return G.superseded(e, e.filter("event_type = 'purchase'")).select("snap_id", "url")


def _monthly(t: Tables):  # noqa: ANN202
    o = t.base("orders").select((F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).alias("month"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return o.groupBy("month").agg(F.sum("cents").alias("cents"))


def _zscore(s, d):  # noqa: ANN001, ANN202
    x = Tables(s, d).base("lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("flag"), "l_quantity")
    return G.zscores(x, "l_quantity", "flag", 1.7).select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"), F.round("z", 6).alias("z"), "anomaly")


def _pivot(s, d):  # noqa: ANN001, ANN202
    o = Tables(s, d).base("orders").select(F.year("o_orderdate").cast("long").alias("year"), "o_orderstatus")
    return o.groupBy("year").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).na.fill(0).select("year", F.col("F").alias("n_f"), F.col("O").alias("n_o"), F.col("P").alias("n_p"))


def _cohort(s, d):  # noqa: ANN001, ANN202
    o = Tables(s, d).base("orders").select(F.col("o_custkey").alias("c"), F.year("o_orderdate").cast("long").alias("p"))
    return G.cohorts(o, "c", "p")


def _evaluation(s, d):  # noqa: ANN001, ANN202
    v = Tables(s, d).base("embeddings")
    near = G.knn(v, v.filter("vec_id % 50 = 0"), 10).join(v.select(F.col("vec_id").alias("other_id"), "label"), "other_id")
    cases = near.groupBy(F.col("query_id").alias("case_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "other_id"))), lambda x: x["other_id"]).alias("retrieved"), F.array_sort(F.collect_list(F.when(F.col("other_id") % 2 == 0, F.col("other_id")))).alias("expected"))
    recalls = G.recall_at_k(cases, 5).withColumn("run", F.concat(F.lit("eval_"), (F.col("case_id") / 50).cast("long") % 2))
    out = G.evaluation_run(recalls, near.select(F.col("query_id").alias("case_id"), F.col("label").alias("source")))
    return out.select("run", "total_cases", *(F.round(c, 9).alias(c) for c in ("pass_rate", "mean_recall", "mean_diversity")))


def _presence(s, d):  # noqa: ANN001, ANN202
    x = Tables(s, d).claim_quote().select(F.col("thesis_id").alias("publication_id"), _pick(("positive", "neutral", "neutral", "neutral", "negative", "neutral", "neutral"), F.floor(F.col("doc_id") / 3)).alias("direction"))
    return G.presence_rates(x)


def _nodes(t: Tables):  # noqa: ANN202
    """Six kinds of nodes, each with a name and a text."""
    node = lambda table, kind, key, name, text: table.select(F.lit(kind).alias("kind"), F.concat(F.lit(f"{kind}_"), key).alias("id"), name.alias("name"), text.alias("text"))
    docs, none = t.documents(), F.lit(None).cast("string")
    out = node(docs, "document", F.col("doc_id"), F.col("source"), F.col("text"))
    out = out.unionByName(node(t.claim_quote(), "claim", F.col("doc_id"), none, F.col("quote")))
    out = out.unionByName(node(t.source_policy(), "source", F.col("source_id"), F.col("source_id"), F.concat_ws(" ", F.regexp_replace("archive_policy", "_", " "), F.regexp_replace("llm_policy", "_", " "))))
    out = out.unionByName(node(t.base("conversations"), "chunk", F.concat_ws("_", "conv_id", "turn"), F.col("role"), F.col("text")))
    out = out.unionByName(node(t.base("benchmark"), "thesis", F.col("item_id"), none, F.col("text")))
    return out.unionByName(node(t.base("pages"), "scenario", F.col("page_id"), none, F.regexp_replace("url", "[^A-Za-z0-9]", " ")))


QUERY = "the pollution of Ethers and ther's with source2 collect"


def text_index(s, d):  # noqa: ANN001, ANN201
    """All six kinds in two segments, with the claims' edges."""
    t = Tables(s, d)
    claim = lambda i: F.concat(F.lit("claim_"), i)
    edges = _graph(t).select(claim("src").alias("src"), claim("dst").alias("dst"), _pick(("SUPPORTS", "CONTRADICTS", "QUALIFIES", "MENTIONS"), F.col("src")).alias("kind"))
    nodes, index = _nodes(t), SearchIndex(s, Scratch(s, "search").path("index"), D.analysed)
    own = F.col("kind").isin("document", "claim")
    return index.add(nodes.filter(own), ["name", "text"], edges).add(nodes.filter(~own), ["name", "text"])


def claim_index(s, d):  # noqa: ANN001, ANN201
    """Documents by the occurrences of their words, with the edges between them."""
    t = Tables(s, d)
    index = SearchIndex(s, Scratch(s, "search").path("claims"), D.every_word, "count")
    nodes = t.documents().select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    return index.add(nodes, ["text"], _graph(t).withColumn("kind", F.lit("LINK")))


def _fulltext(s, d):  # noqa: ANN001, ANN202
    found = text_index(s, d).one_hop(QUERY, kinds=("SUPPORTS", "CONTRADICTS", "QUALIFIES"))
    return found.select("kind", "id", "score", F.col("place").cast("long").alias("place"), "neighbours")


def _graph_scan(s, d):  # noqa: ANN001, ANN202
    """Vertices and edges of the document graph as one relation; edges to unregistered sources do not exist."""
    t = Tables(s, d)
    edge = t.doc_source_edge()
    vertices, edges = D.graph(
        {"Document": (t.documents(), "doc_id"), "Source": (t.source_policy(), "source_id"), "Snapshot": (t.snapshot(), "snap_id")},
        {"FROM": (edge, "doc_id", "Document", "source_id", "Source"), "SNAPSHOT_OF": (edge, "snap_id", "Snapshot", "doc_id", "Document")},
    )
    none = F.lit(None).cast("string")
    return vertices.select("id", none.alias("dst"), F.col("label").alias("kind")).unionByName(edges.select(F.col("src").alias("id"), "dst", F.col("type").alias("kind")))


def _guard(s, d):  # noqa: ANN001, ANN202
    return G.payload_guard(Tables(s, d).base("conversations"), "text")


def _spec(s, d):  # noqa: ANN001, ANN202
    """Derived metrics by a specification, each under its reproducibility key; a key that repeats is reported."""
    m = G.rolling(G.year_over_year(_monthly(Tables(s, d)), "month", "cents"), "month", "cents", 3)
    out = m.select(F.concat_ws("|", F.lit("v1"), F.lit("spec1"), F.lit("lock1"), F.concat(F.lit("met_"), F.when(F.col("month") % 40 == 0, 1).otherwise(F.col("month")).cast("string"))).alias("key"))
    return G.repeated_keys(out, ["key"])


#: Two specifications as they would lie in files, one of them twice with other blanks.
SPECS = (
    ("lineitem", {"id": "met_quantity", "group": ["l_returnflag", "month"], "value": "cast(round(l_quantity * 100) as bigint)", "function": "sum", "filter": "l_linestatus = 'F'", "order": "month", "window": 3}),
    ("orders", '{"id": "met_orders", "group": ["o_orderpriority", "year"], "value": "o_orderkey", "function": "count", "order": "year", "change": 1, "decimals": 9}'),
    ("orders", '{ "function": "count", "id": "met_orders", "group": ["o_orderpriority", "year"], "value": "o_orderkey", "order": "year", "change": 1, "decimals": 9 }'),
)


def _derived(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    tables = {
        "lineitem": t.base("lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM")),
        "orders": t.base("orders").withColumn("year", F.year("o_orderdate")),
    }
    return M.derived(tables, SPECS, "vintage_1", {"engine": "1"}).select("metric", "spec_sha256", "dimensions", "value")


def _near(s, d):  # noqa: ANN001, ANN202
    return D.near_duplicates(Tables(s, d).documents()).select(F.col("id").alias("doc_id"), "class_id")


def _mentions(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    b = t.base("benchmark").select("item_id", F.col("text").alias("needle"))
    return D.mentions(t.documents(), b, "needle").select("doc_id", "item_id")


def _uncited(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    promoted = t.claim_quote().filter("confidence_pct >= 85").select("claim_id", "doc_id")
    listed = t.documents().select(F.explode(F.array(F.concat(F.lit("clm_"), F.col("doc_id") * 3), F.concat(F.lit("clm_"), F.col("doc_id") * 5))).alias("claim_id")).distinct()
    return promoted.join(listed, "claim_id", "left_anti").select("claim_id")


def _extract(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    pages = t.base("pages").select(F.col("page_id").alias("id"), F.concat(F.lit("src"), F.col("page_id") % 20).alias("source_id"), "html")
    # A call's price is a millionth of its prompt's length; the client forgets to say it for some, and answers some in no JSON.
    client = lambda prompt: F.when(F.col("id") % 17 == 5, F.lit("no JSON")).otherwise(E.stub_client(prompt))
    return E.articles(pages, t.source_policy(), client, lambda prompt, reply: F.when(F.col("id") % 13 != 12, F.length(prompt) / 1e6))


def _routing(s, d):  # noqa: ANN001, ANN202
    r = E.Registry()
    r.register("article", lambda df: df.withColumn("result", F.upper(F.substring("text", 1, 5))))
    r.register("dataset", lambda df: df.withColumn("result", F.length("text").cast("string")))
    rows = Tables(s, d).documents().select(F.col("doc_id").alias("id"), _pick(("article", "dataset", "report"), F.col("doc_id")).alias("source_type"), F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "").alias("text"))
    return r.route(rows)


QUERIES = {
    "stale_claims": _stale,
    "auto_confirm_fp": lambda s, d: G.confirm_error_rate(_routed(Tables(s, d)), Tables(s, d).base("labels")),
    "scenario_validate": _scenarios,
    "cite_check": _cites,
    "evidence_pack": lambda s, d: G.evidence_pack(Tables(s, d).claim_quote()),
    "coverage_gate": lambda s, d: G.coverage(Tables(s, d).claim_quote(), {"supporting": 3, "opposing": 2, "monitoring": 3}),
    "retrieval_recall_at_k": _recall,
    "embedding_knn": _knn,
    "retrieval_evaluation": _evaluation,
    "presence_rates": _presence,
    "communities": lambda s, d: G.communities(_graph(Tables(s, d)), 2),
    "fulltext_search": _fulltext,
    "graph_scan": _graph_scan,
    "embedding_ann": _ann,
    "modular_communities": lambda s, d: modular_communities(_graph(Tables(s, d))),
    "derived_metrics": _derived,
    "lineage_recursive": _lineage,
    "revision_lineage": _revisions,
    "publication_trace": _trace,
    "uncited_in_bodies": _cited_bodies,
    "one_hop_search": _search,
    "centrality": lambda s, d: G.pagerank(_graph(Tables(s, d)), 3).withColumn("rank", F.round("rank", 9)),
    "one_sided_rate": _one_sided,
    "review_coverage": _review_coverage,
    "session_stop": _session,
    "tier_rules": _tiers,
    "superseded_snapshots": _superseded,
    "dataset_yoy": lambda s, d: G.year_over_year(_monthly(Tables(s, d)), "month", "cents").select(F.col("month").cast("long").alias("month"), "cents", "yoy"),
    "dataset_rolling": lambda s, d: G.rolling(_monthly(Tables(s, d)), "month", "cents", 3).select(F.col("month").cast("long").alias("month"), "rolling_sum", "rolling_n"),
    "dataset_zscore": _zscore,
    "dataset_pivot": _pivot,
    "dataset_cohort": _cohort,
    "dataset_payload_guard": _guard,
    "derived_metric_spec": _spec,
    "near_duplicates": _near,
    "benchmark_mentions": _mentions,
    "uncited_claims": _uncited,
    "extract_pipeline": _extract,
    "extractor_routing": _routing,
}

_N = "(SELECT count(*) FROM documents)"
_GRAPH = f"g AS (SELECT doc_id AS src, (doc_id * 7 + 1) % {_N} AS dst FROM documents)"
_TOKENS = """list_filter(list_transform(regexp_extract_all(lower(coalesce({}, '')), '[\\p{{L}}\\p{{N}}]+(?:\\x27s)?'), lambda w: regexp_replace(regexp_replace(w, '\\x27s$', ''), '([^s]{{3}})s$', '\\1')), lambda w: w NOT IN (""" + ", ".join(f"'{w}'" for w in D.STOP_WORDS) + "))"
_MONTH = "m AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS month, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS cents FROM orders GROUP BY 1)"
_KNN = """q AS (SELECT vec_id AS query_id, list_transform(embedding, lambda x: x::DOUBLE) AS q FROM embeddings WHERE vec_id % 50 = 0), v AS (SELECT vec_id AS other_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    k AS (SELECT query_id, other_id, list_dot_product(q, v) / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(v, v))) AS cosine FROM q JOIN v ON query_id <> other_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, other_id) AS rank FROM k)"""
SQL = {
    "stale_claims": """WITH e AS (SELECT event_id, event_type, value, ts, '/p' || user_id AS url, CASE WHEN value < 20 THEN 'h1' ELSE 'h2' END AS hash FROM events), n AS (SELECT url, max_by(hash, (ts, hash)) AS newest FROM e GROUP BY 1),
        c AS (SELECT event_id AS claim_id, concat_ws(',', CASE WHEN date_sub('microsecond', ts, TIMESTAMP '2024-02-05') // 86400000000 > CASE WHEN event_id % 3 = 0 THEN 10 ELSE 30 END THEN 'age' END, CASE WHEN newest <> hash THEN 'newer_snapshot' END, CASE WHEN event_type = 'error' AND value > 150 THEN 'contradicted' END) AS why FROM e JOIN n USING (url))
        SELECT claim_id, why, why <> '' AS stale FROM c""",
    "auto_confirm_fp": sql("SELECT count(*) AS reviewed, count(*) FILTER (quality = 0) AS wrong, count(*) FILTER (quality = 0) / nullif(count(*), 0) AS false_positive_rate FROM claim_quote JOIN labels USING (doc_id) WHERE n % 4 = 0 AND confidence_pct >= 85"),
    "scenario_validate": """WITH b AS (SELECT l_orderkey, count(*) AS n, bool_and(l_quantity > 2) AS w, bool_and(l_tax > 0.0) AS f, bool_and(l_returnflag <> 'R') AS s FROM lineitem GROUP BY 1),
        x AS (SELECT o_orderkey AS scenario_id, concat_ws(',', CASE WHEN NOT w THEN 'weights' END, CASE WHEN n < 2 THEN 'branches' END, CASE WHEN NOT f THEN 'falsifiers' END, CASE WHEN NOT s THEN 'signals' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'counterclaims' END) AS failed FROM orders JOIN b ON o_orderkey = l_orderkey)
        SELECT scenario_id, failed, failed = '' AS valid FROM x""",
    "cite_check": sql("""WITH k AS (SELECT DISTINCT source_id FROM intervention WHERE status = 'pending_user_review' AND gate_mode = 'inline_block' AND importance >= 1.2),
        j AS (SELECT 'drf_' || (doc_id // 5) AS draft_id, doc_id % 41 = 40 AS unk, doc_id % 53 = 1 AS st, doc_id % 59 = 1 AS re, doc_id % 61 = 1 AS ho, doc_id % 67 = 1 AS un, doc_id % 71 = 1 AS ov, source IN (SELECT source_id FROM k) AS bl FROM documents),
        g AS (SELECT draft_id, concat_ws(',', CASE WHEN bool_or(st AND NOT unk) THEN 'stale' END, CASE WHEN bool_or(re AND NOT unk) THEN 'retracted' END, CASE WHEN bool_or(ho AND NOT unk) THEN 'horizon' END, CASE WHEN bool_or(un AND NOT unk) THEN 'unit' END, CASE WHEN bool_or(ov AND NOT unk) THEN 'overclaim' END, CASE WHEN bool_or(bl AND NOT unk) THEN 'blocked' END, CASE WHEN bool_or(unk) THEN 'unknown_claim' END) AS blocks FROM j GROUP BY 1)
        SELECT draft_id, blocks, blocks = '' AS passes FROM g"""),
    "evidence_pack": sql("SELECT thesis_id, " + ", ".join(f"coalesce(string_agg(claim_id, ',' ORDER BY claim_id) FILTER (role = '{r}'), '') AS {r}" for r in G.SECTIONS) + " FROM claim_quote GROUP BY 1"),
    "coverage_gate": sql("WITH g AS (SELECT thesis_id, count(*) FILTER (role = 'supporting') AS n_supporting, count(*) FILTER (role = 'opposing') AS n_opposing, count(*) FILTER (role = 'monitoring') AS n_monitoring FROM claim_quote GROUP BY 1) SELECT *, n_supporting >= 3 AND n_opposing >= 2 AND n_monitoring >= 3 AS covered FROM g"),
    "retrieval_recall_at_k": f"WITH {_KNN}, g AS (SELECT query_id AS case_id, count(*) FILTER (rank <= 5 AND other_id % 2 = 0) AS hit, count(*) FILTER (other_id % 2 = 0) AS want FROM r WHERE rank <= 10 GROUP BY 1) SELECT case_id, CASE WHEN want = 0 THEN 1.0::DOUBLE ELSE hit / want END AS recall, CASE WHEN want = 0 THEN true ELSE hit / want >= 0.8 END AS passed FROM g",
    "embedding_knn": f"WITH {_KNN} SELECT query_id, other_id, rank, round(cosine, 9) AS cosine FROM r WHERE rank <= 5",
    "lineage_recursive": f"WITH RECURSIVE {_GRAPH}, w(root, node, hops) AS (SELECT doc_id, doc_id, 0 FROM documents UNION ALL SELECT w.root, g.dst, w.hops + 1 FROM w JOIN g ON g.src = w.node WHERE w.hops < 5) SELECT root, node, min(hops)::BIGINT AS hops FROM w GROUP BY 1, 2",
    "derived_metrics": f"""WITH q AS (SELECT l_returnflag, strftime(l_shipdate, '%Y-%m') AS month, sum(CAST(round(l_quantity * 100) AS BIGINT)) AS v FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
        o AS (SELECT o_orderpriority, year(o_orderdate) AS year, count(*) AS v FROM orders GROUP BY 1, 2), c AS (SELECT *, lag(v) OVER (PARTITION BY o_orderpriority ORDER BY year) AS b FROM o)
        SELECT 'met_quantity' AS metric, '{M.spec_sha256(SPECS[0][1])}' AS spec_sha256, '{{"l_returnflag":"' || l_returnflag || '","month":"' || month || '"}}' AS dimensions,
            (sum(v) OVER (PARTITION BY l_returnflag ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))::DOUBLE AS value FROM q
        UNION ALL SELECT 'met_orders', '{M.spec_sha256(SPECS[1][1])}', '{{"o_orderpriority":"' || o_orderpriority || '","year":' || year || '}}', round((v - b)::DOUBLE / b, 9) FROM c""",
    "revision_lineage": "WITH RECURSIVE w(root, node, hops) AS (SELECT doc_id, doc_id, 0 FROM documents UNION ALL SELECT root, node // 3, hops + 1 FROM w WHERE node > 0) SELECT root, node, min(hops)::BIGINT AS hops FROM w GROUP BY 1, 2",
    "publication_trace": sql("""WITH c AS (SELECT q.claim_id, q.thesis_id, q.doc_id, regexp_extract(q.thesis_id, '([0-9]+)', 1)::BIGINT AS n, 'snap_' || substring(sha256(coalesce(text, '')), 1, 16) AS snap FROM claim_quote q)
        SELECT 'pub_' || (n // 2) AS root, 'drf_' || n AS draft, thesis_id AS thesis, 'scn_' || n || '_r1' AS revision, claim_id AS claim, CASE WHEN doc_id % 20 <> 0 THEN snap END AS snapshot, 4 + (doc_id % 20 <> 0)::BIGINT AS hops FROM c"""),
    "uncited_in_bodies": sql("""WITH n AS (SELECT doc_id, k, 'clm_' || (doc_id * k) || CASE WHEN doc_id * k % 5 = 0 THEN '-b' ELSE '' END AS id FROM documents, (VALUES (1), (3), (5), (11)) v(k)),
        w AS (SELECT id FROM n WHERE k IN (3, 5, 11))
        SELECT n.id AS claim_id FROM claim_quote q JOIN n USING (doc_id) WHERE k = 1 AND confidence_pct >= 85 AND n.id NOT IN (SELECT id FROM w)
        AND NOT (n.id NOT LIKE '%-b' AND n.id IN (SELECT regexp_replace(id, '-b$', '') FROM w)) AND n.id NOT IN (SELECT unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9_]+')) FROM documents)"""),
    "one_hop_search": f"""WITH {_GRAPH}, t AS (SELECT doc_id AS id, len(list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}\\p{{M}}_]+'), lambda w: w IN ('the', 'with'))) AS score FROM documents), top AS (SELECT * FROM t WHERE score > 0 ORDER BY score DESC, id LIMIT 20),
        b AS (SELECT src AS id, dst AS other FROM g UNION SELECT dst, src FROM g), n AS (SELECT id, list_sort(list(DISTINCT other))[1:5] AS near FROM b GROUP BY 1) SELECT id, score, coalesce(array_to_string(near, ','), '') AS neighbours FROM top LEFT JOIN n USING (id)""",
    "retrieval_evaluation": f"""WITH {_KNN}, j AS (SELECT r.*, e.label FROM r JOIN embeddings e ON e.vec_id = other_id WHERE rank <= 10),
        g AS (SELECT query_id, count(*) FILTER (rank <= 5 AND other_id % 2 = 0) AS hit, count(*) FILTER (other_id % 2 = 0) AS want, count(DISTINCT label) / count(*) AS diversity FROM j GROUP BY 1), c AS (SELECT *, CASE WHEN want = 0 THEN 1.0::DOUBLE ELSE hit / want END AS recall FROM g)
        SELECT 'eval_' || (query_id // 50 % 2) AS run, count(*) AS total_cases, round(avg((recall >= 0.8)::INT), 9) AS pass_rate, round(avg(recall), 9) AS mean_recall, round(avg(diversity), 9) AS mean_diversity FROM c GROUP BY 1""",
    "presence_rates": sql("""WITH x AS (SELECT thesis_id, (['positive','neutral','neutral','neutral','negative','neutral','neutral'])[(doc_id // 3) % 7 + 1] AS direction FROM claim_quote), g AS (SELECT thesis_id, bool_or(direction = 'positive') AS up, bool_or(direction = 'negative') AS down FROM x GROUP BY 1)
        SELECT count(*) AS publications, count(*) FILTER (up) / count(*) AS upside_claim_presence_rate, count(*) FILTER (down) / count(*) AS downside_claim_presence_rate, count(*) FILTER (up <> down) / count(*) AS one_sided_warning_rate FROM g"""),
    "communities": f"""WITH {_GRAPH}, b AS (SELECT src, dst FROM g UNION SELECT dst, src FROM g), l0 AS (SELECT DISTINCT src AS node, src AS label FROM b),
        s1 AS (SELECT src, label, count(*) AS n FROM b JOIN l0 ON dst = node GROUP BY 1, 2), l1 AS (SELECT src AS node, arg_min(label, (-n, label)) AS label FROM s1 GROUP BY 1),
        s2 AS (SELECT src, label, count(*) AS n FROM b JOIN l1 ON dst = node GROUP BY 1, 2) SELECT src AS node, arg_min(label, (-n, label)) AS label FROM s2 GROUP BY 1""",
    "fulltext_search": sql(f"""WITH {_GRAPH}, nodes AS (SELECT 'document' AS kind, 'document_' || doc_id AS id, source AS name, text FROM documents UNION ALL SELECT 'claim', 'claim_' || doc_id, NULL, quote FROM claim_quote
            UNION ALL SELECT 'source', 'source_' || source_id, source_id, replace(archive_policy, '_', ' ') || ' ' || replace(llm_policy, '_', ' ') FROM source_policy UNION ALL SELECT 'chunk', 'chunk_' || conv_id || '_' || turn, role, text FROM conversations
            UNION ALL SELECT 'thesis', 'thesis_' || item_id, NULL, text FROM benchmark UNION ALL SELECT 'scenario', 'scenario_' || page_id, NULL, regexp_replace(url, '[^A-Za-z0-9]', ' ', 'g') FROM pages),
        t AS (SELECT kind, id, list_concat({_TOKENS.format("name")}, {_TOKENS.format("text")}) AS terms FROM nodes), z AS (SELECT kind, count(*) AS n, avg(len(terms)) AS mean FROM t GROUP BY 1), q AS (SELECT DISTINCT unnest({_TOKENS.format("'" + QUERY.replace("'", "''") + "'")}) AS term),
        p AS (SELECT kind, id, term, count(*) AS f, any_value(size) AS size FROM (SELECT kind, id, len(terms) AS size, unnest(terms) AS term FROM t) JOIN q USING (term) GROUP BY 1, 2, 3), df AS (SELECT kind, term, count(*) AS df FROM p GROUP BY 1, 2),
        s AS (SELECT kind, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * size / mean))), 6) AS score FROM p JOIN df USING (kind, term) JOIN z USING (kind) GROUP BY 1, 2),
        h AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY score DESC, id) AS place FROM s QUALIFY place <= 20),
        e AS (SELECT 'claim_' || src AS a, 'claim_' || dst AS b FROM g WHERE src % 4 <> 3), near AS (SELECT id, list_sort(list(DISTINCT other))[1:5] AS near FROM (SELECT a AS id, b AS other FROM e UNION SELECT b, a FROM e) GROUP BY 1)
        SELECT kind, id, score, place, coalesce(array_to_string(near, ','), '') AS neighbours FROM h LEFT JOIN near USING (id)"""),
    "graph_scan": sql("""WITH v AS (SELECT 'Document:' || doc_id AS id, 'Document' AS kind FROM documents UNION SELECT 'Source:' || source_id, 'Source' FROM source_policy UNION SELECT 'Snapshot:' || snap_id, 'Snapshot' FROM snapshot),
        e AS (SELECT 'Document:' || doc_id AS id, 'Source:' || source_id AS dst, 'FROM' AS kind FROM doc_source_edge UNION SELECT 'Snapshot:' || snap_id, 'Document:' || doc_id, 'SNAPSHOT_OF' FROM doc_source_edge)
        SELECT id, NULL::VARCHAR AS dst, kind FROM v UNION ALL SELECT * FROM e WHERE id IN (SELECT id FROM v) AND dst IN (SELECT id FROM v)"""),
    "near_duplicates": r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ 	-
]+'), lambda x: x <> '') AS w FROM documents),
        g AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS g FROM w WHERE len(w) > 0),
        s AS MATERIALIZED (SELECT g, min(doc_id) AS id FROM g GROUP BY g), u AS MATERIALIZED (SELECT id, len(g) AS n, unnest(g) AS x FROM s),
        p AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM u a JOIN u b ON a.x = b.x AND a.id <> b.id GROUP BY 1, 2 HAVING count(*) / (any_value(a.n) + any_value(b.n) - count(*)) >= 0.8),
        reach(v, r) AS (SELECT id, id FROM s UNION SELECT reach.v, p.b FROM reach JOIN p ON reach.r = p.a), c AS (SELECT v, min(r) AS class_id FROM reach GROUP BY v)
        SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id LEFT JOIN s ON s.g = g.g LEFT JOIN c ON c.v = s.id""",
    "one_sided_rate": sql("""WITH x AS (SELECT thesis_id, (['positive','negative','neutral','positive','positive'])[(doc_id // 3) % 5 + 1] AS direction FROM claim_quote), g AS (SELECT thesis_id, count(*) FILTER (direction = 'positive') AS up, count(*) FILTER (direction = 'negative') AS down, count(*) AS n FROM x GROUP BY 1)
        SELECT thesis_id, greatest(up, down) / n AS share, least(up, down) = 0 AND greatest(up, down) > 0 AS one_sided, CASE WHEN up >= down THEN 'negative' ELSE 'positive' END AS wanted_direction FROM g"""),
    "review_coverage": sql("WITH r AS (SELECT run_id, run_id % 20 <> 3 AND run_id % 30 <> 4 AS ok FROM run_ledger WHERE tier = 0) SELECT count(*) AS runs, count(*) FILTER (ok) AS reviewed, count(*) FILTER (ok) / nullif(count(*), 0) AS coverage, coalesce(count(*) FILTER (ok) / nullif(count(*), 0) >= 0.95, false) AS met FROM r"),
    "session_stop": """WITH c AS (SELECT conv_id AS session, turn AS round, length(text) % 3 AS answer, length(text) % 100 / 100 AS confidence FROM conversations), w AS (SELECT *, lag(answer, 1) OVER p AS a1, lag(answer, 2) OVER p AS a2 FROM c WINDOW p AS (PARTITION BY session ORDER BY round)),
        y AS (SELECT *, CASE WHEN confidence >= 0.97 THEN 'confident' WHEN answer = a1 AND answer = a2 THEN 'unchanged' WHEN round >= 4 THEN 'rounds' END AS why FROM w), z AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY round) AS k FROM y WHERE why IS NOT NULL) SELECT session, round, why FROM z WHERE k = 1""",
    "tier_rules": "SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'D' WHEN (doc_id % 3 <> 0)::INT + (doc_id % 5 <> 0)::INT + (doc_id % 2 <> 0)::INT = 3 THEN 'A' WHEN (doc_id % 3 <> 0)::INT + (doc_id % 5 <> 0)::INT + (doc_id % 2 <> 0)::INT = 2 THEN 'B' ELSE 'C' END AS tier FROM documents",
    "superseded_snapshots": "WITH r AS (SELECT event_type, 'snap_' || event_id AS snap_id, '/p' || user_id AS url, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, 'snap_' || event_id DESC) AS r FROM events) SELECT snap_id, url FROM r WHERE r > 1 AND event_type <> 'purchase'",
    "dataset_yoy": f"WITH {_MONTH} SELECT month::BIGINT AS month, cents, (cents - lag(cents, 12) OVER (ORDER BY month)) / lag(cents, 12) OVER (ORDER BY month) AS yoy FROM m",
    "dataset_rolling": f"WITH {_MONTH} SELECT month::BIGINT AS month, sum(cents) OVER w::BIGINT AS rolling_sum, count(cents) OVER w AS rolling_n FROM m WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
    "dataset_zscore": "WITH g AS (SELECT l_returnflag AS f, avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM lineitem GROUP BY 1) SELECT l_orderkey, l_linenumber::BIGINT AS line, round((l_quantity - m) / s, 6) AS z, abs((l_quantity - m) / s) >= 1.7 AS anomaly FROM lineitem JOIN g ON f = l_returnflag",
    "dataset_pivot": "SELECT year(o_orderdate)::BIGINT AS year, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'P') AS n_p FROM orders GROUP BY 1",
    "dataset_cohort": "WITH f AS (SELECT o_custkey AS c, min(year(o_orderdate)) AS cohort FROM orders GROUP BY 1) SELECT cohort::BIGINT AS cohort, (year(o_orderdate) - cohort)::BIGINT AS age, count(DISTINCT o_custkey) AS entities FROM orders JOIN f ON c = o_custkey GROUP BY 1, 2",
    "dataset_payload_guard": "SELECT count(*) AS rows, sum(strlen(text))::BIGINT AS bytes, count(*) >= 1000 OR sum(strlen(text)) >= 50000 AS must_reduce FROM conversations",
    "derived_metric_spec": f"WITH {_MONTH} SELECT 'v1|spec1|lock1|met_' || CASE WHEN month % 40 = 0 THEN 1 ELSE month END AS key, count(*) AS n FROM m GROUP BY 1 HAVING count(*) > 1",
    "benchmark_mentions": "SELECT doc_id, item_id FROM documents d JOIN benchmark b ON b.text <> '' AND contains(d.text, b.text)",
    "uncited_claims": sql("SELECT claim_id FROM claim_quote WHERE confidence_pct >= 85 AND claim_id NOT IN (SELECT 'clm_' || doc_id * 3 FROM documents UNION SELECT 'clm_' || doc_id * 5 FROM documents)"),
    "extractor_routing": "WITH t AS (SELECT doc_id AS id, (['article','dataset','report'])[doc_id % 3 + 1] AS source_type, regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g') AS x FROM documents) SELECT id, source_type, CASE source_type WHEN 'article' THEN upper(substring(x, 1, 5)) WHEN 'dataset' THEN length(x)::VARCHAR END AS result, CASE WHEN source_type = 'report' THEN 'unknown_source_type' END AS error FROM t",
    "centrality": f"""WITH {_GRAPH}, nodes AS (SELECT src AS node FROM g UNION SELECT dst FROM g), deg AS (SELECT src, count(*) AS k FROM g GROUP BY 1), r0 AS (SELECT node, 1.0::DOUBLE AS rank FROM nodes),
        r1 AS (SELECT n.node, 0.15 + 0.85 * coalesce(sum(r0.rank / k), 0.0::DOUBLE) AS rank FROM nodes n LEFT JOIN (g JOIN deg USING (src) JOIN r0 ON r0.node = g.src) ON g.dst = n.node GROUP BY 1),
        r2 AS (SELECT n.node, 0.15 + 0.85 * coalesce(sum(r1.rank / k), 0.0::DOUBLE) AS rank FROM nodes n LEFT JOIN (g JOIN deg USING (src) JOIN r1 ON r1.node = g.src) ON g.dst = n.node GROUP BY 1)
        SELECT n.node, round(0.15 + 0.85 * coalesce(sum(r2.rank / k), 0.0::DOUBLE), 9) AS rank FROM nodes n LEFT JOIN (g JOIN deg USING (src) JOIN r2 ON r2.node = g.src) ON g.dst = n.node GROUP BY 1""",
}
