"""Literal cases of ledger, policy, audit, crawl, registry and design operators, and the streaming twin."""

from __future__ import annotations

import datetime as dt
import html
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewright.operators import audit, crawl, design, documents, extraction, ledger, policy, registry


def test_costs(spark):
    at = dt.datetime(2024, 1, 10, 5)
    runs = spark.createDataFrame([(at, "a", 100), (at, "a", None), (at + dt.timedelta(days=1), "a", 7)], "completed_at timestamp_ntz, vendor string, cost_e4 long")
    assert ledger.daily_total(runs, "2024-01-10").first()[0] == 0.01
    assert ledger.daily_total(runs, "2020-01-01").first()[0] == 0
    with pytest.raises(ValueError):
        ledger.daily_total(runs, "2024-02-30")


def test_longest_alias_wins(spark):
    prices = ledger.price_table(spark, {"m": {"input": 1, "output": 1}, "m-mini": {"input": 2, "output": 2, "cached": 1}})
    runs = spark.createDataFrame([("m-mini-2025", 10, 20, 1), ("m", 10, 5, 1), ("mx", 1, 1, 1)], "model string, input_tokens int, cached_tokens int, output_tokens int")
    got = {r["model"]: (r["alias"], r["c"]) for r in ledger.priced(runs, prices).withColumn("c", ledger.cost_subtracting_cached()).collect()}
    assert got["m-mini-2025"] == ("m-mini", pytest.approx(22e-6)) and got["m"] == ("m", pytest.approx(11e-6)) and got["mx"] == (None, None)


@pytest.mark.parametrize(("mode", "score", "linked", "want"), [("inline_block", 0.1, False, "HIGH"), ("inline_block", 0.7, True, "CRITICAL"), ("inline_warn", 0.4, False, "MEDIUM"), ("batch_report", float("nan"), True, "MEDIUM"), ("batch_report", None, False, "LOW"), ("inline_warn", 5.0, False, "HIGH")])
def test_severity(spark, mode, score, linked, want):
    row = spark.createDataFrame([(mode, score, linked)], "m string, s double, l boolean")
    assert row.select(policy.severity(F.col("m"), F.col("s"), F.col("l"))).first()[0] == want


@pytest.mark.parametrize(("name", "wire"), [("AP", True), ("Aperture", False), ("Reuters Institute", False), ("Reuters wire", True), ("yonhap", True), (None, False)])
def test_wire_service(spark, name, wire):
    assert spark.createDataFrame([(name,)], "n string").select(policy.is_wire_service(F.col("n"))).first()[0] is wire


def test_risks_win_over_incompatibility(spark):
    rows = spark.createDataFrame([("discovery", "embed", "s", "excerpt_only", "always_prohibited", "allowed", "N"), ("discovery", "embed", "s", "full_snapshot_allowed", "always_prohibited", "allowed", "N"), ("discovery", "discovery_fetch", "s", "unknown", "always_prohibited", "allowed", "N"), ("discovery", "discovery_fetch", "s", "excerpt_only", "always_prohibited", "allowed", "N")], "stage string, action string, source_id string, archive string, cloud string, llm string, source_name string")
    got = [(r["error"], r["triggers"], r["decision"]) for r in policy.gate(rows).collect()]
    assert got == [(None, "raw_embedding", "block"), ("incompatible_stage_action", "", None), ("registered_unknown_archive", "", None), (None, "", "warn")]


def test_scan_of_aligned_stores_is_empty(spark):
    keyed = spark.createDataFrame([("snap_1", "permitted_artifact/snapshot/snap_1")], "snap_id string, object_key string")
    audits = spark.createDataFrame([("d1", "uploaded", "snap_1", "snap_id=snap_1; x", "a1")], "decision_id string, decision string, snap_id string, rationale string, attempt_id string")
    edges = spark.createDataFrame([("s1", "snap_1")], "source_id string, snap_id string")
    policies = spark.createDataFrame([("s1", "full_snapshot_allowed", "allowed_public_data_only")], "source_id string, archive_policy string, cloud_policy string")
    found = audit.scan(keyed, audits, edges, policies)
    assert found.count() == 0 and audit.counts(keyed, audits, policies, found).first()["aligned"]


def test_rationale_ids(spark):
    rows = spark.createDataFrame([("snap_id=snap_a; b",), ("snap_id=snap_a b",), (None,), ("x snap_id=snap_a",)], "r string")
    assert [r[0] for r in rows.select(audit.snap_id_of_rationale(F.col("r"))).collect()] == ["snap_a", None, None, None]


def _log(spark, outcomes):
    base = dt.datetime(2024, 1, 1)
    rows = [("s", base + dt.timedelta(hours=i), i, o, "e" if o == "ok" else None) for i, o in enumerate(outcomes)]
    return spark.createDataFrame(rows, "source_id string, ts timestamp, event_id long, outcome string, etag string")


def test_backoff(spark):
    got = crawl.failure_state(_log(spark, ["ok", *["error"] * 5, "not_modified", "timeout"])).orderBy("event_id").collect()
    assert [r["failures"] for r in got] == [0, 1, 2, 3, 4, 5, 0, 1]
    assert [r["next_eligible_at"] is not None for r in got] == [False] * 5 + [True, False, False]
    assert all(r["last_etag"] == "e" for r in got)


def test_streaming_twin(spark, tmp_path):
    log = _log(spark, ["ok", *["error"] * 5, "ok", "error"])
    log.repartition(1).write.parquet(str(tmp_path / "in"))
    from tidewright.streaming.crawl import failure_stream

    stream = failure_stream(spark.readStream.schema(log.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("twin").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    want = {(r["event_id"], r["failures"], r["last_etag"]) for r in crawl.failure_state(log).collect()}
    assert {(r["event_id"], r["failures"], r["last_etag"]) for r in spark.table("twin").collect()} == want


def test_registry(spark, tmp_path):
    row = {"slug": "a", "name": "A", "publisher": "P", "url": "https://a/", "rss_url": "https://a/rss", "access_method": "rss", "reliability_tier": 0, "archive_policy": "excerpt_only", "raw_cloud_policy": "always_prohibited", "external_llm_policy": "allowed", "subtopic_tags": ["x"]}
    import yaml

    path = tmp_path / "r.yaml"
    path.write_text(yaml.safe_dump({"sources": [row]}))
    loaded = registry.load(spark, path)
    ids = spark.createDataFrame([("a", "src_1")], "slug string, source_id string")
    assert registry.pollable(loaded, ids).collect()[0]["feed_url"] == "https://a/rss"
    with pytest.raises(Exception, match="no source id"):
        registry.pollable(loaded, ids.filter("slug = 'b'")).collect()
    for bad in ({**row, "url": "ftp://a"}, {**row, "slug": " "}, {**row, "access_method": "fax"}):
        path.write_text(yaml.safe_dump([bad]))
        with pytest.raises(registry.RegistryError):
            registry.load(spark, path)
    assert registry.problems([row, row]) and not registry.problems([row])


def test_extractors(spark):
    r = extraction.Registry()
    r.register("a", lambda df: df.withColumn("result", F.lit("x")))
    with pytest.raises(ValueError):
        r.register("a", lambda df: df)
    with pytest.raises(KeyError):
        r.get("b")
    bad = extraction.Registry()
    bad.register("a", lambda df: df.withColumn("result", F.lit("x")).withColumn("id", F.lit(None).cast("long")))
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, source_type string")
    assert sorted((x["id"], x["error"]) for x in r.route(rows).collect()) == [(1, None), (2, "unknown_source_type"), (3, "unknown_source_type")]
    with pytest.raises(Exception, match="changed a key"):
        bad.route(rows).collect()


def test_lineage_and_recall(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long")
    roots = spark.createDataFrame([(1,)], "node long")
    assert sorted((r["node"], r["hops"]) for r in documents.lineage(edges, roots, 5).collect()) == [(1, 0), (2, 1), (3, 2)]
    cases = spark.createDataFrame([(1, [1, 2, 3], [2, 9]), (2, [1], [])], "case_id long, retrieved array<long>, expected array<long>")
    assert sorted((r["case_id"], r["recall"]) for r in design.recall_at_k(cases, 2).collect()) == [(1, 0.5), (2, 1.0)]


def test_near_duplicates_by_brute_force(spark):
    rng = random.Random(2)
    texts = ["", " ", None, "one two", "One  two", "one two three four", "a b c d e", "A b c d e"]
    for n in (5, 12, 40, 90):
        base = [f"w{rng.randint(0, 60)}" for _ in range(n)]
        for changes in (0, 0, *range(1, 7)):
            w = [*base, "end"] if changes % 2 else list(base)
            for _ in range(changes):
                w[rng.choice((0, 1, len(w) // 2, -2, -1))] = f"x{rng.randint(0, 5)}"
            texts.append(" ".join(w))
    grams = {}
    for i, text in enumerate(texts):
        w = (text or "").lower().split()
        if w:
            grams[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4)))
    low = {i: i for i in range(len(texts))}

    def top(i):
        while low[i] != i:
            i = low[i]
        return i

    linked = 0
    for a in grams:
        for b in grams:
            if a < b and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]):
                linked += grams[a] != grams[b]
                low[max(top(a), top(b))] = min(top(a), top(b))
    want = sorted([(i, top(i)) for i in range(len(texts))] + [(None, top(8)), (5, 5), (None, None)], key=repr)
    # A null id whose text is a copy, a row that repeats an id, a null id alone.
    rows = [*enumerate(texts), (None, texts[8]), (5, None), (None, "nothing like any other text here")]
    docs = spark.createDataFrame([(i, t, 7, 8) for i, t in rows], "doc_id long, text string, k int, id int").repartition(3)
    got = sorted(map(tuple, documents.near_duplicates(docs).collect()), key=repr)
    assert got == want and linked > 20 and (4, 3) in got and (7, 6) in got
    assert documents.near_duplicates(docs.filter("false")).count() == 0


def test_near_duplicates_read_again_only_close_pairs(spark, monkeypatch):
    """Sets that share a gram by chance are not read again, and no pair is compared twice."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**9)}"
    passages = [[word() for _ in range(60)] for _ in range(45)]
    texts = [passages[i] + passages[15 + i // 2] + passages[30 + (i * 7) % 15] for i in range(15)]
    texts += [passages[(i * 4) % 15] + passages[23 + i // 2] + passages[30 + i] for i in range(15)]
    texts.append([*texts[7][:-2], word(), word()])  # a link
    far = [*texts[8][:-30], *(word() for _ in range(30))]  # no link, and not far from one
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate([*texts, far])], "doc_id long, text string").repartition(3)
    saved, save = [], documents.Scratch.save

    def seen(self, df, name):
        out = save(self, df, name)
        if name.endswith(("-sets", "-close", "-links")):
            saved.append((name, out.count()))
        return out

    monkeypatch.setattr(documents.Scratch, "save", seen)
    got = dict(map(tuple, documents.near_duplicates(docs).collect()))
    assert got == {**{i: i for i in range(32)}, 30: 7}
    counts = dict(saved)
    assert counts["anchors-sets"] + counts["across-sets"] <= 4 and counts["anchors-links"] + counts["across-links"] == 1
    assert counts["anchors-close"] + counts["across-close"] <= 2


def test_counts_by_range_never_part_a_link():
    """Random sets around the threshold, of sizes whose counts have different numbers of ranges, and counts beyond a byte."""
    rng = np.random.default_rng(3)
    part, linked, kept = documents._range_counts, 0, 0
    for _ in range(3000):
        n = int(rng.integers(1, 600))
        a = np.unique(rng.integers(0, 2**64, n, np.uint64))
        own = np.unique(np.concatenate([a[: len(a) - int(rng.integers(0, len(a) // 3 + 1))], rng.integers(0, 2**64, int(rng.integers(0, len(a) // 3 + 1)), np.uint64)]))
        if not len(own):
            continue
        both = len(np.intersect1d(a, own))
        link = both / (len(a) + len(own) - both) >= 0.8
        may = documents._may_link(len(a), len(own), part(a), part(own), 0.8)
        linked, kept = linked + link, kept + may
        assert may or not link
    assert linked > 500 and kept < 2700
    far = np.unique(rng.integers(0, 2**64, 500, np.uint64))
    other = np.unique(rng.integers(0, 2**64, 500, np.uint64))
    assert not documents._may_link(500, 500, part(far), part(other), 0.8)
    dense = np.arange(1000, dtype=np.uint64)  # all in one range
    assert documents._may_link(1000, 1200, part(dense), part(np.arange(1200, dtype=np.uint64)), 0.8)


def test_surrogate_ids(spark, small):
    """Against the hash of the id's eight bytes."""
    import xxhash

    from tidewright.plans.catalogue import queries

    events = {r["event_id"]: r["ts"] for r in spark.read.parquet(f"{small}/events.parquet").select("event_id", "ts").collect()}
    got = {r["event_id"]: r["decision_id"] for r in queries()["surrogate_id"](spark, small).collect()}
    millis = lambda t: (t - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)
    assert got == {i: f"pdec_{millis(t):012x}{xxhash.xxh64(i.to_bytes(8, 'little'), seed=42).intdigest():016x}" for i, t in events.items()}


TAG = re.compile(r"""</?[a-zA-Z](?:[^"'>]|"[^"]*"|'[^']*')*>""")
ENTITY = re.compile("&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|(?:amp|lt|gt|quot|apos|nbsp|AMP|LT|GT|QUOT);|(?i:lt|gt|quot|amp)(?!;))")


def without(text, start, end, keep=False):
    """Text without what lies between two marks; what is not closed goes to the end."""
    out, at = [], 0
    while (i := text.upper().find(start, at)) >= 0:
        j = text.find(end, i + len(start))
        out.append(text[at:i] + (" " + text[i + len(start) : j] + " " if keep and j >= 0 else ""))
        at = len(text) if j < 0 else j + len(end)
    return "".join(out) + text[at:]


def markup_gone(t):
    t = without(without(t, "<!--", "-->"), "<![CDATA[", "]]>", keep=True)
    t = without(re.sub("<![^>]*>", "", t), "<?", "?>")
    for tag in ("script", "style", "noscript", "iframe", "object", "embed"):
        while m := re.search(rf"(?i)<{tag}\b[^>]*>", t):
            ends = [e.end() for e in re.finditer(rf"(?i)</{tag}\s*>", t) if e.start() >= m.end()]
            t = t[: m.start()] + (t[ends[-1] :] if ends else t[m.end() :] if m[0].endswith("/>") else "")
    out, at = [], 0
    for m in re.finditer("</?[a-zA-Z]", t):
        if m.start() >= at:
            whole = TAG.match(t, m.start())
            out += [t[at : m.start()], " "]
            at = whole.end() if whole else (t.find(">", m.start()) + 1 or len(t))
    return "".join(out) + t[at:]


def plain_text(page):
    """HTML to text, with loops."""
    text, before = markup_gone(page or ""), None
    while text != before:
        before, text = text, ENTITY.sub(lambda m: html.unescape(m[0] if m[0][1] == "#" else m[0].lower()), text)
    return re.sub(r"[\s﻿]+", " ", markup_gone(text)).strip()


def test_html_to_text_of_all_pages(spark, small):
    from tidewright.plans.catalogue import queries

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "html").collect()}
    got = {r["page_id"]: r["text"] for r in queries()["html_to_text_full"](spark, small).collect()}
    assert got == {i: plain_text(t) for i, t in pages.items()}


def test_article_pipeline(spark, small):
    """Every page ends in one ledger state, and a cost or a reply that is missing is an error."""
    from tidewright.plans.catalogue import queries
    from tidewright.sources.tables import Tables

    policies = {r["source_id"]: r["llm_policy"] for r in Tables(spark, small).source_policy().collect()}
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "html").collect()}
    got = {r["id"]: r for r in queries()["extract_pipeline"](spark, small).collect()}
    assert set(got) == set(pages)
    for i, page in pages.items():
        r, known = got[i], policies.get(f"src{i % 20}")
        prompt = f"<untrusted>\n{plain_text(page)[:16000]}\n</untrusted>"
        cost = None if known != "allowed" or i % 13 == 12 else len(prompt) / 1e6
        error = "error_not_registered" if known is None else f"error_{known}" if known != "allowed" else "cost_missing" if cost is None else "schema" if i % 17 == 5 else None
        want = ("not_started" if known != "allowed" else "failed" if error else "completed", error, cost, None if error else prompt[12:72], None if error else 1)
        assert (r["run_status"], r["error"], r["cost_usd"], r["title"], r["n_claims"]) == want, i


@pytest.mark.parametrize("size", [3, 20, 1000])
def test_robots_cache(spark, small, size):
    events = spark.read.parquet(f"{small}/events.parquet")
    requests = events.select((F.col("user_id") % 4).alias("worker"), F.col("event_id").alias("seq"), F.col("ts").alias("at"), F.concat(F.lit("h"), F.col("user_id") % 30).alias("key"), (F.col("event_type") == "error").alias("failed"))
    got = {r["seq"]: r["hit"] for r in crawl.robots_cache(requests, size=size).collect()}
    want, caches = {}, {}
    for r in requests.orderBy("seq").collect():
        cache = caches.setdefault(r["worker"], {})
        want[r["seq"]] = r["key"] in cache and cache[r["key"]] > r["at"]
        if not want[r["seq"]]:
            if len(cache) >= size:
                del cache[next(iter(cache))]
            cache[r["key"]] = r["at"] + (dt.timedelta(minutes=5) if r["failed"] else dt.timedelta(hours=24))
    assert got == want and any(got.values()) and crawl.robots_cache(requests.filter("false")).count() == 0


def test_fetch_verdicts(spark):
    r = lambda url, **kw: (url, *(kw.get(c, d) for c, d in (("status", 200), ("location", None), ("content_length", None), ("encoded", False), ("bytes", 10), ("declared", "html"), ("kind", "html"), ("private_address", False), ("disallowed", False))))
    responses = spark.createDataFrame(
        [
            r("https://a.example/x/ok"), r("https://a.example/x/up", status=302, location="ok"), r("https://a.example/one", status=301, location="//b.example/two"), r("https://b.example/two", status=308, location="/three"), r("https://b.example/three", status=303, location="https://a.example/four"),
            r("https://a.example/four"), r("https://a.example/zero", status=301, location="/one"), r("https://a.example/down", status=301, location="http://a.example/x"), r("https://a.example/none", status=301), r("https://a.example/big", bytes=101), r("https://a.example/said", content_length=101),
            r("https://a.example/304", status=304, content_length=101, bytes=0), r("https://a.example/bomb", content_length=1, encoded=True, bytes=101), r("https://a.example/exe", kind="executable"), r("https://a.example/mix", declared="json"), r("https://in.example/", private_address=True), r("https://a.example/in", status=302, location="https://in.example/"), r("https://a.example/no", disallowed=True), r("https://a.example/300", status=300),
        ],
        "url string, status int, location string, content_length long, encoded boolean, bytes long, declared string, kind string, private_address boolean, disallowed boolean",
    )
    names = {"x/ok": "ok", "x/up": "ok", "one": "ok", "zero": "too_many_redirects", "down": "scheme_downgrade", "none": "no_location", "big": "body_too_large", "said": "body_too_large", "304": "ok", "bomb": "body_too_large", "exe": "executable", "mix": "content_type_mismatch", "in": "private_address", "no": "robots", "300": "ok", "gone": "no_response"}
    requests = spark.createDataFrame([(k, f"https://a.example/{k}") for k in names] + [("plain", "http://a.example/"), ("bad", "nonsense"), ("null", None)], "id string, url string")
    got = {x["id"]: x for x in crawl.fetched(requests, responses, 100).collect()}
    assert {k: v["verdict"] for k, v in got.items()} == names | {"plain": "blocked_scheme", "bad": "invalid_url", "null": "invalid_url"}
    assert (got["one"]["final_url"], got["one"]["hops"], got["zero"]["hops"]) == ("https://a.example/four", 3, 3)
    bomb = {x["id"]: x["verdict"] for x in crawl.fetched(requests, responses, 1000).collect()}
    assert bomb["bomb"] == "decompression_ratio" and bomb["big"] == "ok"
    assert {x["verdict"] for x in crawl.fetched(requests.filter("id = 'one'"), responses, 100, hosts=("a.example",)).collect()} == {"host_not_allowed"}


def test_mentions_are_whole_needles(spark):
    docs = spark.createDataFrame([(1, "so " + "x" * 60 + "y end"), (2, "so " + "x" * 60), (3, None), (4, "aab ab")], "doc_id long, text string")
    needles = spark.createDataFrame([(1, "x" * 40 + "y", "q"), (2, "ab", "r"), (3, "", "s"), (4, None, "t"), (5, "ab", None)], "item_id int, needle string, tag string")
    got = sorted((r["doc_id"], r["item_id"], r["tag"]) for r in documents.mentions(docs, needles, "needle").collect())
    assert got == [(1, 1, "q"), (4, 2, "r"), (4, 5, None)]
    assert documents.mentions(docs, needles.filter("false"), "needle").count() == 0


def test_nearest_neighbours_in_blocks(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(4)]) for i in range(200)] + [(300, None), (301, [0.0] * 4), (302, [1.0, 2.0]), (303, [2.0, 4.0]), (304, [1.0, None, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    queries = vectors.filter("vec_id % 7 = 0 or vec_id > 299")
    good = {i: v for i, v in rows if v and None not in v and any(v)}
    cosine = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)) / (sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5)
    want = set()
    for q in (i for i in good if i % 7 == 0 or i > 299):
        near = sorted((-cosine(good[q], v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:6]
        want |= {(q, i, k) for k, (_, i) in enumerate(near, 1)}
    for block in (4096, 5):
        monkeypatch.setattr(design, "QUERY_BLOCK", block)
        assert {(r["query_id"], r["other_id"], r["rank"]) for r in design.knn(vectors, queries, 6).collect()} == want


def test_nearest_neighbours_hold_the_best_only():
    """A batch in which all vectors tie costs ``k`` rows a query, and no matrix of all pairs."""
    import tracemalloc

    ids, x = np.arange(30_000), np.tile([1.0, 2.0], (30_000, 1))
    x[29_990:] *= -1
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(list(x), pa.list_(pa.float64()))], ["id", "v"])
    tracemalloc.start()
    held = None
    for i in range(0, len(ids), design.VECTOR_RUN):
        part = batch.slice(i, design.VECTOR_RUN)
        ((own, v),) = design._by_length(part.column(0).to_numpy(), part.column(1)).values()
        held = design._nearest(ids[:600], x[:600], own, v, 3, held)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held[0].tolist() == np.repeat(np.arange(600), 3).tolist() and held[1][:6].tolist() == [1, 2, 3, 0, 2, 3] and held[1][-3:].tolist() == [0, 1, 2]
    assert peak < 120e6


def test_policies_of_any_number(spark):
    """Side tables have no limit; whether one is sent to all tasks is the planner's choice, by its size."""
    policies = spark.range(200_001).select(F.concat(F.lit("s"), "id").alias("source_id"), F.when(F.col("id") % 2 == 0, "allowed").otherwise("denied").alias("llm_policy"))
    rows = spark.createDataFrame([("s200000",), ("s1",), ("none",), (None,)], "source_id string")
    got = {r.source_id: (r.llm_policy, r.error) for r in policy.lookup(rows, policies, "llm_policy").collect()}
    assert got == {"s200000": ("allowed", None), "s1": ("denied", None), "none": (None, "source_not_registered"), None: (None, "source_not_registered")}


def test_mentions_of_any_number_of_needles(spark):
    """200,001 needles of all lengths, some that hold others, against plain containment."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 12)))
    texts = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(60)] + [(7, None), (None, "abc"), (8, ""), (9, "needle 123456 é")]
    wanted = [(k, word()) for k in range(150)] + [(150, None), (151, ""), (152, "é"), (153, "needle 123456 é"), (154, "needle 123456 é"), (155, "needle 123456 è")]
    filler = spark.range(200_001).select((F.col("id") + 1000).alias("n"), F.concat(F.lit("needle "), F.col("id"), F.lit(" none such")).alias("s"))
    needles = spark.createDataFrame(wanted, "n long, s string").unionByName(filler)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n) for r in documents.mentions(docs, needles, "s").collect()), key=repr)
    assert got == sorted(((i, n) for i, t in texts for n, s in wanted if t and s and s in t), key=repr)
    assert documents.mentions(docs, needles.limit(0), "s").count() == 0


def test_lineage_of_any_depth(spark):
    """A chain of 300, a cycle, a diamond and a null: every node at its nearest, and an end."""
    pairs = [(k, k + 1) for k in range(300)] + [(1000, 1001), (1001, 1002), (1002, 1000), (2000, 2001), (2000, 2002), (2001, 2003), (2002, 2003), (2003, 2004), (2000, 2004), (None, 1), (5, None)]
    edges = spark.createDataFrame(pairs, "src long, dst long")
    after = {}
    for a, b in pairs:
        if a is not None and b is not None:
            after.setdefault(a, []).append(b)
    want = set()
    for root in (0, 250, 1000, 2000, 9999):
        near, at = {root: 0}, [root]
        while at:
            at = [b for a in at for b in after.get(a, []) if b not in near and not near.update({b: near[a] + 1})]
        want |= {(root, n, h) for n, h in near.items()}
    roots = spark.createDataFrame([(r,) for r in (0, 250, 1000, 2000, 9999)], "node long")
    assert {tuple(r) for r in documents.lineage(edges, roots).collect()} == want


def test_citations(spark):
    ids = spark.createDataFrame([(x,) for x in ("a1", "a2", "a-3", "a.4", "a5", "a-6", "b7", None)], "claim_id string")
    works = spark.createDataFrame([(["a1"], "see a2, xa5 and a5_"), ([], "(a-3) a-66 axx4 a?6"), (None, None), ([], "a.4"), ([], "xa-6"), (["zz"], "")], "listed array<string>, body string")
    assert sorted(r.claim_id for r in documents.cited(ids, works).collect()) == ["a-3", "a.4", "a1", "a2"]


def test_metric_specifications(spark):
    from tidewright.operators import metric_specs as M

    table = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("a", 3, 0), ("b", 1, None), ("b", 2, 4), (None, 1, 1)], "g string, t int, v long")
    spec = {"id": "m", "group": ["g", "t"], "value": "v * 2", "function": "sum", "order": "t", "window": 2}
    got = {(r.g, r.t): r.value for r in M.compiled(table, spec).collect()}
    assert got == {("a", 1): 10.0, ("a", 2): 24.0, ("a", 3): 14.0, ("b", 1): None, ("b", 2): 8.0, (None, 1): 2.0}
    assert {r.value for r in M.compiled(table, {"id": "n", "group": [], "value": "v", "function": "count", "filter": "v > 0"}).collect()} == {4.0}
    change = {k: v for k, v in spec.items() if k != "window"} | {"change": 1}
    assert {(r.g, r.t): r.value for r in M.compiled(table, change).filter("g = 'a'").collect()} == {("a", 1): None, ("a", 2): 0.4, ("a", 3): -1.0}
    import json

    assert M.spec_sha256(spec) == M.spec_sha256(json.dumps(dict(reversed(spec.items())), indent=2)) != M.spec_sha256({**spec, "window": 3})
    both = M.derived({"x": table}, [("x", spec), ("x", json.dumps(spec)), ("x", change)], "v1", {"a": "1"})
    assert both.count() == 12 and both.select("spec_sha256").distinct().count() == 2
    assert M.derived({"x": table}, [("x", spec)], "v1", {"a": "2"}).first().lock_sha256 != both.first().lock_sha256
    for bad in ("[", {"id": "x"}, {**spec, "function": "median"}, {**spec, "more": 1}, {**spec, "order": "v"}, {**spec, "window": 0}, {**spec, "change": 1}, {**spec, "group": [1]}, {**spec, "window": True}):
        with pytest.raises(ValueError):
            M.parsed(bad)


def test_scratch_tables_are_closed(spark):
    from tidewright.scratch import Scratch

    scratch = Scratch(spark, "closed")
    df = scratch.save(spark.range(3), "a")
    assert df.count() == 3
    scratch.close()
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch.root)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_ids_in_documents(spark):
    from tidewright.functions.markup import content_lines
    from tidewright.operators import doc_ids

    text = "# REQ-001: a\n| REQ-002 | x |\n```\nQ-100\n~~~\n```\nsee `AC-001`, [DEC-001](https://x/Q-101 \"t\") ``Q-102`` ![Q-103](y)\n\tQ-104\n<!-- Q-105\nQ-106 --> TASK-001\n## Removed Q-005: b\n### Note Q-006 is open\n[Q-107]: http://z\nXREQ-001 REQ-0012345 REQ-001-x REQ-001#y\n- ASM-001: c"
    assert [n for n, _ in content_lines("a\n````\nb\n```\nc\n````\nd\n    e\nf<!--g\nh\ni-->j")] == [1, 7, 9, 10, 11]
    docs = spark.createDataFrame([("docs/a.md", text), ("docs/b.md", "| REQ-001 | y |\n| REQ-002 | y |\nREQ-009"), ("docs/adr/0007-x.md", None), ("docs/adr/ADR-0008-y.md", "# ADR-0009: z"), (None, "Q-005")], "path string, text string")
    found = doc_ids.found_ids(docs)
    roles = {(r.id, r.role) for r in found.collect()}
    assert {i for i, role in roles if role == "canonical"} == {"REQ-001", "Q-005", "ASM-001", "ADR-0007", "ADR-0009"} and {i for i, role in roles if role == "table"} == {"REQ-001", "REQ-002"}
    assert {i for i, role in roles if role == "reference"} == {"REQ-001", "REQ-002", "REQ-009", "AC-001", "DEC-001", "TASK-001", "Q-005", "Q-006", "ASM-001", "ADR-0009"}
    assert {tuple(r) for r in doc_ids.problems(found).collect()} == {("REQ-002", "duplicate_definition", 2), ("REQ-009", "dangling_reference", 1), ("AC-001", "dangling_reference", 1), ("DEC-001", "dangling_reference", 1), ("TASK-001", "dangling_reference", 1), ("Q-006", "dangling_reference", 1)}
