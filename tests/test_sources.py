from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tidewright.operators import design
from tidewright.sources import files, sinks


def test_objects(spark, tmp_path):
    (tmp_path / "audit" / "jsonl").mkdir(parents=True)
    (tmp_path / "audit" / "jsonl" / "a").write_bytes(b"x\xe9")
    (tmp_path / "b").write_bytes(b"y")
    got = {r["key"]: r for r in files.objects(spark, f"file://{tmp_path}").collect()}
    assert got["audit/jsonl/a"]["permitted"] and not got["b"]["permitted"]
    assert got["b"]["sha256"] == hashlib.sha256(b"y").hexdigest()
    body = spark.createDataFrame([(bytearray(b"x\xe9"),)], "c binary")
    assert body.select(files.decoded(F.col("c"), F.lit("iso-8859-1"))).first()[0] == "xé"
    with pytest.raises(Exception, match="unknown charset"):
        body.select(files.decoded(F.col("c"), F.lit("klingon"))).collect()


def test_notes(spark, tmp_path):
    (tmp_path / "a.md").write_text("---\nkind: Data-Set\n---\nbody\n")
    (tmp_path / "b.md").write_text("no front\n")
    (tmp_path / "c.md").write_text("---\n: [\n---\nx")
    (tmp_path / "d.txt").write_text("skipped")
    got = {r["path"].rsplit("/", 1)[-1]: r for r in files.notes(spark, str(tmp_path)).collect()}
    assert set(got) == {"a.md", "b.md", "c.md"}
    assert (got["a.md"]["kind"], got["a.md"]["permitted"], got["a.md"]["body"]) == ("dataset", True, "body\n")
    assert got["b.md"]["front"] is None and not got["b.md"]["permitted"] and got["c.md"]["front"] is None


def test_routing():
    good = {"tiers": {"tier0": {"x": {"role": "writer"}}, "tier3": {"y": {"role": "any"}}}}
    assert files.routing_problems(good, {"x": "writer"}, "y") == []
    bad = {"tiers": {"tier0": {"x": {"role": "reader", "price": 3}, "y": {"note": "$5 per call"}}}}
    assert len(files.routing_problems(bad, {"x": "writer"}, "y")) == 4
    assert files.routing_problems([], {}, "y")


def test_ledger_report_and_schemas(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("a", 1)], "id string, v int")
    path = str(tmp_path / "ledger")
    assert sinks.append(rows, path, "id").count() == 2
    assert sinks.append(rows.withColumn("v", F.lit(9)).unionByName(spark.createDataFrame([("c", 3)], "id string, v int")), path, "id").agg(F.sum("v")).first()[0] == 6
    assert sinks.report(rows, str(tmp_path / "r")) == 1 and sinks.report(rows.filter("false"), str(tmp_path / "r")) == 0
    s = sinks.Schemas()
    s.add("v2", "b int, a string")
    s.add("v1", "a string")
    s.add("v10", "c double")
    with pytest.raises(ValueError):
        s.add("v2", "x int")
    assert s.latest == "v10" and s.schema("v2").names == ["a", "b"] and s.schema().names == ["a", "b", "c"]
    assert s.migrate(spark.createDataFrame([("x",)], "a string"), {"c": 1.5}).first().asDict() == {"a": "x", "b": None, "c": 1.5}


def test_communities(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (10, 11), (11, 12), (10, 12)], "src long, dst long")
    got = {r["node"]: r["label"] for r in design.communities(edges).collect()}
    assert len({got[i] for i in (1, 2, 3)}) == 1 and len({got[i] for i in (10, 11, 12)}) == 1 and got[1] != got[10]


def test_objects_are_put_and_deleted(spark, tmp_path):
    key = "audit/jsonl/a.json"
    digest = files.put(spark, f"file://{tmp_path}", key, b"{}")
    row = files.objects(spark, f"file://{tmp_path}").first()
    assert (row["key"], row["sha256"], row["permitted"]) == (key, digest, True)
    files.put(spark, f"file://{tmp_path}", key, b"[]")
    assert (tmp_path / key).read_bytes() == b"[]"
    for bad in ("private/x", "audit/jsonl/../../x", ""):
        with pytest.raises(ValueError):
            files.put(spark, f"file://{tmp_path}", bad, b"x")
    assert files.delete(spark, f"file://{tmp_path}", key) and not files.delete(spark, f"file://{tmp_path}", key)


def test_yaml_artefacts(spark, tmp_path):
    front = '{"id": "ADR-1", "invariants": [{"id": "INV-2", "statement": "b: c", "status": "active"}, {"id": "INV-1", "statement": "a", "status": null}]}'
    notes = spark.createDataFrame([("/x/one.md", front), ("/x/two.md", '{"invariants": [{"id": "INV-1", "statement": "z"}]}'), ("/x/three.md", None), ("/x/four.md", "{}")], "path string, front string")
    merged = sinks.merged_invariants(notes)
    assert [(r["id"], r["note"]) for r in merged.collect()] == [("INV-1", "ADR-1"), ("INV-1", "two"), ("INV-2", "ADR-1")]
    sinks.write_yaml(merged, "invariants", f"file://{tmp_path}/i.yaml")
    sinks.write_yaml(merged.filter("false"), "invariants", f"file://{tmp_path}/none.yaml")
    yaml = pytest.importorskip("yaml")
    assert [x["statement"] for x in yaml.safe_load((tmp_path / "i.yaml").read_text())["invariants"]] == ["a", "z", "b: c"]
    assert yaml.safe_load((tmp_path / "none.yaml").read_text()) == {"invariants": []}


def test_references_into_code(spark):
    code = "// export const ghost = 1\nexport const real = 'export const inside';\nexport async function run() { return 1 }\nconst other = 2; export { other, real as alias }\n/* fetch( */ x.fetch(1); fetch (`fetch(${'a'})`);\n"
    sources = spark.createDataFrame([("src/a.ts", code)], "path string, text string")
    refs = ["src/a.ts:5", "src/a.ts:6", "src/a.ts:0", "src/a.ts:real", "src/a.ts:rea", "src/a.ts:run", "src/a.ts:other", "src/a.ts:alias", "src/a.ts:ghost", "src/a.ts:inside", "src/b.ts:1", "../a.ts:1", "src/a.ts:", "src/a.ts"]
    got = {r["ref"]: r["problem"] for r in files.reference_problems(spark.createDataFrame([(r,) for r in refs], "ref string"), sources).collect()}
    assert got == {"src/a.ts:6": "line_out_of_range", "src/a.ts:0": "line_out_of_range", "src/a.ts:rea": "export_not_found", "src/a.ts:ghost": "export_not_found", "src/a.ts:inside": "export_not_found", "src/b.ts:1": "missing_file", "../a.ts:1": "outside", "src/a.ts:": "malformed", "src/a.ts": "malformed"}
    assert [tuple(r) for r in files.raw_calls(sources).collect()] == [("src/a.ts", 5)]


def test_charsets(spark):
    rows = [(b"x\xe9\x80\x93", "ISO-8859-1", "xé€“"), ("한국 뉴스".encode("cp949"), "euc-kr", "한국 뉴스"), ("日本".encode("shift_jis"), "Shift_JIS", "日本"), ("\ufeffя".encode(), "utf-8", "я"), (b"a\xffb", "utf8", "a\ufffdb"), ("я".encode("utf-16-be"), "utf-16be", "я"), ("я".encode("cp1251"), "windows-1251", "я"), (b"a\x81", "big5", "a\ufffd"), (None, "utf-8", None), (b"x", None, None)]
    body = spark.createDataFrame([(None if b is None else bytearray(b), c, w) for b, c, w in rows], "b binary, c string, w string")
    assert [r["t"] for r in body.select(files.decoded(F.col("b"), F.col("c")).alias("t")).collect()] == [w for *_, w in rows]


def test_ledger_has_one_row_a_key(spark, tmp_path, monkeypatch):
    """Writers at a time, a job that is run again, a task that fails, and a commit that is never named."""
    from concurrent.futures import ThreadPoolExecutor

    schema = "id string, v int"
    kind = spark.createDataFrame([], schema).schema
    ledger = lambda: sinks.Ledger(spark, f"{tmp_path}/l", kind, "id")
    rows = lambda keys, v: spark.createDataFrame([(k, v) for k in keys], schema)
    with ThreadPoolExecutor(4) as pool:
        added = list(pool.map(lambda v: ledger().append(rows(["a", "b", f"own{v}", None, "a"], v)), range(4)))
    got = ledger().read().collect()
    assert sorted(r.id for r in got) == ["a", "b", "own0", "own1", "own2", "own3"] and sum(added) == 6
    assert ledger().append(rows(["c"], 1), "job") == 1 and ledger().append(rows(["c", "d"], 2), "job") == 0
    bad = rows(["e"], 3).withColumn("v", F.when(F.col("id") == "e", F.raise_error(F.lit("no"))).otherwise(1).cast("int"))
    with pytest.raises(Exception, match="no"):
        ledger().append(bad)
    assert {r.id for r in ledger().read().collect()} == {"a", "b", "c", "own0", "own1", "own2", "own3"}
    assert ledger().append(rows(["e"], 4)) == 1
    (tmp_path / "l" / "_commits" / "000000099").touch()
    monkeypatch.setattr(sinks.Ledger, "PATIENCE", 1)
    with pytest.raises(RuntimeError, match="not named"):
        ledger().append(rows(["f"], 5))


def test_commit_has_one_writer(spark, tmp_path):
    """Of writers that try one number at the same time, one gets it, and its name stays."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    ledger = sinks.Ledger(spark, f"{tmp_path}/l", spark.createDataFrame([], "id string").schema, "id")
    ledger._fs.mkdirs(ledger._at("_commits"))
    together = Barrier(8)

    def tries(writer):
        got = []
        for n in range(100):
            together.wait(10)
            got.append(ledger._commit(n, f"w{writer}"))
        return got

    with ThreadPoolExecutor(8) as pool:
        won = list(zip(*pool.map(tries, range(8)), strict=True))
    assert [sum(x) for x in won] == [1] * 100
    assert [(tmp_path / "l" / "_commits" / f"{n:09d}").read_text() for n in range(100)] == [f"w{x.index(True)}" for x in won]
