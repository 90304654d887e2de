"""Each operator against plain code on small tables with nulls, ties, repeats and clashing names."""

from __future__ import annotations

import gzip
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewright.functions.words import shingle_sets
from tidewright.llm import decontaminate, embedding_dedup, jaccard_join, language_model, line_dedup, packing, personal_data, quality, queries, token_counts, tokens, warc
from tidewright.operators import components
from tidewright.scratch import Scratch

DOCS = "doc_id long, text string, n_lines long, key string"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", low(text)) if w]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns whose names clash."""
    rng = random.Random(1)
    vocab = ["alpha", "Beta", "gamma", "delta", "eps", "zeta", "éta"]
    base = " ".join(rng.choice(vocab) + str(rng.randint(0, 40)) for _ in range(120))
    rows = [(1, None), (2, ""), (3, " \n "), (4, base), (4, base), (5, base), (6, base + " more"), (7, base.replace("alpha", "ALPHA")), (8, "one two"), (9, "one  two"), (None, "one two three"), (None, base), (10, "x" * 30_000 + " end"), (11, "a\n" * 3000)]
    for i in range(12, 60):
        w = base.split(" ")
        for _ in range(i % 9):
            w[rng.randrange(len(w))] = f"n{rng.randint(0, 999)}"
        rows.append((i, " ".join(w) + ("\nshared line\n Shared LINE \r" if i % 2 else "\n") + " ".join(rng.choice(vocab) for _ in range(i % 7))))
    return spark.createDataFrame([(i, t, 7, "k") for i, t in rows], DOCS)


def table(folder, name):
    p = Path(folder) / f"{name}.parquet"
    return f"'{p}/*.parquet'" if p.is_dir() else f"'{p}'"


def rows_of(odd):
    return [(r["doc_id"], r["text"]) for r in odd.collect()]


def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---- 1 ----------------------------------------------------------------------


def test_line_dedup(spark, odd):
    rows = rows_of(odd)
    key = lambda line: low(line.strip(" \t\n\x0b\x0c\r"))
    count = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    want = sorted(((str(i), len((t or "").split("\n")), sum(count[key(x)] >= 10 for x in (t or "").split("\n") if key(x)), "\n".join(x for x in (t or "").split("\n") if not key(x) or count[key(x)] < 10)) for i, t in rows), key=repr)
    got = line_dedup.drop_common_lines(odd, 10, 1)
    assert set(got.columns) == {"doc_id", "text", "n_lines", "key", "n_dropped"}
    assert sorted(((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()), key=repr) == want
    assert any(w[2] for w in want)
    assert line_dedup.drop_common_lines(empty(spark)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    clash = odd.withColumnsRenamed({"key": "__own", "n_lines": "__own_"}).withColumn("__doc", F.lit(5))
    again = line_dedup.drop_common_lines(clash, 10, 1)
    assert set(again.columns) == {*clash.columns, "n_lines", "n_dropped"} and again.filter("__own = 'k' and __own_ = 7 and __doc = 5").count() == len(rows)


# ---- 2 ----------------------------------------------------------------------


def test_gram_hashes_agree():
    code = np.frombuffer("abcabcabcabcxyz".encode("utf-32-le"), np.uint32)
    for q in range(1, 8):
        g = decontaminate.grams(code, q)
        text = "abcabcabcabcxyz"
        same = {}
        for i in range(len(text) - q + 1):
            same.setdefault(text[i : i + q], set()).add(int(g[i]))
        assert all(len(v) == 1 for v in same.values()) and len({next(iter(v)) for v in same.values()}) == len(same)


def edits_within(item, text):
    """Least edits of the item anywhere in the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_decontamination(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeèfgh") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randint(14, 40)))) for i in range(12)] + [(90, None), (91, ""), (92, "short")]
    docs, planted = [(1, None), (2, ""), (3, "short")], set()
    for i in range(10, 70):
        k = rng.randrange(12)
        c, e = list(items[k][1]), decontaminate.budget(len(items[k][1]), decontaminate.Q, decontaminate.RATE)
        for _ in range(rng.randint(0, e + 4)):
            p = rng.randrange(len(c))
            c[p : p + 1] = rng.choice([["q"], [], [c[p], "z"]])
        docs.append((i, " ".join(word() for _ in range(30)) + " " + re.sub("[a-z]", lambda m: m[0].upper(), "".join(c)) + "\n" + " ".join(word() for _ in range(30))))
    norm = lambda t: re.sub(r"[\x20\x09-\x0d]+", " ", low(t))
    for d, t in docs:
        for k, item in items[:12]:
            if edits_within(norm(item), norm(t)) <= decontaminate.budget(len(norm(item)), decontaminate.Q, decontaminate.RATE):
                planted.add((d, k))
    texts_table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matches(texts_table, bench).collect()
    assert {(r["doc"], r["item"]) for r in got} == planted and len(planted) > 20
    text = dict(docs)
    for r in got:
        assert edits_within(norm(dict(items)[r["item"]]), norm(text[r["doc"]][r["start"] : r["end"]])) <= r["edits"]
    blocks = decontaminate.BLOCK_CHARS
    try:
        decontaminate.BLOCK_CHARS = 900
        assert {(r["doc"], r["item"]) for r in decontaminate.matches(texts_table, bench).collect()} == planted
    finally:
        decontaminate.BLOCK_CHARS = blocks
    left = {r["doc_id"] for r in decontaminate.clean(texts_table, bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in planted}
    assert decontaminate.matches(texts_table, bench.filter("false")).count() == 0 and decontaminate.matches(texts_table.filter("false"), bench).count() == 0


def test_decontamination_judges_each_row(spark):
    passage = "the seven grey herons of the lower marsh return before the first frost of the year"
    rows = [(1, "so " + passage + " ok"), (1, "clean text of the same id"), (None, passage), (None, "clean text without an id"), (None, None), (2, passage), (2, passage)]
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, item long")
    bench = spark.createDataFrame([(None, passage), (4, None)], "item_id long, text string")
    assert sorted(((r["doc_id"], r["text"]) for r in decontaminate.clean(docs, bench).collect()), key=repr) == sorted([rows[1], rows[3], rows[4]], key=repr)
    assert sorted((r["doc"] for r in decontaminate.matches(docs, bench).collect()), key=repr) == [1, 2, 2, None]


def plain_bands(ix, code):
    """Counts of shared q-grams by band, pair by pair."""
    g, out = decontaminate.grams(code, ix.q), Counter()
    for p in range(len(g)):
        for j in np.flatnonzero(ix.gram == g[p]):
            k = int(ix.item[j])
            strip = (p - int(ix.pos[j])) // (2 * int(ix.edits[k]) + 1)
            out[(k, strip)] += 1
            out[(k, strip - 1)] += 1
    return sorted((k, b * (2 * int(ix.edits[k]) + 1)) for (k, b), n in out.items() if n >= ix.needed[k])


def test_bands_of_repeated_grams(monkeypatch):
    """A gram that text and passage repeat is counted by a correlation, with the same bands, in bounded memory."""
    rng = random.Random(3)
    words_ = " ".join("".join(rng.choice("abc") for _ in range(4)) for _ in range(30))
    ix = decontaminate.index([(1, "-" * 120), (2, words_ + "-" * 40), (3, "ab" * 50), (4, words_)])
    text = "x" + "-" * 300 + words_ + "ab" * 90 + " " + words_.replace("a", "-", 2) + "-" * 35
    code = decontaminate.normalised(text)[0]
    want = plain_bands(ix, code)
    for pairs in (1 << 20, 2000, 200, 7):
        monkeypatch.setattr(decontaminate, "_PAIRS", pairs)
        assert sorted(zip(*map(np.ndarray.tolist, decontaminate.bands(ix, code)), strict=True)) == want, pairs
    monkeypatch.undo()
    import tracemalloc

    ix, code = decontaminate.index([(1, "-" * 3000)]), decontaminate.normalised("-" * 60_000)[0]
    tracemalloc.start()
    assert len(decontaminate.bands(ix, code)[0])
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_alignment_of_a_long_passage():
    """A passage of thousands of characters is verified in steps of bounded size, against the plain table."""
    rng = random.Random(9)
    item = "".join(rng.choice("abcdefgh ") for _ in range(2500)).strip()
    c = list(item)
    for _ in range(60):
        p = rng.randrange(len(c))
        c[p : p + 1] = rng.choice([["z"], [], [c[p], "y"]])
    text = "intro text " + "".join(c) + " the end"
    ix = decontaminate.index([(1, item), (2, "short one of some letters"), (3, item[:300])])
    found = {k: e for _, k, _, _, e in decontaminate.find(ix, [text, "nothing", text[:900]])}
    norm = lambda t: re.sub(r" +", " ", t)
    assert found[0] == edits_within(norm(item), norm(text)) and found[2] == edits_within(norm(item[:300]), norm(text))


# ---- 3 ----------------------------------------------------------------------


def test_language_model_counts(spark, odd):
    rows = rows_of(odd)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, t in rows if not held(i) for w in [*words(t), None])
    n, v = sum(count.values()), len(count)
    want = sorted(((str(i), held(i), len(words(t)) + 1, sum(count[w] > 0 for w in [*words(t), None]), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*words(t), None]), 6)) for i, t in rows), key=repr)
    frequent = language_model.FREQUENT
    for most in (frequent, 5, 0):  # all counts broadcast, some, none
        language_model.FREQUENT = most
        try:
            got = language_model.score(odd, quality.fold("doc_id", 7) == 2).collect()
        finally:
            language_model.FREQUENT = frequent
        assert sorted(((str(r["id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=repr) == want
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_language_model_gradient_and_sum():
    vocab = language_model.Vocabulary(np.arange(language_model.IDS, dtype=np.int64) % 97, np.arange(language_model.IDS) % 2 == 0)
    flat = language_model.initial(vocab).astype(np.float64)
    rng = np.random.default_rng(0)
    w = rng.integers(0, language_model.LEAVES, (2, language_model.WINDOW))
    first = np.tile(np.arange(language_model.WINDOW // language_model.SPAN) == 0, 2)
    inputs, targets = w.reshape(-1, language_model.SPAN), np.roll(w, 3).reshape(-1, language_model.SPAN)
    _, g = language_model.gradient(flat, inputs, targets, first)
    at = 0
    for name, size in language_model._SIZES.items():
        j = at + int(np.abs(g[at : at + size]).argmax())
        up, down = flat.copy(), flat.copy()
        up[j] += 1e-4
        down[j] -= 1e-4
        slope = (language_model.gradient(up, inputs, targets, first)[0] - language_model.gradient(down, inputs, targets, first)[0]) / 2e-4
        assert slope == pytest.approx(g[j], rel=1e-3, abs=1e-9), name
        at += size
    tables = language_model.Tables(flat.astype(np.float32))
    ids = np.array([5, 900, 44])
    every = np.concatenate([np.append(ids, x) for x in range(language_model.IDS)])
    lead = language_model.score_ids(tables, vocab, ids, np.array([0, 3]))[0]
    total = 10 ** (language_model.score_ids(tables, vocab, every, np.arange(0, len(every) + 1, 4)) - lead)
    assert total.sum() == pytest.approx(1, abs=1e-3)
    long = rng.integers(0, language_model.IDS, 500)
    both = language_model.score_ids(tables, vocab, np.concatenate([long, ids]), np.array([0, 500, 503]))
    small = language_model.score_ids(tables, vocab, np.concatenate([long, ids]), np.array([0, 500, 503]), batch=3)
    assert both == pytest.approx(small, rel=1e-4) and both[1] == pytest.approx(lead, rel=1e-5)


def test_language_model_score_is_the_plain_forward_pass():
    """One position at a time, with loops, in double precision."""
    counts = np.random.default_rng(2).integers(0, 500, language_model.IDS) // 490
    counts[:3000] += 400
    vocab = language_model.Vocabulary(counts, np.arange(language_model.IDS) % 3 == 0)
    flat = language_model.initial(vocab, seed=3)
    p = {k: x.astype(float) for k, x in language_model.unpack(flat).items()}
    span, groups, members, leaves = language_model.SPAN, language_model.GROUPS, language_model.MEMBERS, language_model.LEAVES

    def log10_of(ids):
        classes, total = [leaves, *vocab.leaf[ids].tolist()], 0.0
        for i in range(len(ids)):
            seen = range((i // span - 1) * span if i >= span else 0, i + 1)
            q = p["e"][classes[i]] @ p["q"]
            weight = [math.exp(q @ (p["e"][classes[j]] @ p["k"]) / math.sqrt(language_model.WIDTH) + p["near"][i - j]) for j in seen]
            value = sum(w * (p["e"][classes[j]] @ p["v"]) for w, j in zip(weight, seen, strict=True)) / sum(weight)
            h = np.append(np.tanh(p["e"][classes[i]] @ p["r"] + value @ p["a"] + p["b"]), 1.0)
            goal = classes[i + 1]
            for x, at in [(h @ p["o"], goal // members), *([(h @ p["m"][goal // members], goal % members)] if goal // members < groups - 1 else [])]:
                total += (x[at] - math.log(np.exp(x).sum())) / math.log(10)
            total += vocab.within[ids[i]]
        return total

    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 4000, n) if n % 2 else rng.integers(0, language_model.IDS, n) for n in (1, 15, 16, 17, 32, 33, 90)]
    first = np.cumsum([0, *map(len, texts)])
    got = language_model.score_ids(language_model.Tables(flat), vocab, np.concatenate(texts), first, batch=4)
    assert got == pytest.approx([log10_of(x) for x in texts], rel=1e-4)


def test_language_model_learns(spark, small):
    """Training by the cluster helps documents that it does not see."""
    got = queries.op3_lm_scoring(spark, small).toPandas()
    plain = language_model.score(spark.read.parquet(f"{small}/documents.parquet"), quality.fold("doc_id", 7) == 2, rounds=0).toPandas()
    assert len(got) == len(plain) == 200 and np.isfinite(got["score"]).all()
    assert got[got["held_out"]]["score"].sum() > plain[plain["held_out"]]["score"].sum()


def test_language_model_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, score string")
    assert language_model.score(none, F.lit(False)).collect() == []
    clash = spark.createDataFrame([(1, "a b", "x", 5), (2, None, "y", 6)], "doc_id long, text string, score string, held_out int")
    got = {r["id"]: r for r in language_model.score(clash, F.col("doc_id") == 2).collect()}
    assert got[1]["n_tokens"] == 3 and got[2]["n_tokens"] == 1 and got[2]["held_out"] and got[1]["train_tokens"] == 3


def test_language_model_trains_on_whole_texts():
    """Every id of every text is a target once, after the id before it."""
    rng = random.Random(3)
    texts = ["", "one", *(" ".join(rng.choice(["alpha", "beta"]) + str(rng.randint(0, 99)) for _ in range(n)) for n in (10, 79, 500, 4000))]
    whole = []
    for text in texts:
        for *_, ids, first in language_model.Subwords(tokens.vocabulary())(pa.array([text])):
            assert list(first) == [0, len(ids)]
            whole.append([language_model._BOS, *ids.tolist()])
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)), pa.int64())], ["text", "pick"])
    got = pa.Table.from_batches(language_model._gather(tokens.vocabulary())([batch])).to_pylist()
    stored = [r["ids"] for r in got if r["kind"] == 2]
    windows = [np.frombuffer(w, "<u2").tolist() for w in stored]
    keys = [r["key"] for r in got if r["kind"] == 2]
    assert all(len(w) <= language_model.WINDOW + 1 for w in windows) and len(set(keys)) == len(keys) and min(keys) >= 0
    joined = []
    for w in windows:
        if w[0] == language_model._BOS:
            joined.append(w)
        else:
            assert joined[-1][-1] == w[0]
            joined[-1] = joined[-1] + w[1:]
    assert joined == whole
    vocab = language_model.Vocabulary(np.zeros(language_model.IDS, np.int64), np.arange(language_model.IDS) % 2 == 0)
    classes = language_model.window_classes(pa.array([b"?", *stored], pa.binary()).slice(1), vocab)
    assert (classes[:, 1:] >= 0).sum() == sum(len(w) - 1 for w in windows) and (classes[:, 0] == language_model.LEAVES).sum() == len(texts)


def test_language_model_beats_the_untrained_one_held_out(spark, monkeypatch):
    """Digits that cannot be learned, then words in a fixed order."""
    rng = random.Random(5)
    names = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne") for b in ("ra", "su", "ti")]
    opening = lambda: " ".join(str(rng.randint(0, 9999)) for _ in range(100))
    chain = lambda n: " ".join(names[(n + j) % 12] for j in range(900))
    rows = [(i, opening() + " " + chain(i), i % 5 == 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(2)
    held = lambda df: df.filter("held_out").agg(F.sum("score")).first()[0]
    got = held(language_model.score(docs, F.col("held")))
    monkeypatch.setattr(language_model, "descend", lambda *_, **__: None)
    assert got > 0.5 * held(language_model.score(docs, F.col("held"), rounds=0))


# ---- 4 ----------------------------------------------------------------------


def test_warc(spark):
    big = "é" * 600
    rows = [(1, "http://a/", big), (2, "http://b/ x", big), (2, "u", "é" * 700), (1, "u", big), (3, None, None), (4, "u", ""), (5, "u", "tiny"), (6, "u", "tiny"), (7, "http://a/", big), (8, "u", "WARC/1.1\r\n\r\n" + big), (None, "u", "none")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, kind string")
    want = []
    for key, _, html in rows:
        data = (html or "").encode()
        revisit = key in (1, 2) and html == big
        want.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 7 if revisit else None))
    got = [(r["key"], r["payload_bytes"], r["digest"], r["kind"], r["refers_to"]) for r in warc.round_trip(pages).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert warc.round_trip(pages.filter("false")).count() == 0


def test_warc_many_archives(spark, monkeypatch):
    """Archives smaller than the rows of a task, one of them of a single long record."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    rows = [(i, "u", chr(97 + i % 26) * (500 + 97 * i)) for i in range(60)] + [(100, "u", "long " * 40_000), (101, "u", "long " * 40_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    scratch = Scratch(spark, "warc-test")
    whole = warc.write(pages, f"{scratch.root}/whole", scratch)
    assert whole.count() > 20
    tidy = warc.normalise(whole, f"{scratch.root}/members", scratch)
    got = {r["key"]: r for r in warc.read(tidy, with_payload=True).collect()}
    assert {k: (r["payload_bytes"], r["kind"]) for k, r in got.items()} == {i: (len(t), "revisit" if i == 100 else "response") for i, _, t in rows}
    assert all(bytes(got[i]["payload"]).decode() == t for i, _, t in rows if i != 100) and got[100]["refers_to"] == 101


def test_warc_members(tmp_path):
    parts = [warc.record(i, "u", bytes([i]) * 50, "d", "response", None) for i in range(5)]
    whole = gzip.compress(b"".join(parts))
    found = list(warc.members(whole))
    assert [gzip.decompress(m) for _, m in found] == parts and [n for n, _ in found] == [f"<urn:page:{i}>" for i in range(5)]
    again = list(warc.members(b"".join(m for _, m in found)))
    assert again == found
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(m for _, m in found))
    offset = len(found[0][1]) + len(found[1][1])
    assert warc.read_one(f"file://{path}", offset, len(found[2][1]))[1] == b"\x02" * 50
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(parts[0][:-20])))


# ---- 5 ----------------------------------------------------------------------


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "@", ".", "-", "+", " ", "1", "25", "4539578763621486", "(", ")", "b.c", "é", "255.1.2.3", "+1 (555) 555-1234", "x@y.z", "\n"]) for _ in range(rng.randint(0, 14)))
        assert personal_data.base_spans(text) == plain_spans(text), text


def test_octets_with_many_zeros():
    zeros = "0" * 5000
    text = f"at {zeros}1.2.3.{zeros}255 and {zeros}.0.0.0 not 1.2.3.{zeros}256 nor {'9' * 5000}.1.1.1"
    got = [text[a:b] for kind, a, b in personal_data.base_spans(text) if kind == "ip"]
    assert got == [f"{zeros}1.2.3.{zeros}255", f"{zeros}.0.0.0"]


@pytest.fixture(scope="module")
def net(small):
    """Trained as the query trains it, between passages of documents."""
    return personal_data.train([t[0][:4000] for t in duckdb.sql(f"select text from {table(small, 'documents')} where text <> '' order by doc_id").fetchall()])


def test_model_spans(net):
    rng = random.Random(8)
    hit = Counter()
    for _ in range(120):
        got, kind = personal_data._example(rng)
        text = f"the reed of heather {got} was onto the shed"
        base, every = personal_data.find(net, [text])[0]
        assert base == plain_spans(text) and set(base) <= set(every)
        if kind:
            hit[(kind, "all")] += 1
            hit[(kind, "hit")] += (kind, 20, 20 + len(got)) in every
        else:
            hit["false"] += len(every) - len(base)
    assert sum(hit[(k, "hit")] for k in personal_data.KINDS) >= 0.85 * sum(hit[(k, "all")] for k in personal_data.KINDS)
    assert hit["false"] == 0


#: Spellings that the training examples are not written in.
HELD_OUT = (
    ("phone", "0049 89 123-4567"), ("phone", "(030) 1234 5678"), ("phone", "+33.6.12.34.56.78"), ("phone", "020-7946-0958"), ("phone", "+1 415 555 26 71"), ("email", "anna-lena@post . example . org"), ("email", "joe (at) mail . example . net"), ("email", "kim.lee [at] site [dot] co [dot] uk"),
    ("email", "max at example dot org"), ("email", "a_b{at}c{dot}de"), ("ip", "10 . 20 . 30 . 40"), ("ip", "192[.]168[.]0[.]1"), ("ip", "172(dot)16(dot)4(dot)9"), ("card", "4539 578763 621486"), ("card", "4539.5787.6362.1486"), ("card", "4539/5787/6362/1486"), ("card", "45 39 57 87 63 62 14 86"),
)


def test_model_on_spellings_it_was_not_taught(net):
    hits = []
    for kind, got in HELD_OUT:
        text = f"Please write to {got} before the end of the week."
        hits.append((kind, 16, 16 + len(got)) in personal_data.find(net, [text])[0][1])
    assert sum(hits) >= 0.7 * len(HELD_OUT), [x for x, hit in zip(HELD_OUT, hits, strict=True) if not hit]
    clean = "On 2024-01-15 at 10:20, version 1.2.3 of 12,345 lines (2019-2024) sold 1990 copies; see section 4.5.6.7.8 and order 20240115-77."
    assert personal_data.find(net, [clean])[0][1] == plain_spans(clean)


def test_gate_changes_nothing(net, small):
    texts = [t[0] or "" for t in duckdb.sql(f"select text from {table(small, 'documents')} limit 60").fetchall()] + ["", "1", "@" * 300, "mail (at) host (dot) org " * 20]
    assert personal_data.find(net, texts) == personal_data.find(net, texts, gate=False)


def test_reconcile():
    pieces = [("email", 10, 40, True), ("email", 10, 60, False), ("phone", 50, 58, False), ("ip", 100, 120, True), ("ip", 120, 130, True)]
    assert personal_data.reconcile(pieces) == [("email", 10, 60), ("ip", 100, 130)]


def test_search(spark, net, odd):
    extra = odd.limit(3).unionByName(spark.createDataFrame([(70, "é mail a.b@c.org", 1, "k"), (70, "é mail a.b@c.org", 1, "k")], DOCS))
    got = personal_data.search(extra, net).filter("id = 70").collect()
    assert [[tuple(s) for s in r["base"]] for r in got] == [[("email", 7, 16)]] * 2
    assert personal_data.search(empty(spark), net).count() == 0


def test_personal_data_query(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op5_personal_data(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r["doc_id"]] or "")
        said = personal_data.joined(base)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert {k: r[f"n_{k}"] for k in personal_data.KINDS} == {k: sum(s[0] == k for s in base) for k in personal_data.KINDS}
        assert set(said.split(",")) <= set(r["spans"].split(",")) or not base
        assert r["n_added"] or r["spans"] == said


# ---- 6 ----------------------------------------------------------------------


def brute_classes(rows, rule):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + rule.words]) for i in range(len(w) - rule.words + 1)} if len(w) >= rule.words else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and rule.den * both >= rule.num * (len(sets[i]) + len(sets[j]) - both):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted(((str(doc), len(sets[i]), str(least.get(top(i)))) for i, (doc, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("rule", [jaccard_join.JaccardRule(3, 9, 10), jaccard_join.JaccardRule(5, 4, 5), jaccard_join.JaccardRule(1, 1, 1)])
def test_jaccard_join(spark, odd, rule):
    got = sorted(((str(r["id"]), r["n_grams"], str(r["class_id"])) for r in jaccard_join.classes(odd, rule).collect()), key=repr)
    assert got == brute_classes(rows_of(odd), rule)


def test_jaccard_empty_and_keep(spark, odd):
    assert jaccard_join.classes(empty(spark)).count() == 0
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    classes = {r["id"]: r["class_id"] for r in jaccard_join.classes(odd).collect()}
    assert {r["doc_id"] for r in kept.collect()} >= {i for i, c in classes.items() if i == c}


def test_jaccard_near_copy_without_an_id(spark):
    """A row without an id links as any other, also as the only way between two that have one, and goes where one of them stays."""
    w = [f"w{i}" for i in range(60)]
    near = [" ".join(w), " ".join([*w[:-1], "x"]), " ".join(["y", *w[1:-1], "x"])]
    alone = " ".join(f"z{i}" for i in range(60))
    rule = jaccard_join.JaccardRule(3, 95, 100)
    for texts in (near,):
        rows = [(1, texts[0]), (None, texts[1]), *((2, t) for t in texts[2:]), (None, alone), (None, None), (3, "other words of its own")]
        docs = spark.createDataFrame([(i, t, 7, "k") for i, t in rows], DOCS)
        found = sorted(((str(r["id"]), r["n_grams"], str(r["class_id"])) for r in jaccard_join.classes(docs, rule).collect()), key=repr)
        assert found == brute_classes(rows, rule) and sum(c == "1" for *_, c in found) == len(texts)
        kept = sorted(((r["doc_id"], r["text"]) for r in jaccard_join.keep_one(docs, rule).collect()), key=repr)
        assert kept == sorted([(1, texts[0]), (None, alone), (None, None), (3, "other words of its own")], key=repr)


def test_jaccard_keeps_by_text(spark):
    """Rows that share an id, or have none, are judged by their own texts."""
    text = " ".join(f"w{i}" for i in range(200))
    other = " ".join(f"u{i}" for i in range(200))
    rows = [(1, text), (5, text + " more"), (5, other), (5, ""), (None, text + " less"), (None, "alone here by itself"), (None, None), (7, "alone"), (8, text)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, key string, __id string")
    left = [(r["doc_id"], r["text"]) for r in jaccard_join.keep_one(docs).collect()]
    want = [(1, text), (5, other), (5, ""), (None, "alone here by itself"), (None, None), (7, "alone")]
    assert sorted(left, key=repr) == sorted(want, key=repr)
    assert jaccard_join.keep_one(docs).columns == docs.columns


def test_shingles_of_whole_texts():
    texts = ["a b c d", "A  B\nc\td", None, "", "a b", "b a", "abc", "é à"]
    s = list(shingle_sets(pa.array(texts), 3))
    assert [len(x) for x in s] == [2, 2, 0, 0, 1, 1, 1, 1] and (s[0] == s[1]).all() and len({int(x[0]) for x in s[4:]}) == 4


def test_components(spark):
    rng = random.Random(3)
    names = [hashlib.md5(str(i).encode()).hexdigest() for i in range(300)]
    links = [(names[i], names[i + 1]) for i in range(150)] + [(names[rng.randrange(150, 300)], names[rng.randrange(150, 300)]) for _ in range(90)] + [(names[0], names[0]), (None, names[1])]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a string, b string"), Scratch(spark, "t")).collect()}
    parent = {n: n for n in names}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links[:-1]:
        parent[top(a)] = top(b)
    for a, b in links[:-1]:
        assert got[a] == got[b]
    assert len({got[n] for n in got}) == len({top(n) for n in got})


# ---- 7, 8 -------------------------------------------------------------------


def test_tokens_are_the_files(small):
    texts = [t[0] or "" for t in duckdb.sql(f"select text from {table(small, 'documents')} limit 80").fetchall()]
    texts += ["", " ", "a<|endoftext|>b", "<|endoftext|>", "\n\n  x", "it's we'll é ñ 123456 !!", "日本語 \U0001f600", " " * 50 + "x", "\x00\x1f"]
    path = tokens.vocabulary()
    for t in texts:
        assert tokens.encode(t, path).tolist() == tokens._slow(path).encode(t, add_special_tokens=False).ids, t[:50]


def test_tokens_of_long_runs(monkeypatch):
    """Runs are measured in one pass, and beyond the limits the tokenizer file decides."""
    import time

    path = tokens.vocabulary()
    text = (("ab" * 10_000) + " " + "\t" * 15_000) * 30
    began = time.perf_counter()
    assert not tokens.has_long_run(text) and time.perf_counter() - began < 1
    assert tokens.has_long_run("x" + " " * tokens.BLANKS) and tokens.has_long_run("a " + "x" * tokens.OTHERS) and not tokens.has_long_run("x" * (tokens.OTHERS - 1))
    for some in ("x" * 300 + " " * 300 + "é" * 300, "\n" * 500 + "end", " " * 400, "word " * 50):
        fast = tokens.encode(some, path).tolist()
        monkeypatch.setattr(tokens, "has_long_run", lambda _: True)
        assert tokens.encode(some, path).tolist() == fast
        monkeypatch.undo()


def test_token_counts(spark, odd):
    path = tokens.vocabulary()
    sizes = sorted(len(tokens.document_ids(t, path)) for _, t in rows_of(odd))
    counts = token_counts.context_table(token_counts.histogram(odd)).cache()
    got = {r["context_limit"]: r for r in counts.collect()}
    assert sorted(got) == sorted(set(sizes))
    for limit, r in got.items():
        within = [s for s in sizes if s <= limit]
        assert (r["n_docs"], r["docs_within"], r["tokens_within"], r["docs_over"], r["tokens_over"]) == (sizes.count(limit), len(within), sum(within), len(sizes) - len(within), sum(sizes) - sum(within))
        assert r["truncated_total"] == sum(min(s, limit) for s in sizes)
    assert token_counts.truncated_total(counts, 77) == sum(min(s, 77) for s in sizes)
    assert token_counts.quantile(counts, 0.5) == sizes[math.ceil(0.5 * len(sizes)) - 1]
    assert token_counts.context_table(token_counts.histogram(empty(spark))).count() == 0


def test_token_counts_by_sql(spark, odd):
    """All that follows the lengths, stated in SQL over them."""
    con = duckdb.connect()
    lengths = pa.table({"length": [len(tokens.document_ids(t, tokens.vocabulary())) for _, t in rows_of(odd)]})
    con.register("lengths", lengths)
    want = con.execute("""WITH h AS (SELECT length, count(*) AS n FROM lengths GROUP BY 1)
        SELECT length AS context_limit, n AS n_docs, (SELECT count(*) FROM lengths l WHERE l.length <= h.length) AS docs_within, (SELECT sum(length)::BIGINT FROM lengths l WHERE l.length <= h.length) AS tokens_within,
        (SELECT count(*) FROM lengths l WHERE l.length > h.length) AS docs_over, (SELECT coalesce(sum(length), 0)::BIGINT FROM lengths l WHERE l.length > h.length) AS tokens_over,
        (SELECT sum(least(l.length, h.length))::BIGINT FROM lengths l) AS truncated_total, (SELECT count(*) FILTER (l.length <= h.length) / count(*) FROM lengths l) AS quantile FROM h""").fetchall()
    got = token_counts.context_table(token_counts.histogram(odd)).select("context_limit", "n_docs", "docs_within", "tokens_within", "docs_over", "tokens_over", "truncated_total", "quantile").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_cut():
    for n in (1, 5, 6, 7, 12, 13, 600):
        parts = packing.cut(n, 6)
        assert [s for s, _ in parts] == [0, *np.cumsum([k for _, k in parts])[:-1].tolist()] and sum(k for _, k in parts) == n
        assert all(k == 6 for _, k in parts[1:]) and 0 < parts[0][1] <= 6


def test_plan_is_best_fit():
    rng = np.random.default_rng(4)
    for _ in range(60):
        size = int(rng.integers(3, 40))
        counts = rng.integers(0, 9, size + 1)
        counts[0] = 0
        rooms, made = [], 0
        for length in range(size, 0, -1):  # best-fit decreasing, one piece at a time
            for _ in range(counts[length]):
                fit = [i for i, r in enumerate(rooms) if r >= length]
                if fit:
                    rooms[min(fit, key=lambda i: rooms[i])] -= length
                else:
                    rooms.append(size - length)
        used = Counter()
        runs = packing.plan(counts, size)
        for k, (length, rank, first, each, offset) in enumerate(runs):
            end = runs[k + 1][1] if k + 1 < len(runs) and runs[k + 1][0] == length else counts[length]
            for x in range(end - rank):
                used[first + x // each] += length
                made = max(made, offset + (x % each + 1) * length)
        assert len(used) == len(rooms) and max(used.values(), default=0) <= size and sorted(used.values()) == sorted(size - r for r in rooms) and made <= size


def test_packing(spark, odd):
    path, got = tokens.vocabulary(), packing.pack(odd, 64, with_ids=True).collect()
    want = Counter()
    for i, t in rows_of(odd):
        ids = tokens.document_ids(t, path)
        for k, (s, n) in enumerate(packing.cut(len(ids), 64)):
            want[(i, k, s, n, zlib.crc32(ids[s : s + n].astype("<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    at = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0) and len(r["ids"]) == r["length"]
        at[r["sequence_id"]] = r["offset"] + r["length"]
    rooms = []
    for r in sorted(got, key=lambda r: -r["length"]):  # best-fit decreasing, one piece at a time
        fit = [i for i, room in enumerate(rooms) if room >= r["length"]]
        best = min(fit, key=lambda i: rooms[i]) if fit else len(rooms)
        rooms[best:] = [(rooms[best] if fit else 64) - r["length"], *rooms[best + 1 :]]
    assert max(at.values()) <= 64 and len(at) == len(rooms)
    assert packing.pack(empty(spark)).count() == 0


# ---- 9 ----------------------------------------------------------------------


def test_embeddings(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((60, 8))
    rows = [(i, (base[i % 20] + 0.12 * rng.standard_normal(8)).tolist(), int(i % 3 == 0)) for i in range(300)]
    rows += [(400 + i, rows[i % 5][1], rows[i % 5][2]) for i in range(40)]
    rows += [(500, None, 1), (501, [0.0] * 8, 1), (502, [1.0, None] + [0.0] * 6, 1), (503, [float("nan")] * 8, 1), (504, rows[0][1], None), (505, [float("inf")] * 8, 1), (506, [1.0, 2.0], 1), (507, [1.0, 2.0], 1), (508, [], 1), (506, [1.0, 2.0], 1), (None, rows[7][1], rows[7][2]), (None, [9.0, 9.0, -9.0], 1), (None, [9.0, 9.0, -9.0], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("key", F.lit("clash"))
    sound = [(k, i, np.array(v, np.float32).astype(float), lab) for k, (i, v, lab) in enumerate(rows) if v and lab is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = Counter()
    for a in range(len(sound)):
        for b in range(a):
            x, y = sound[a], sound[b]
            if x[3] == y[3] and len(x[2]) == len(y[2]) and x[2] @ y[2] / np.linalg.norm(x[2]) / np.linalg.norm(y[2]) >= 0.93:
                links[x[0]] += 1
                links[y[0]] += 1
                parent[top(x[0])] = top(y[0])
    least = {}
    for k, (i, *_) in enumerate(rows):
        least[top(k)] = min((x for x in (least.get(top(k)), i) if x is not None), default=None)
    want = sorted(((i, links[k], least[top(k)]) for k, (i, *_) in enumerate(rows)), key=repr)
    cell, block = embedding_dedup.CELL, embedding_dedup.BLOCK
    for c, b in ((cell, block), (20, block), (20, 15)):  # one cell, several cells, several blocks
        embedding_dedup.CELL, embedding_dedup.BLOCK = c, b
        try:
            got = sorted(((r["id"], r["n_links"], r["class_id"]) for r in embedding_dedup.classes(vectors).collect()), key=repr)
        finally:
            embedding_dedup.CELL, embedding_dedup.BLOCK = cell, block
        assert got == want
    assert embedding_dedup.classes(vectors.filter("false")).count() == 0


# ---- 10 ---------------------------------------------------------------------


def test_trees():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((2000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    trees = quality.fit(x[:1500], y[:1500])

    def walk(row):
        total = trees.base
        for root in trees.roots:
            at = int(root)
            while trees.left[at] >= 0:
                at = int(trees.left[at]) + int(row[trees.feature[at]] > trees.cut[at])
            total += trees.value[at]
        return 1 / (1 + math.exp(-total))

    p = trees.score(x[1500:])
    assert p[:50] == pytest.approx([walk(r) for r in x[1500:1550]])
    assert ((p > 0.5) == y[1500:]).mean() > 0.95
    assert quality.fit(x[:0], y[:0]).score(x[:3]) == pytest.approx([0.5] * 3)
    assert (quality.fit(x[:50], np.ones(50)).score(x[:3]) > 0.9).all()


def plain_features(text):
    data = text.encode()
    n = len(data)
    if not n:
        return [0.0] * len(quality.FEATURES)
    kind = lambda b: "lower" if 97 <= b <= 122 else "upper" if 65 <= b <= 90 else "digit" if 48 <= b <= 57 else "blank" if b in b" \t\x0b\x0c\r" else "line" if b == 10 else "high" if b > 127 else "mark" if b in b".,;:!?'\"-()" else "other"
    share = Counter(map(kind, data))
    lines = data.split(b"\n")
    found = re.findall(rb"[^\x20\x09-\x0d]+", data)
    folded = [w.lower() for w in found]
    size = [len(w) for w in found]
    mean = lambda x: sum(x) / len(x)
    some = bool(found)
    return [
        math.log1p(n), math.log1p(len(found)), math.log1p(len(lines)), *(share[k] / n for k in ("other", "lower", "upper", "digit", "blank", "high", "mark")),
        mean(size) if some else 0, math.sqrt(mean([(x - mean(size)) ** 2 for x in size])) if some else 0, math.log1p(max(size)) if some else 0, len(set(folded)) / len(folded) if some else 0, max(Counter(folded).values()) / len(folded) if some else 0,
        mean([a == b for a, b in zip(folded, folded[1:], strict=False)]) if len(found) > 1 else 0, mean([kind(w[-1]) in ("other", "digit") for w in found]) if some else 0,
        math.log1p(mean([len(x) for x in lines])), 1 - len(set(lines)) / len(lines) if len(lines) > 1 else 0, mean([len(x) < 40 for x in lines]), len(found) / len(lines),
    ]


def test_quality_features(odd):
    texts = [t for _, t in rows_of(odd)] + ["A a\tA! 7% é-é\n\nx\nx", "\n", "....", "one 1 one 2 TWO two two" * 3, "\x0b\x0c\r"]
    got = quality.features(pa.array(texts, pa.string()))
    assert got.shape == (len(texts), len(quality.FEATURES))
    for row, text in zip(got, texts, strict=True):
        assert row.tolist() == pytest.approx(plain_features(text or ""), rel=1e-9, abs=1e-12), text and text[:40]


def test_quality_of_repeated_ids(spark):
    """An id that many rows repeat brings no more than the documented number of rows, the same ones for any order."""
    docs = spark.createDataFrame([(i % 4, f"text {i} " * (i % 9 + 1), 0.5) for i in range(400)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality int")
    a, b = (quality.train(d, labels, max_rows=50) for d in (docs, docs.orderBy(F.desc("text")).repartition(3)))
    assert np.array_equal(a.value, b.value) and np.array_equal(a.cut, b.cut)
    assert quality.score(docs, a).count() == 400


def test_quality_held_out(spark, odd):
    sf = "/root/testdata/sf0.01"
    got = queries.op10_quality_classifier(spark, sf).toPandas().merge(duckdb.sql(f"select doc_id, quality from {table(sf, 'labels')}").df(), on="doc_id")
    test = got[got["held_out"]]
    good, bad = test[test["quality"] == 1]["score"].to_numpy(), test[test["quality"] == 0]["score"].to_numpy()
    auc = np.mean((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :]))
    assert auc > 0.9 and (good >= quality.THRESHOLD).mean() > 0.95
    labels = spark.createDataFrame([(4, 1), (5, 0), (4, None), (None, 1)], "doc_id long, quality int")
    rows = quality.score(odd, quality.train(odd, labels)).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(empty(spark), quality.train(empty(spark), labels.filter("false"))).count() == 0


# ---- registered queries and the pipeline ------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(name, spark, small):
    con = duckdb.connect()
    for p in Path(small).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    df = queries.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    result = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)


def test_pipeline_stages(spark, small, tmp_path):
    """Each stage keeps the columns of documents and does to its own input what plain code does."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        before, after = {r["doc_id"]: r["text"] for r in docs.collect()}, {r["doc_id"]: r["text"] if "text" in out.columns else None for r in out.collect()}
        assert set(after) <= set(before)
        if name != "best_fit_packing":
            assert out.columns == columns
        if name == "quality_classifier":
            marks = dict(duckdb.sql(f"select doc_id, quality from {table(small, 'labels')}").fetchall())
            gone = set(before) - set(after)
            assert gone and sum(marks.get(i, 0) == 1 for i in gone) <= 1
        elif name == "line_dedup":
            assert set(after) == set(before)
        elif name == "ngram_jaccard_join":
            rule = jaccard_join.JaccardRule()
            classes = {int(i): c for i, _, c in brute_classes(list(before.items()), rule)}
            assert set(after) == {i for i, c in classes.items() if str(i) == c}
        elif name == "benchmark_decontamination":
            bench = [t[0] for t in duckdb.sql(f"select text from {table(small, 'benchmark')}").fetchall()]
            norm = lambda t: re.sub(r"[\x20\x09-\x0d]+", " ", low(t))
            leaked = {i for i, t in before.items() if any(norm(b) in norm(t) for b in bench)}
            assert not leaked & set(after) and len(set(before) - set(after) - leaked) <= 1
        else:
            assert set(after) == set(before)
        docs = out


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls in every column, rows and ids that repeat, a long text, then no rows at all, go through all stages."""
    import corpus_pipeline

    rng = random.Random(6)
    prose = lambda n: " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(n)) + "."
    passage, body = prose(40), prose(300)
    long = "\n".join(prose(20) for _ in range(2000))
    texts = [(1, body), (2, body), (2, prose(200)), (None, prose(150)), (None, body), (3, prose(100) + " " + passage + " " + prose(9)), (4, None), (5, ""), (6, long), (7, prose(120)), (7, prose(120)), (8, "\n".join(["a common line of text"] * 3 + [prose(60)]))]
    texts += [(20 + i, prose(80) + "\nA COMMON line of text \n" + prose(70)) for i in range(14)] + [(40, prose(90)), (40, prose(90))]
    rows = [(i, t, None if k % 3 else "en", None if k % 4 else "src1", None if k % 5 else 7) for k, (i, t) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, 1, 0) for i in range(1, 60)] + [(None, 0, 0), (9, None, 0), (900, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage), (None, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, schema)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        assert name == "best_fit_packing" or out.columns == docs.columns
        n, ids = out.count(), [r["doc_id"] for r in out.select("doc_id").collect()]
        if name == "quality_classifier":
            assert n == len(rows)  # all labels of these are good
        elif name == "line_dedup":
            assert n == len(rows) and out.filter("lower(text) like '%common line%'").count() == 0 and out.filter("text is null").count() == 0
        elif name == "ngram_jaccard_join":
            assert n == len(rows) - 2 and ids.count(2) == 1 and ids.count(None) == 1  # the copies of row 1 alone
        elif name == "benchmark_decontamination":
            assert n == len(rows) - 3 and 3 not in ids
        else:
            assert out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
            placed = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
            assert placed.filter("n <> end or n > 2048").count() == 0
        docs = out
    docs = spark.createDataFrame([], schema)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/none{k}")
        docs = spark.read.parquet(f"{tmp_path}/none{k}")
        assert docs.count() == 0
