"""Literal cases of the text and network functions."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewright.functions import markup
from tidewright.functions import net as N
from tidewright.functions import text as X


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""),
        ("", ""),
        ("<p>Hello <b>world</b></p>", "Hello world"),
        ("a<script>x</script>b<script>y</script>c", "ac"),
        ("keep<script>bad and the rest", "keep"),
        ("1 &lt; 2 &gt; 0", "1 < 2 > 0"),
        ("a &amp;lt;script&amp;gt;evil&amp;lt;/script&amp;gt; b", "a b"),
        ("&AMP;lt;b&AMP;gt;bold", "bold"),
        ("x&#60script&#62evil", "x"),
        ("&#x41;&#66;C&nbsp;&nbsp;D", "ABC D"),
        ("<!-- gone --><![CDATA[kept]]> <!DOCTYPE html>t", "kept t"),
        ("a<!-- open to the end", "a"),
        ("<img alt='>'>cap", "cap"),
        ('<img alt="Inj>Caption', "Caption"),
        ("<style>p{}</style>  x ", "x"),
        ("&#1114112;&#0065;", "A"),
        ("a&#" + "9" * 5000 + ";b&#x" + "F" * 5000 + ";c&#" + "0" * 5000 + "65;", "abcA"),
        ("&Lt;i&Lt;", "&Lt;i&Lt;"),
        ("&LTb&gtx&amp;quot;", 'x"'),
        ("&#38;lt;p&#62;q", "q"),
        ("<scr<script>x</script>ipt>evil", ""),
        ("a<script/>b<embed src=x>c", "ab"),
        ("a<object></object>b</object>c", "ac"),
        (None, ""),
    ],
)
def test_html_to_text(spark, html, want):
    assert one(spark, html, X.html_to_text) == want


def test_entities_never_settling_is_bounded():
    assert X.decode_entities("&" + "amp;" * 60 + "lt;") == "<"
    assert X.decode_entities("&" + "amp;" * 200 + "lt;") in ("", "<")


def test_chunks_of_a_long_text(spark):
    """Offsets against plain code, with all kinds of blanks."""
    import random
    import re

    rng = random.Random(1)
    text = "".join(rng.choice(["w", "élan", "x1"]) * rng.randint(1, 3) + rng.choice([" ", "  ", "\n", "\t ", "\u2003"]) for _ in range(4000))
    docs = spark.createDataFrame([(1, " \n" + text), (2, text.strip())], "doc_id long, text string")
    want = []
    for i, t in ((1, " \n" + text), (2, text.strip())):
        m = list(re.finditer(r"\S+", t))
        for k, w in enumerate(range(0, len(m), 450)):
            if w == 0 or w + 50 < len(m):
                a, b = m[w].start(), m[min(w + 500, len(m)) - 1].end()
                want.append((i, k, a, b, t[a:b]))
    assert sorted(map(tuple, X.token_chunks(docs).collect())) == want


def test_chunks(spark):
    words = lambda n: " ".join(f"w{i}" for i in range(n))
    docs = spark.createDataFrame([(1, words(500)), (2, words(501)), (3, ""), (4, None), (5, "  a   b ")], "doc_id long, text string")
    got = {}
    for r in X.token_chunks(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert {k: len(v) for k, v in got.items()} == {1: 1, 2: 2, 5: 1}
    assert got[2][1]["chunk_text"].startswith("w450 ") and got[2][1]["chunk_text"].endswith("w500")
    assert got[5][0]["chunk_text"] == "a   b" and got[5][0]["char_start"] == 2
    long = spark.createDataFrame([(1, " " + "x" * 2500)], "doc_id long, text string")
    assert long.select(X.needs_char_chunks(F.col("text"))).first()[0]
    assert [(r["char_start"], r["char_end"]) for r in X.char_chunks(long).collect()] == [(1, 1001), (901, 1901), (1801, 2501)]


def test_hash_and_limits(spark):
    assert one(spark, "", X.sha256) == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert one(spark, "\U0001f600a", lambda c: X.within_limit(c, 2)) is True
    assert one(spark, "é  x\n", X.normalize) == "é x"


def test_wrapping(spark):
    got = one(spark, "a < / UnTrusted > b <untrusted>", lambda c: X.wrap_untrusted(c, F.lit(3)))
    assert got == "<untrusted>\na [ESCAPED-UNTRUSTED-CLOSE] b [ESCAPED-UNTRUSTED-OPEN]\n</untrusted>"
    assert len(one(spark, "x" * 9000, lambda c: X.wrap_untrusted(c, F.lit(3)))) == 4000 + len("<untrusted>\n\n</untrusted>")


@pytest.mark.parametrize(("raw", "ok"), [('{"title":"t","summary":"s","key_claims":[]}', True), ('{"title":1,"summary":"s","key_claims":[]}', False), ("[1]", False), ("{", False), (None, False), ('{"title":"t","summary":"s","key_claims":[{"claim":"c","evidence_quote":2}]}', False)])
def test_parsed_claims(spark, raw, ok):
    assert (one(spark, raw, X.parsed_claims) is not None) is ok


@pytest.mark.parametrize(("address", "private"), [("10.1.2.3", True), ("8.8.8.8", False), ("100.64.0.1", True), ("172.32.0.1", False), ("1.2.3", True), ("1.2.3.256", True), ("255.1.1.1", True)])
def test_private_v4(spark, address, private):
    assert one(spark, address, N.is_private_v4) is private


@pytest.mark.parametrize(("address", "private"), [("::1", True), ("::", True), ("fd12::1", True), ("fe80::1", True), ("2001:4860::8888", False), ("::ffff:10.0.0.1", True), ("::ffff:8.8.8.8", False), ("[::1]", True)])
def test_private_v6(address, private):
    assert N.private_v6(address) is private


def test_rule_paths():
    assert [N.decode_path(p) for p in ("/a%62c", "/x%2Fy%3f%23", "/%C3%A9", "%2f%41%2F", "")] == ["/abc", "/x%2Fy%3f%23", "/é", "%2fA%2F", ""]


def test_robots(spark):
    text = "User-agent: *\n\nDisallow: /\n\nUser-agent: bot\nDisallow: /private\nAllow: /private/ok$\n"
    assert N.parse_robots(text, "bot/1.0") == [("disallow", "/private"), ("allow", "/private/ok$")]
    assert N.parse_robots(text, "other/2") == [("disallow", "/")]
    paths = spark.createDataFrame([("/private/x",), ("/private/ok",), ("/private/ok2",), ("/robots.txt",), ("/pub",)], "path string")
    got = {r["path"]: r["disallowed"] for r in N.robots_allowed(paths, N.parse_robots(text, "bot")).collect()}
    assert got == {"/private/x": True, "/private/ok": False, "/private/ok2": True, "/robots.txt": False, "/pub": False}
    both = N.robots_allowed(paths, [("disallow", "/p*"), ("allow", "/p*")]).filter("disallowed").count()
    assert both == 0


def test_feeds():
    rss = "<rss><channel><item><title>T</title><guid isPermaLink='true'>https://a/1</guid></item><item><guid isPermaLink='false'>x</guid></item></channel></rss>"
    assert N.feed_items(rss) == [("https://a/1", "T", None)]
    atom = "<feed xmlns='http://www.w3.org/2005/Atom'><entry><link rel='self' href='https://s/'/><link rel='related' href='https://r/'/><link href='https://b/2' type='text/html'/><updated>2024</updated></entry></feed>"
    assert N.feed_items(atom) == [("https://b/2", None, "2024")]
    assert N.feed_items("<rss") == [] and N.feed_items(None) == [] and N.feed_items("<!DOCTYPE x [<!ENTITY a 'b'>]><rss/>") == []


@pytest.mark.parametrize(("raw", "want"), [("Tue, 02 Jan 2024 03:04:05 GMT", "2024-01-02T03:04:05.000Z"), ("2024-01-02T03:04:05+01:00", "2024-01-02T02:04:05.000Z"), ("2024-01-02T03:04:05.250Z", "2024-01-02T03:04:05.250Z"), ("soon", None), (None, None)])
def test_feed_dates(spark, raw, want):
    assert one(spark, raw, N.feed_date) == want


def test_sniffing(spark):
    cases = {b"\x7fELF..": "executable", b"MZ": "executable", b"  <?xml": "xml", b" {": "json", b"<!DOCTYPE  html>": "html", b"<html>": "html", b"": "unknown"}
    for body, want in cases.items():
        assert one(spark, bytearray(body), N.sniffed, "binary") == want
    assert one(spark, "text/xml; q", lambda c: N.charset(F.lit("text/html; charset=ISO-8859-1"), c)) == "iso-8859-1"
    for said, want in (("x; charset='UTF-8'", "utf-8"), ('x; charset="euc-kr";a=b', "euc-kr"), ("x; charset=utf-8\"", "utf-8"), ("x; charset=", "big5"), (None, "big5"), ("x", "big5")):
        assert one(spark, " <?xml version='1.0' encoding='Big5'?>", lambda c, said=said: N.charset(F.lit(said), c)) == want


def test_pages_leave_a_batch_in_runs(spark):
    """Python holds a run of a batch at a time, and rows stay in place over runs, nulls, empty and very long pages."""
    pages = [None if i % 11 == 3 else "" if i % 11 == 5 else f"<p>{i} &amp; {'x' * (i % 7) * 300}</p>" for i in range(3000)]
    pages[17] = "<b>" + "y" * 3_000_000
    parts = list(X._in_runs(markup.to_text, iter([pa.array(pages), pa.array([], pa.string())])))
    assert len(parts) > 4 and max(p.nbytes for p in parts if len(p) > 1) <= 1 << 20
    assert [v for p in parts for v in p.to_pylist()] == [None if p is None else markup.to_text(p) for p in pages]
    got = spark.createDataFrame(list(enumerate(pages)), "i int, html string").coalesce(1).select("i", X.html_to_text(F.col("html")).alias("text")).collect()
    assert {r.i: r.text for r in got} == {i: " ".join(markup.to_text(p or "").split()) for i, p in enumerate(pages)}


def test_shingles_are_hashed_in_small_runs():
    """What the hashes of a batch take at a time does not follow the batch, and where its texts are cut changes nothing."""
    import tracemalloc

    from tidewright.functions import words

    text = " ".join(f"word{k * k % 977}" for k in range(500))
    texts = pa.array([f"{i} {text}" if i % 9 else None for i in range(2000)])
    alone = [next(words.shingle_sets(texts.slice(i, 1), 3)).tolist() for i in range(60)]
    tracemalloc.start()
    first = []
    for i, g in enumerate(words.shingle_sets(texts, 3)):
        if i < 60:
            first.append(g.tolist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert first == alone and peak < 20e6
