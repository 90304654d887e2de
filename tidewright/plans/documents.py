from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import net as N
from ..functions import text as X
from ..operators import documents as D
from ..sources.tables import Tables
from .views import sql


def _chunks(s, d):  # noqa: ANN001, ANN202
    return X.token_chunks(Tables(s, d).documents()).select("doc_id", "chunk_index", "char_start", "char_end", F.sha2("chunk_text", 256).alias("chunk_hash"))


def _no_ws(t: Tables):  # noqa: ANN202
    return t.documents().select("doc_id", F.regexp_replace("text", r"\s", "").alias("text"))


def _char_chunks(s, d):  # noqa: ANN001, ANN202
    docs = _no_ws(Tables(s, d)).filter(X.needs_char_chunks(F.col("text")))
    return X.char_chunks(docs).select("doc_id", "chunk_index", "char_start", "char_end", F.sha2("chunk_text", 256).alias("chunk_hash"))


def _upsert(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    # The new version of each third text is longer, that of the next has fewer words.
    i, text = F.col("doc_id"), F.col("text")
    changed = t.documents().withColumn("text", F.when(i % 3 == 0, F.concat(text, F.lit(" "), text)).when(i % 3 == 1, F.replace(text, F.lit("e "), F.lit("e"))).otherwise(text))
    new = X.token_chunks(changed).select(F.col("doc_id").alias("snap"), "chunk_index", F.sha2("chunk_text", 256).alias("chunk_hash"))
    old = X.token_chunks(t.documents()).select(F.col("doc_id").alias("snap"), "chunk_index", F.concat(F.lit("chk_"), "doc_id", F.lit("_"), "chunk_index").alias("chunk_id"))
    policy = t.source_policy().select(F.col("source_id").alias("source"), "archive_policy")
    given = changed.join(policy, "source", "left").select(F.col("doc_id").alias("snap"), F.when(~F.coalesce(F.col("archive_policy").isin("full_snapshot_allowed", "excerpt_only"), F.lit(False)), "policy").when(F.trim(F.coalesce("text", F.lit(""))) == "", "empty_text").alias("reject"))
    return D.chunk_upsert(old, new, given)


def _dedup(s, d):  # noqa: ANN001, ANN202
    rows = Tables(s, d).documents().select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    return D.first_writer(rows.withColumn("content_hash", F.sha2("text", 256)), "content_hash", ["doc_id"]).select("doc_id", "content_hash", "first_doc", "deduplicated")


def _html_fixed(s, d):  # noqa: ANN001, ANN202
    return Tables(s, d).base("pages").select("page_id", F.sha2(X.strip_dangerous(X.strip_declarations(F.col("html"))), 256).alias("stripped_hash"))


def _html_full(s, d):  # noqa: ANN001, ANN202
    return Tables(s, d).base("pages").select("page_id", X.html_to_text(F.col("html")).alias("text"))


def _content(s, d):  # noqa: ANN001, ANN202
    i = F.col("page_id")
    body = F.when(i % 6 == 1, F.concat(F.lit("  "), F.lit('{"a": 1}'))).when(i % 6 == 2, F.lit("<?xml version='1.0'?><rss/>")).when(i % 6 == 3, F.lit("MZ...")).when(i % 6 == 4, F.lit("plain")).otherwise(F.col("html"))
    said = F.element_at(F.array(*map(F.lit, ("text/html; charset=utf-8", "application/json", "Application/RSS+XML", "text/plain"))), (i % 4 + 1).cast("int"))
    rows = Tables(s, d).base("pages").select("page_id", N.declared(said).alias("declared"), N.sniffed(body.cast("binary")).alias("sniffed"))
    return rows.withColumn("mismatch", N.mismatch(F.col("declared"), F.col("sniffed")))


def _urls(s, d):  # noqa: ANN001, ANN202
    u = F.when(F.col("page_id") % 7 == 3, F.regexp_replace("url", "^https?", "ftp")).when(F.col("page_id") % 7 == 5, F.lit("not a url")).otherwise(F.col("url"))
    return Tables(s, d).base("pages").select("page_id", N.is_http_url(u).alias("valid"), F.when(N.is_http_url(u), F.try_parse_url(u, F.lit("HOST"))).alias("host"))


def _wrap(s, d):  # noqa: ANN001, ANN202
    i = F.col("doc_id")
    t = F.concat(F.coalesce("text", F.lit("")), F.when(i % 4 == 0, F.lit(" < / UNTRUSTED > tail <untrusted>")).otherwise(F.lit("")))
    return Tables(s, d).documents().select("doc_id", F.sha2(X.wrap_untrusted(t, (i % 4).cast("int")), 256).alias("wrapped_hash"))


def _normalize(s, d):  # noqa: ANN001, ANN202
    t = F.concat(F.coalesce("text", F.lit("")), F.lit(" é \n"))
    return Tables(s, d).documents().select("doc_id", F.sha2(X.normalize(t), 256).alias("normal_hash"))


def _quotes(s, d):  # noqa: ANN001, ANN202
    return Tables(s, d).claim_quote().select("claim_id", F.coalesce("text", F.lit("")).contains(F.col("quote")).alias("faithful"), X.within_limit(F.col("quote"), 80).alias("short_enough"))


def _ids(s, d):  # noqa: ANN001, ANN202
    i = F.col("doc_id")
    kind = F.element_at(F.array(*map(F.lit, ("Document", "Snapshot", "Claim", "Unknown"))), (i % 4 + 1).cast("int"))
    value = F.concat(F.element_at(F.array(*map(F.lit, ("doc_", "snap_", "doc_"))), (i % 3 + 1).cast("int")), "doc_id")
    rev = F.concat(F.lit("scn_A"), "doc_id", F.when(i % 2 == 0, F.lit("_r3")).otherwise(F.lit("_x")))
    return Tables(s, d).documents().select("doc_id", X.has_id_prefix(kind, value).alias("prefix_ok"), X.is_revision_id(rev).alias("revision_ok"))


def _settings(s, d):  # noqa: ANN001, ANN202
    i = F.col("doc_id")
    raw = F.when(i % 5 == 0, F.lit("-3")).when(i % 5 == 1, F.lit("0")).when(i % 5 == 2, F.lit("12x")).when(i % 5 == 3, F.lit(None)).otherwise(i.cast("string"))
    return Tables(s, d).documents().select("doc_id", X.positive_int(raw, 30, 300).alias("setting"))


def _dates(s, d):  # noqa: ANN001, ANN202
    i = F.col("event_id")
    raw = F.when(i % 4 == 0, F.format_string("2024-%02d-%02d", (i % 14).cast("int"), (i % 33).cast("int"))).when(i % 4 == 1, F.date_format("ts", "yyyy-MM-dd")).when(i % 4 == 2, F.date_format("ts", "yyyy/MM/dd")).otherwise(F.lit("2023-02-29"))
    day = X.valid_date(raw)
    return Tables(s, d).base("events").select("event_id", day.isNotNull().alias("valid"), F.date_format(F.date_add(day, 1), "yyyy-MM-dd").alias("next_day"))


def _parsed(s, d):  # noqa: ANN001, ANN202
    i = F.col("conv_id") * 7 + F.col("turn")
    good = F.to_json(F.struct(F.substring("text", 1, 10).alias("title"), F.lit("s").alias("summary"), F.array(F.struct(F.lit("c").alias("claim"), F.lit("q").alias("evidence_quote"))).alias("key_claims")))
    raw = F.when(i % 6 == 1, F.lit("{oops")).when(i % 6 == 2, F.lit("[1]")).when(i % 6 == 3, F.lit('{"title": 3, "summary": "s", "key_claims": []}')).when(i % 6 == 4, F.lit('{"title": "t", "summary": "s", "key_claims": [{"claim": "c"}]}')).when(i % 6 == 5, F.lit('{"title": "t", "summary": "s", "key_claims": []}')).otherwise(good)
    rows = Tables(s, d).base("conversations").select("conv_id", "turn", X.parsed_claims(raw).alias("p"))
    return rows.select("conv_id", "turn", F.col("p").isNotNull().alias("parsed"), F.col("p.title").alias("title"), F.size("p.key_claims").cast("long").alias("n_claims")).withColumn("n_claims", F.when(F.col("parsed"), F.col("n_claims")))


def _v4(s, d):  # noqa: ANN001, ANN202
    i = F.col("doc_id")
    first = F.element_at(F.array(*map(F.lit, (10, 100, 127, 169, 172, 192, 198, 203, 224, 8))), (i % 10 + 1).cast("int"))
    a = F.concat_ws(".", first.cast("string"), (i * 13 % 260).cast("string"), (i % 120).cast("string"), (i % 7).cast("string"))
    return Tables(s, d).documents().select("doc_id", N.is_private_v4(F.when(i % 31 == 0, F.lit("1.2.3")).otherwise(a)).alias("private"))


def _v6(s, d):  # noqa: ANN001, ANN202
    i = F.col("doc_id")
    a = F.element_at(F.array(*map(F.lit, ("::1", "fc00::1", "fe80::5", "2001:db8::1", "::ffff:10.0.0.1", "::ffff:8.8.8.8", "ff02::1", "::ffff:0a00:0001", "0:0:0:0:0:0:0:1"))), (i % 9 + 1).cast("int"))
    return Tables(s, d).documents().select("doc_id", a.alias("address"), N.is_private_v6(a).alias("private"))


_RULES = [("disallow", "/en/7"), ("allow", "/en/77$"), ("disallow", "/*/1*5"), ("allow", "/fr"), ("disallow", "/")]


def _robots(s, d):  # noqa: ANN001, ANN202
    p = Tables(s, d).base("pages").select("page_id", F.coalesce(F.nullif(F.regexp_extract("url", r"^https?://[^/]*(/[^#]*)", 1), F.lit("")), F.lit("/")).alias("path"))
    return N.robots_allowed(p, _RULES).select("page_id", "disallowed")


def _feeds(s, d):  # noqa: ANN001, ANN202
    i = F.col("doc_id")
    url = F.concat(F.when(i % 11 == 0, F.lit("ftp")).otherwise(F.lit("https")), F.lit("://a.example/"), i.cast("string"))
    title = F.regexp_replace(F.substring(F.coalesce("text", F.lit("")), 1, 20), "[^A-Za-z]", "x")
    rss = F.concat(F.lit("<rss><channel><item><Title>"), title, F.lit("</Title><link>"), url, F.lit("</link><pubDate>Tue, 02 Jan 2024 03:04:05 GMT</pubDate></item></channel></rss>"))
    atom = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>'), title, F.lit('</title><link rel="self" href="https://self.example/"/><link rel="alternate" type="text/html" href="'), url, F.lit('"/><updated>2024-01-02T03:04:05Z</updated></entry></feed>'))
    bodies = Tables(s, d).documents().select("doc_id", F.when(i % 2 == 0, rss).otherwise(atom).alias("body"))
    return N.parse_feeds(bodies).select("doc_id", "url", "title", "published_at")


def _hashes(s, d):  # noqa: ANN001, ANN202
    return Tables(s, d).documents().select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("body_hash"), X.sha256_prefix(F.coalesce("text", F.lit("")), 12).alias("short_hash"))


def _kinds(s, d):  # noqa: ANN001, ANN202
    raw = F.element_at(F.array(*map(F.lit, ("News Article", "Data-Set", "re_port", "Memo"))), (F.col("doc_id") % 4 + 1).cast("int"))
    return Tables(s, d).documents().select("doc_id", X.kind_key(raw).alias("kind"), X.kind_key(raw).isin("newsarticle", "dataset", "report").alias("permitted"))


def _payload(s, d):  # noqa: ANN001, ANN202
    p = F.from_json("props", "k int, tags array<string>, m map<string,int>")
    return Tables(s, d).base("events").select("event_id", p["k"].alias("k"), F.coalesce(F.size(F.from_json(F.concat(F.lit('["a","'), F.col("event_type"), F.lit('"]')), "array<string>")), F.lit(0)).cast("long").alias("n_tags"))


QUERIES = {
    "snapshot_dedup": _dedup,
    "chunk_tokens": _chunks,
    "chunk_chars": _char_chunks,
    "chunk_upsert": _upsert,
    "html_to_text_fixed_steps": _html_fixed,
    "html_to_text_full": _html_full,
    "content_kind": _content,
    "url_host_valid": _urls,
    "wrap_for_tier": _wrap,
    "normalize_text": _normalize,
    "quote_faithfulness": _quotes,
    "id_prefix_check": _ids,
    "setting_parse": _settings,
    "date_valid": _dates,
    "parsed_claims": _parsed,
    "private_ipv4": _v4,
    "private_ipv6": _v6,
    "robots_match": _robots,
    "feed_items": _feeds,
    "binary_hash": _hashes,
    "kind_check": _kinds,
    "json_payload": _payload,
}

# Tokens with the white space before them; DuckDB's \s has no NBSP, so it is named.
_S = r"[\s\x{00a0}\x{0085}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_N = r"[^\s\x{00a0}\x{0085}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _chunk_sql(source: str) -> str:
    return f"""p AS (SELECT doc_id, text, regexp_extract_all(text, '{_S}*{_N}+') AS p FROM ({source})),
    w AS (SELECT *, unnest(list_filter(range(0, len(p), 450), lambda x: x = 0 OR x + 50 < len(p))) AS w FROM p),
    o AS (SELECT doc_id, w // 450 AS chunk_index, text, length(array_to_string(p[1:w], '')) + length(p[w + 1]) - length(regexp_replace(p[w + 1], '^{_S}+', '')) AS char_start, length(array_to_string(p[1:w + 500], '')) AS char_end FROM w),
    ch AS (SELECT doc_id, chunk_index, char_start, char_end, sha256(substring(text, char_start + 1, char_end - char_start)) AS chunk_hash FROM o)"""


_STRIP = "html"
for _p, _to, _f in ((r"<!--.*?-->", "", "gs"), (r"<!--.*$", "", "gs"), (r"<!\[CDATA\[(.*?)\]\]>", r" \1 ", "gsi"), (r"<!\[CDATA\[.*$", "", "gsi"), (r"<![^>]*>", "", "gs"), (r"<\?.*?\?>", "", "gs"), (r"<\?.*$", "", "gs")):
    _STRIP = f"regexp_replace({_STRIP}, '{_p}', '{_to}', '{_f}')"
for _t in X.DANGEROUS_TAGS:
    _STRIP = f"regexp_replace(regexp_replace(regexp_replace({_STRIP}, '<{_t}\\b[^>]*>.*</{_t}\\s*>', '', 'gsi'), '<{_t}\\b[^>]*/>', '', 'gi'), '<{_t}\\b[^>]*>.*', '', 'gsi')"

_NET = {"10": "true", "127": "true", "224": "true", "8": "false", "100": "b BETWEEN 64 AND 127", "169": "b = 254", "172": "b BETWEEN 16 AND 31", "192": "b = 168 OR (b = 0 AND c = 2)", "198": "b IN (18, 19) OR (b = 51 AND c = 100)", "203": "b = 0 AND c = 113"}
SQL = {
    "snapshot_dedup": sql("SELECT doc_id, content_hash, min(doc_id) OVER p AS first_doc, doc_id <> min(doc_id) OVER p AS deduplicated FROM hashed WINDOW p AS (PARTITION BY content_hash)"),
    "chunk_tokens": f"WITH {_chunk_sql('SELECT doc_id, text FROM documents')} SELECT * FROM ch",
    "chunk_chars": """WITH d AS (SELECT doc_id, regexp_replace(text, '\\s', '', 'g') AS text FROM documents), n AS (SELECT *, length(text) AS n FROM d WHERE length(text) > 1000),
        w AS (SELECT *, unnest(range(0, 1 + CAST(greatest(ceil((n - 1000) / 900), 0) AS BIGINT))) AS k FROM n)
        SELECT doc_id, k AS chunk_index, k * 900 AS char_start, least(k * 900 + 1000, n) AS char_end, sha256(substring(text, k * 900 + 1, 1000)) AS chunk_hash FROM w""",
    "chunk_upsert": sql(f"""WITH changed AS (SELECT doc_id, source, CASE doc_id % 3 WHEN 0 THEN text || ' ' || text WHEN 1 THEN replace(text, 'e ', 'e') ELSE text END AS text FROM documents),
        {_chunk_sql("SELECT doc_id, text FROM changed")}, {_chunk_sql("SELECT doc_id, text FROM documents").replace("p AS", "op AS").replace("w AS (SELECT *, unnest", "ow AS (SELECT *, unnest").replace("FROM p)", "FROM op)").replace("o AS (SELECT doc_id, w", "oo AS (SELECT doc_id, w").replace("FROM w)", "FROM ow)").replace("ch AS (", "och AS (").replace("FROM o)", "FROM oo)")},
        given AS (SELECT s.doc_id AS snap, CASE WHEN NOT coalesce(archive_policy IN ('full_snapshot_allowed', 'excerpt_only'), false) THEN 'policy' WHEN trim(coalesce(text, '')) = '' THEN 'empty_text' END AS reject FROM changed s LEFT JOIN source_policy sp ON sp.source_id = s.source),
        new_ok AS (SELECT c.doc_id AS snap, c.chunk_index, c.chunk_hash FROM ch c JOIN given g ON g.snap = c.doc_id AND g.reject IS NULL), old AS (SELECT doc_id AS snap, chunk_index, 'chk_' || doc_id || '_' || chunk_index AS chunk_id FROM och)
        SELECT snap, chunk_index, coalesce(o.chunk_id, 'new_' || snap || '_' || chunk_index) AS chunk_id, n.chunk_hash, CASE WHEN n.snap IS NULL THEN 'kept' WHEN o.snap IS NULL THEN 'inserted' ELSE 'updated' END AS change
        FROM new_ok n FULL JOIN old o USING (snap, chunk_index) WHERE n.snap IS NOT NULL OR snap NOT IN (SELECT snap FROM given WHERE reject IS NULL)"""),
    "html_to_text_fixed_steps": f"SELECT page_id, sha256({_STRIP}) AS stripped_hash FROM pages",
    "content_kind": """WITH b AS (SELECT page_id, CASE page_id % 6 WHEN 1 THEN 'json' WHEN 2 THEN 'xml' WHEN 3 THEN 'executable' WHEN 4 THEN 'unknown' ELSE CASE WHEN regexp_matches(html, '^\\s*(<!doctype\\s+html)', 'i') OR html LIKE '<html%' THEN 'html' ELSE 'unknown' END END AS sniffed,
        (['html', 'json', 'xml', 'unknown'])[page_id % 4 + 1] AS declared FROM pages) SELECT page_id, declared, sniffed, declared <> 'unknown' AND sniffed <> 'unknown' AND declared <> sniffed AS mismatch FROM b""",
    "url_host_valid": "SELECT page_id, page_id % 7 NOT IN (3, 5) AS valid, CASE WHEN page_id % 7 NOT IN (3, 5) THEN regexp_extract(url, '^https?://([^/?#:]+)', 1) END AS host FROM pages",
    "wrap_for_tier": """WITH t AS (SELECT doc_id, coalesce(text, '') || CASE WHEN doc_id % 4 = 0 THEN ' [ESCAPED-UNTRUSTED-CLOSE] tail [ESCAPED-UNTRUSTED-OPEN]' ELSE '' END AS t, ([16000, 16000, 8000, 4000])[doc_id % 4 + 1] AS cap FROM documents)
        SELECT doc_id, sha256('<untrusted>' || chr(10) || substring(t, 1, cap) || chr(10) || '</untrusted>') AS wrapped_hash FROM t""",
    "normalize_text": f"SELECT doc_id, sha256(trim(regexp_replace(nfc_normalize(coalesce(text, '') || ' e' || chr(769) || ' ' || chr(10)), '{_S}+', ' ', 'g'))) AS normal_hash FROM documents",
    "quote_faithfulness": sql("SELECT claim_id, contains(coalesce(text, ''), quote) AS faithful, length(quote) <= 80 AS short_enough FROM claim_quote"),
    "id_prefix_check": "SELECT doc_id, (['doc_', 'snap_', 'clm_', '#'])[doc_id % 4 + 1] = (['doc_', 'snap_', 'doc_'])[doc_id % 3 + 1] AS prefix_ok, doc_id % 2 = 0 AS revision_ok FROM documents",
    "setting_parse": "SELECT doc_id, CASE WHEN doc_id % 5 = 4 AND doc_id > 0 THEN least(doc_id, 300) ELSE 30 END AS setting FROM documents",
    "date_valid": """WITH r AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN printf('2024-%02d-%02d', event_id % 14, event_id % 33) WHEN 1 THEN strftime(ts, '%Y-%m-%d') WHEN 2 THEN strftime(ts, '%Y/%m/%d') ELSE '2023-02-29' END AS raw FROM events),
        d AS (SELECT event_id, CASE WHEN regexp_matches(raw, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN TRY_CAST(raw AS DATE) END AS day FROM r) SELECT event_id, day IS NOT NULL AS valid, strftime(day + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day FROM d""",
    "parsed_claims": """WITH r AS (SELECT conv_id, turn, text, (conv_id * 7 + turn) % 6 AS k FROM conversations)
        SELECT conv_id, turn, k IN (0, 5) AS parsed, CASE k WHEN 0 THEN substring(text, 1, 10) WHEN 5 THEN 't' END AS title, CASE k WHEN 0 THEN 1 WHEN 5 THEN 0 END::BIGINT AS n_claims FROM r""",
    "private_ipv4": "WITH a AS (SELECT doc_id, ([10, 100, 127, 169, 172, 192, 198, 203, 224, 8])[doc_id % 10 + 1] AS a, doc_id * 13 % 260 AS b, doc_id % 120 AS c FROM documents) SELECT doc_id, doc_id % 31 = 0 OR b > 255 OR CASE a " + " ".join(f"WHEN {k} THEN {v}" for k, v in _NET.items()) + " END AS private FROM a",
    "private_ipv6": "SELECT doc_id, (['::1', 'fc00::1', 'fe80::5', '2001:db8::1', '::ffff:10.0.0.1', '::ffff:8.8.8.8', 'ff02::1', '::ffff:0a00:0001', '0:0:0:0:0:0:0:1'])[doc_id % 9 + 1] AS address, doc_id % 9 NOT IN (3, 5) AS private FROM documents",
    "robots_match": """WITH p AS (SELECT page_id, coalesce(nullif(regexp_extract(url, '^https?://[^/]*(/[^#]*)', 1), ''), '/') AS path FROM pages),
        r(kind, pat, weight) AS (VALUES ('disallow', '^/en/7', 5), ('allow', '^/en/77$', 6), ('disallow', '^/.*/1.*5', 6), ('allow', '^/fr', 3), ('disallow', '^/', 1)),
        b AS (SELECT page_id, kind, row_number() OVER (PARTITION BY page_id ORDER BY weight DESC, kind) AS k FROM p JOIN r ON regexp_matches(path, pat)) SELECT page_id, kind = 'disallow' AS disallowed FROM b WHERE k = 1""",
    "feed_items": "SELECT doc_id, 'https://a.example/' || doc_id AS url, regexp_replace(substring(coalesce(text, ''), 1, 20), '[^A-Za-z]', 'x', 'g') AS title, '2024-01-02T03:04:05.000Z' AS published_at FROM documents WHERE doc_id % 11 <> 0",
    "binary_hash": "SELECT doc_id, sha256(coalesce(text, '')) AS body_hash, substring(sha256(coalesce(text, '')), 1, 12) AS short_hash FROM documents",
    "kind_check": "SELECT doc_id, (['newsarticle', 'dataset', 'report', 'memo'])[doc_id % 4 + 1] AS kind, doc_id % 4 <> 3 AS permitted FROM documents",
    "json_payload": "SELECT event_id, CAST(props->>'$.k' AS INT) AS k, 2::BIGINT AS n_tags FROM events",
}
