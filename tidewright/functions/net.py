"""Addresses, content kinds, robots rules, feeds and dates."""

from __future__ import annotations

import ipaddress
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Signatures of executables, and networks that are not public.
EXECUTABLES = ("7F454C46", "4D5A", "CAFEBABE", "FEEDFACE", "CEFAEDFE", "FEEDFACF", "CFFAEDFE")
PRIVATE_V4 = (
    "0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.2.0/24", "192.168.0.0/16",
    "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4",
)
PRIVATE_V6 = ("::1/128", "::/128", "fc00::/7", "fe80::/10", "ff00::/8")
XML_TYPES = ("application/rss+xml", "application/atom+xml", "application/xml", "text/xml")
JSON_TYPES = ("application/feed+json", "application/json")


def is_private_v4(address: Column) -> Column:
    """Also true for anything that is no IPv4 address."""
    parts = F.split(address, r"\.")
    octets = F.transform(parts, lambda p: F.when(p.rlike(r"^[0-9]{1,3}$"), p.try_cast("int")))
    number = F.aggregate(octets, F.lit(0).cast("bigint"), lambda a, x: a * 256 + x)
    sound = (F.size(parts) == 4) & F.forall(octets, lambda x: F.coalesce((x >= 0) & (x <= 255), F.lit(False)))
    inside = F.lit(False)
    for net in map(ipaddress.IPv4Network, PRIVATE_V4):
        inside = inside | number.between(int(net.network_address), int(net.broadcast_address))
    return F.when(F.coalesce(sound, F.lit(False)), inside).otherwise(True)


def private_v6(address: str) -> bool:
    try:
        ip = ipaddress.IPv6Address(address.strip("[]"))
    except ValueError:
        return False
    if ip.ipv4_mapped is not None:
        return any(ip.ipv4_mapped in ipaddress.IPv4Network(n) for n in PRIVATE_V4)
    return any(ip in ipaddress.IPv6Network(n) for n in PRIVATE_V6)


@F.pandas_udf(T.BooleanType())  # type: ignore[call-overload]
def is_private_v6(addresses):  # noqa: ANN001, ANN202
    return addresses.map(private_v6)


def sniffed(body: Column) -> Column:
    """What the first bytes of a BINARY body are."""
    start = F.hex(F.substring(body, 1, 4))
    head = F.regexp_replace(F.decode(F.substring(body, 1, 512), "iso-8859-1"), r"^(?U)\s+", "")
    out = F.when(F.expr("false"), "")
    for magic in EXECUTABLES:
        out = out.when(F.startswith(start, F.lit(magic)), "executable")
    return (
        out.when(head.rlike(r"^<(\?xml|rss|feed)"), "xml")
        .when(head.rlike(r"^[{\[]"), "json")
        .when(head.rlike(r"^((?i:<!doctype\s+html)|<html)"), "html")
        .otherwise("unknown")
    )


def declared(content_type: Column) -> Column:
    mime = F.lower(F.trim(F.substring_index(content_type, ";", 1)))
    return F.when(mime.isin(*XML_TYPES), "xml").when(mime.isin(*JSON_TYPES), "json").when(mime == "text/html", "html").otherwise("unknown")


def mismatch(declared_kind: Column, sniffed_kind: Column) -> Column:
    return (declared_kind != "unknown") & (sniffed_kind != "unknown") & (declared_kind != sniffed_kind)


def is_http_url(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("PROTOCOL")).isin("http", "https") & F.try_parse_url(url, F.lit("HOST")).isNotNull(), F.lit(False))


def feed_date(raw: Column) -> Column:
    """ISO 8601 or RFC 822 dates as UTC text, or null."""
    plain = F.regexp_replace(F.trim(raw), r"^[A-Za-z]{3},\s*", "")
    plain = F.regexp_replace(plain, r"(GMT|UTC|UT|Z)$", "+0000")
    formats = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z", "yyyy-MM-dd'T'HH:mm:ssZ", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSZ", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd")
    ts = F.coalesce(*(F.try_to_timestamp(plain, F.lit(f)) for f in formats))
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


# ---- robots -----------------------------------------------------------------


_KEPT_CODES = re.compile("(%(?:2F|3F|23))", re.I)


def decode_path(text: str) -> str:
    """Percent codes as the UTF-8 that they spell, but for those of ``/``, ``?`` and ``#``."""
    parts = _KEPT_CODES.split(text)  # each second part is a code to keep
    parts[::2] = map(unquote, parts[::2])
    return "".join(parts)


def parse_robots(text: str, agent: str) -> list[tuple[str, str]]:
    """``(kind, rule)`` that hold for an agent: its own groups if there are any, else those of ``*``."""
    token = re.split(r"[\s/]", agent.lower())[0]
    groups: list[tuple[set[str], list[tuple[str, str]]]] = []
    names_open = gap = False
    for raw in re.split(r"\r?\n", text):
        line = raw.partition("#")[0].strip()
        if not line:
            gap = True
            continue
        key, colon, value = (x.strip() for x in line.partition(":"))
        key = key.lower()
        if colon and key == "user-agent":
            if gap or not names_open:
                groups.append((set(), []))
            groups[-1][0].add(value.lower())
            names_open = True
        elif colon and key in ("allow", "disallow"):
            names_open = False
            if value and groups:
                groups[-1][1].append((key, value))
        elif colon:
            continue
        gap = False
    own = [g for g in groups if any(n == token or n.startswith(token + "/") for n in g[0])]
    return [r for g in own or [g for g in groups if "*" in g[0]] for r in g[1]]


def rule_pattern(rule: str) -> tuple[str, int]:
    """The rule as a regular expression at the start of a path, and its weight."""
    end, base = rule.endswith("$"), rule.removesuffix("$")
    body = ".*".join("".join(c if c.isalnum() or c in "/_-~%" else "\\" + c for c in decode_path(part)) for part in base.split("*"))
    return f"^{body}" + ("$" if end else ""), len(decode_path(base))


def robots_allowed(paths: DataFrame, rules: Iterable[tuple[str, str]], path_col: str = "path") -> DataFrame:
    """Adds ``disallowed``: the longest rule that matches decides, allowing on a tie. The rules are one site's file."""
    best = F.struct(F.lit(-1).alias("weight"), F.lit(True).alias("allow"))
    for kind, rule in rules:
        pattern, weight = rule_pattern(rule)
        best = F.greatest(best, F.when(F.col("__path").rlike(pattern), F.struct(F.lit(weight).alias("weight"), F.lit(kind == "allow").alias("allow"))))
    decoded = F.regexp_replace(F.try_url_decode(F.regexp_replace(F.regexp_replace(F.col(path_col), r"(?i)%(2F|3F|23)", "%25$1"), r"\+", "%2B")), "^$", "/")
    free = F.col(path_col).rlike(r"^/robots\.txt($|\?)")
    out = paths.withColumn("__path", F.coalesce(decoded, F.col(path_col)))
    return out.withColumn("disallowed", ~free & ~best["allow"]).drop("__path")


# ---- feeds ------------------------------------------------------------------


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1].lower()


def _text(item: ET.Element, name: str) -> str | None:
    for child in item:
        if _local(child.tag) == name:
            return (child.text or "").strip() or None
    return None


def feed_items(xml: str | None) -> list[tuple[str, str | None, str | None]]:
    """``(url, title, date as written)`` of RSS 2.0 or Atom; entities that the document defines are refused."""
    if not xml or "<!ENTITY" in xml.upper():
        return []
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return []
    kind = _local(root.tag)
    entries = [e for e in root.iter() if _local(e.tag) == ("item" if kind == "rss" else "entry")] if kind in ("rss", "feed") else []
    out = []
    for entry in entries:
        if kind == "rss":
            url = _text(entry, "link")
            if not url:
                url = next(((c.text or "").strip() for c in entry if _local(c.tag) == "guid" and c.get("isPermaLink") != "false"), None)
            date = _text(entry, "pubdate")
        else:
            links = [c for c in entry if _local(c.tag) == "link"]
            if len(links) > 1:
                links = [c for c in links if c.get("rel") != "self"]
                web = lambda c: not c.get("type") or "html" in c.get("type", "").lower()
                links.sort(key=lambda c: (c.get("rel", "alternate") != "alternate", not web(c)) if c.get("rel", "alternate") == "alternate" else (True, False))
            url = ((links[0].get("href") or links[0].text or "").strip() or None) if links else None
            date = _text(entry, "published") or _text(entry, "updated")
        if url:
            out.append((url, _text(entry, "title"), date))
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("url", "title", "raw_date")])))  # type: ignore[call-overload]
def _parsed(bodies):  # noqa: ANN001, ANN202
    return bodies.map(lambda b: [{"url": u, "title": t, "raw_date": d} for u, t, d in feed_items(b)])


def parse_feeds(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """One row for each item with a web address, in the order of its feed."""
    rows = bodies.select(*(c for c in bodies.columns if c != body_col), F.posexplode(_parsed(body_col)).alias("position", "item"))
    rows = rows.withColumns({"url": F.col("item.url"), "title": F.col("item.title"), "published_at": feed_date(F.col("item.raw_date"))})
    return rows.filter(is_http_url(F.col("url"))).drop("item")


def charset(content_type: Column, head: Column) -> Column:
    """From the header, else from the prolog in the first 200 bytes, else UTF-8."""
    said = F.nullif(F.regexp_extract(content_type, r"""(?i)charset=[^\w\s;]*([\w.+-]*[\w])""", 1), F.lit(""))
    prolog = F.nullif(F.regexp_extract(F.substring(head, 1, 200), r"""(?i)<\?xml[^?>]*encoding=["']([^"']+)["']""", 1), F.lit(""))
    return F.lower(F.coalesce(said, prolog, F.lit("utf-8")))
