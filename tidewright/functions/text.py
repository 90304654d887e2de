"""Text functions: hashes, chunks, HTML to text, wrapping, ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import markup
from .batches import text_runs
from .markup import DANGEROUS_TAGS, decode_entities  # noqa: F401

TIER_CHARS = {0: 16_000, 1: 16_000, 2: 8_000, 3: 4_000}


def _in_runs(f: Callable[[str], str], batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for values in text_runs(batch):
            yield pa.array([None if v is None else f(v) for v in values.to_pylist()], pa.string())


def _mapped(f: Callable[[str], str], of: Column) -> Column:
    """A function of one string, over runs of Arrow batches; nulls stay null."""

    @F.arrow_udf(T.StringType())  # type: ignore[call-overload]
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _in_runs(f, batches)

    return run(of)


def strip_declarations(html: Column) -> Column:
    """Comments, CDATA marks, doctypes and instructions; what is not closed goes to the end."""
    return F.coalesce(_mapped(markup.strip_declarations, F.when(html.contains("<"), html)), html)


def strip_dangerous(html: Column) -> Column:
    """Elements that carry code: from a kind's first opening to its last closing, or a lone one (to the end, if it does not close itself)."""
    return F.coalesce(_mapped(markup.strip_dangerous, F.when(html.contains("<"), html)), html)


def html_to_text(html: Column) -> Column:
    """Plain text of a page; only pages with markup or entities leave the JVM."""
    html = F.coalesce(html, F.lit(""))
    text = F.coalesce(_mapped(markup.to_text, F.when(html.contains("<") | html.contains("&"), html)), html)
    return F.btrim(F.regexp_replace(text, r"(?U)[\s\x{feff}]++", " "))


def normalize(text: Column) -> Column:
    """NFC (only texts that are not all ASCII are sent for it), runs of white space as one blank, none at the ends."""
    composed = F.coalesce(_mapped(markup.compose, F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)
    return F.btrim(F.regexp_replace(composed, r"(?U)[\s\x{feff}]+", " "))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def sha256_prefix(text: Column, n: int) -> Column:
    return F.substring(F.sha2(text, 256), 1, n)


def within_limit(text: Column, n: int) -> Column:
    """Code points, not bytes or UTF-16 units."""
    return F.length(text) <= n


def token_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 500, step: int = 450) -> DataFrame:
    """Overlapping windows of ``\\S+`` tokens with offsets into the text (in code points); a text without tokens has none.

    Each token carries the white space before it, so that lengths add up to offsets.
    They are added up once for each ``step`` tokens; a window adds these sums, and joins
    its own tokens only.
    """
    pieces = docs.select(F.col(id_col), F.regexp_extract_all(F.col(text_col), F.lit(r"(?U)\s*\S+"), F.lit(0)).alias("__p")).filter(F.size("__p") > 0)
    added = lambda lengths: F.aggregate(lengths, F.lit(0), lambda z, x: z + x)
    starts = F.sequence(F.lit(0), F.size("__p") - 1, F.lit(step))
    sums = F.transform(starts, lambda w: added(F.transform(F.slice("__p", w + 1, F.lit(step)), F.length)))
    kept = F.filter(starts, lambda w: (w == 0) | (w + (size - step) < F.size("__p")))
    joined = F.transform(kept, lambda w: F.array_join(F.slice("__p", w + 1, F.lit(size)), ""))
    rows = pieces.select(id_col, sums.alias("__sums"), joined.alias("__joined"))
    windows = F.transform("__joined", lambda t, k: F.struct(added(F.slice("__sums", F.lit(1), k)).alias("before"), t.alias("t"), (F.length(t) - F.length(F.regexp_replace(t, r"^(?U)\s+", ""))).alias("lead")))
    rows = rows.select(id_col, F.posexplode(windows).alias("chunk_index", "w"))
    before, lead, text = F.col("w.before"), F.col("w.lead"), F.col("w.t")
    return rows.select(id_col, F.col("chunk_index").cast("long").alias("chunk_index"), (before + lead).cast("long").alias("char_start"), (before + F.length(text)).cast("long").alias("char_end"), F.substring(text, lead + 1, F.length(text)).alias("chunk_text"))


def char_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 1000, step: int = 900) -> DataFrame:
    """Overlapping windows of characters from the first that is not blank, for texts that hardly have blanks."""
    start = F.length(F.col(text_col)) - F.length(F.regexp_replace(F.col(text_col), r"^(?U)\s+", ""))
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"), start.alias("__a"), F.length(text_col).alias("__n")).filter("__a < __n")
    rows = rows.select(id_col, "__text", "__n", F.posexplode(F.expr(f"sequence(__a, __a + greatest(ceil((__n - __a - {size}) / {step}), 0) * {step}, {step})")).alias("chunk_index", "s"))
    return rows.select(id_col, F.col("chunk_index").cast("long").alias("chunk_index"), F.col("s").cast("long").alias("char_start"), F.least(F.col("s") + size, "__n").cast("long").alias("char_end"), F.substring(F.col("__text"), (F.col("s") + 1).cast("int"), F.lit(size)).alias("chunk_text"))


def needs_char_chunks(text: Column, over: int = 1000, share: float = 0.02) -> Column:
    trimmed = F.length(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""))
    return (trimmed > over) & (F.size(F.regexp_extract_all(text, F.lit(r"(?U)\S+"), F.lit(0))) / trimmed < share)


def wrap_untrusted(text: Column, tier: Column, caps: Mapping[int, int] = TIER_CHARS) -> Column:
    """Escapes the marks of untrusted text, however spaced or cased, cuts to the tier's length and wraps."""
    out = F.regexp_replace(text, r"(?i)<\s*/\s*untrusted\s*>", "[ESCAPED-UNTRUSTED-CLOSE]")
    out = F.regexp_replace(out, r"(?i)<\s*untrusted\s*>", "[ESCAPED-UNTRUSTED-OPEN]")
    cap = F.lit(None).cast("int")
    for k, n in caps.items():
        cap = F.when(tier == k, n).otherwise(cap)
    return F.concat(F.lit("<untrusted>\n"), F.substring(out, F.lit(1), cap), F.lit("\n</untrusted>"))


# Object types and the prefixes of their ids.
ID_PREFIXES = {
    "Source": "src_", "Document": "doc_", "Snapshot": "snap_", "Claim": "clm_", "Dossier": "dos_", "Scenario": "scn_", "EditorialIntent": "eit_", "Thesis": "ths_", "ContentDraft": "drf_",
    "Publication": "pub_", "EdgeRelation": "edge_", "Run": "run_", "AccessIntervention": "aci_", "ManualClaimEntry": "mcl_", "DerivedMetric": "met_", "PolicyDecision": "pdec_",
    "PolicyLearningEvent": "ple_", "SourcePolicyRule": "spr_", "DatasetVintage": "dvnt_", "MetricsRun": "mrun_", "MetricAlert": "malt_", "EvaluationRun": "eval_", "EvaluationCase": "ecase_",
    "RetrievalPackMetric": "rpm_", "CrossVendorReview": "cvr_", "ResearchSession": "sess_", "RawCacheItem": "rcache_",
}


def has_id_prefix(kind: Column, value: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in ID_PREFIXES.items() for x in pair))
    return F.coalesce(F.startswith(value, F.try_element_at(table, kind)), F.lit(False))


def is_revision_id(value: Column) -> Column:
    return value.rlike(r"(?i)^scn_[A-Z0-9]+_r[0-9]+$")


def positive_int(value: Column, fallback: int, most: int | None = None) -> Column:
    """A setting: whole digits above 0, not above ``most``; anything else is the fallback."""
    n = F.when(value.rlike(r"^[0-9]{1,15}$"), value.try_cast("bigint"))
    n = F.when(n > 0, n).otherwise(F.lit(fallback).cast("bigint"))
    return n if most is None else F.least(n, F.lit(most).cast("bigint"))


def valid_date(value: Column) -> Column:
    """A day of the calendar as YYYY-MM-DD, or null."""
    return F.when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(value, "yyyy-MM-dd"))


def kind_key(value: Column) -> Column:
    return F.regexp_replace(F.lower(value), "[^a-z0-9]", "")


def parsed_claims(raw: Column) -> Column:
    """``title, summary, key_claims`` where the JSON has exactly strings there and a list of claims; else null.

    Types are read from VARIANT, so that a number is not taken for a string.
    """
    v = F.try_parse_json(raw)
    kind = lambda p: F.schema_of_variant(F.try_variant_get(v, p, "variant"))
    claims = F.try_variant_get(v, "$.key_claims", "array<variant>")
    part = lambda c, p: F.try_variant_get(c, p, "variant")
    good = F.forall(claims, lambda c: F.coalesce((F.schema_of_variant(part(c, "$.claim")) == "STRING") & (F.schema_of_variant(part(c, "$.evidence_quote")) == "STRING"), F.lit(False)))
    ok = (kind("$.title") == "STRING") & (kind("$.summary") == "STRING") & good
    return F.when(
        F.coalesce(ok, F.lit(False)),
        F.struct(
            F.try_variant_get(v, "$.title", "string").alias("title"),
            F.try_variant_get(v, "$.summary", "string").alias("summary"),
            F.transform(claims, lambda c: F.struct(F.try_variant_get(c, "$.claim", "string").alias("claim"), F.try_variant_get(c, "$.evidence_quote", "string").alias("evidence_quote"))).alias("key_claims"),
        ),
    )
