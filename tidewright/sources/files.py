"""Files as tables: stored objects, notes with front matter, and the routing configuration."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import markup
from ..functions.text import kind_key
from ..operators.audit import KEY_PREFIXES, matched_prefix


def objects(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root`` as ``key, content, sha256, permitted``; keys are relative, and judged by the prefix list."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    key = F.regexp_replace("path", "^.*?" + re.escape(root.split(":", 1)[-1].strip("/")) + "/", "")
    return files.select(key.alias("key"), "content", F.sha2("content", 256).alias("sha256")).withColumn("permitted", matched_prefix(F.col("key")).isNotNull())


def _place(spark: SparkSession, root: str, key: str):  # noqa: ANN202
    """The file system and path of a permitted key; any other is refused."""
    if not key.startswith(KEY_PREFIXES) or ".." in key.split("/"):
        raise ValueError(f"{key}: no permitted prefix")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{key}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def put(spark: SparkSession, root: str, key: str, data: bytes) -> str:
    """Stores one object, over what the key had, and returns its SHA-256."""
    files, path = _place(spark, root, key)
    out = files.create(path, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return hashlib.sha256(data).hexdigest()


def delete(spark: SparkSession, root: str, key: str) -> bool:
    """Removes one object; whether it was there."""
    files, path = _place(spark, root, key)
    return bool(files.delete(path, False))


# Labels that the web takes for Windows-1252, and what its bytes from 0x80 to 0x9F stand for (U+0081 and four others as they are).
WESTERN = ("ascii", "us-ascii", "iso-8859-1", "iso8859-1", "iso88591", "iso_8859-1", "latin1", "l1", "cp1252", "x-cp1252", "windows-1252")
_WESTERN_BYTES = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
_WESTERN_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
#: Labels that the engine decodes itself.
_NATIVE = {"utf-8": "utf-8", "utf8": "utf-8", "utf-16": "utf-16le", "utf-16le": "utf-16le", "utf-16be": "utf-16be"}
#: Other labels of the web, by the codec that reads them in Python.
_OTHER = {
    "euc-kr": "cp949", "ks_c_5601-1987": "cp949", "korean": "cp949", "windows-949": "cp949", "euc-jp": "euc_jp", "shift_jis": "cp932", "shift-jis": "cp932", "sjis": "cp932", "iso-2022-jp": "iso2022_jp", "big5": "big5hkscs", "gbk": "gb18030", "gb2312": "gb18030", "gb18030": "gb18030",
    "koi8-r": "koi8_r", "koi8-u": "koi8_u", "macintosh": "mac_roman", "iso-8859-9": "cp1254", "latin5": "cp1254", **{f"iso-8859-{n}": f"iso8859_{n}" for n in (2, 3, 4, 5, 6, 7, 8, 10, 13, 14, 15, 16)}, **{f"windows-{n}": f"cp{n}" for n in (1250, 1251, 1253, 1254, 1255, 1256, 1257, 1258)},
}


@F.pandas_udf(T.StringType())  # type: ignore[call-overload]
def _by_codec(bodies, codecs):  # noqa: ANN001, ANN202
    import pandas as pd

    return pd.Series([None if b is None or c is None else bytes(b).decode(c, "replace") for b, c in zip(bodies, codecs, strict=True)], dtype=object)


def decoded(content: Column, charset: Column) -> Column:
    """Text of a body in a charset of the web, by its label; a label that is none of them is an error of the query.

    UTF-8, UTF-16 and the western labels are read by the engine; only bodies in other
    charsets are sent to Python. Bytes that mean nothing become U+FFFD, a byte-order
    mark goes.
    """
    label = F.lower(F.trim(charset))
    codec = F.lit(None).cast("string")
    for name, own in _OTHER.items():
        codec = F.when(label == name, F.lit(own)).otherwise(codec)
    known = label.isin(*WESTERN, *_NATIVE, *_OTHER)
    out = F.when(label.isNotNull() & ~known, F.raise_error(F.concat(F.lit("unknown charset "), charset)))
    out = out.when(label.isin(*WESTERN), F.translate(F.decode(content, "iso-8859-1"), _WESTERN_BYTES, _WESTERN_CHARS))
    for name, own in _NATIVE.items():
        # What is no UTF-8 is replaced when it is made valid, not when it is cast.
        out = out.when(label == name, F.make_valid_utf8(content.cast("string")) if own == "utf-8" else F.decode(content, own))
    out = out.otherwise(_by_codec(F.when(codec.isNotNull(), content), codec))
    return F.regexp_replace(out, r"^\x{FEFF}", "")


@F.pandas_udf(T.StringType())  # type: ignore[call-overload]
def _front_matter(texts):  # noqa: ANN001, ANN202
    import json

    import yaml

    def read(text: str | None) -> str | None:
        try:
            found = yaml.safe_load(text) if text else None
        except yaml.YAMLError:
            return None
        return json.dumps(found, default=str) if isinstance(found, dict) else None

    return texts.map(read)


def notes(spark: SparkSession, root: str, kinds: Iterable[str] = ("article", "dataset", "report")) -> DataFrame:
    """Markdown and JSONL files with their front matter as JSON text, the body, and whether its kind is permitted."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.{md,mdx,jsonl}").select(F.col("_metadata.file_path").alias("path"), "value")
    head = F.regexp_extract("value", r"(?s)\A---\r?\n(.*?)\r?\n---(?:\r?\n|\z)", 1)
    out = files.select("path", F.when(head != "", _front_matter(head)).alias("front"), F.regexp_replace("value", r"(?s)\A---\r?\n.*?\r?\n---(?:\r?\n|\z)", "").alias("body"))
    kind = kind_key(F.get_json_object("front", "$.kind"))
    return out.withColumn("kind", kind).withColumn("permitted", F.coalesce(kind.isin(*kinds), F.lit(False)))


@F.arrow_udf(T.StringType())  # type: ignore[call-overload]
def _bare(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else markup.bare_code(t) for t in texts.to_pylist()], pa.string())


def bare_code(code: Column) -> Column:
    """Source text without comments and string literals; line breaks stay, so that line numbers hold."""
    return _bare(code)


def reference_problems(refs: DataFrame, files: DataFrame) -> DataFrame:
    """What is wrong with references ``(ref)`` of the form ``path:line`` or ``path:export`` into ``files(path, text)``; good ones are left out."""
    cut = F.length("ref") - F.locate(":", F.reverse("ref")) + 1
    rows = refs.select("ref", F.substring(F.col("ref"), F.lit(1), cut - 1).alias("path"), F.substring(F.col("ref"), cut + 1, F.length("ref")).alias("tail"))
    known = files.select("path", "text", F.size(F.split(F.regexp_replace("text", "\n\\z", ""), "\n")).alias("lines"), bare_code(F.col("text")).alias("bare"))
    j = rows.join(known, "path", "left")
    number = F.when(F.col("tail").rlike(r"^[0-9]{1,9}$"), F.col("tail").try_cast("int"))
    name = F.regexp_replace("tail", r"([^\p{L}\p{N}_])", r"\\$1")
    # An export under its own name, by declaration or in a list.
    declared = F.regexp(F.col("bare"), F.concat(F.lit(r"(?U)\bexport\s+(?:default\s+)?(?:async\s+|abstract\s+)?(?:const|let|var|interface|type|enum|class|function\s*\*?)\s+"), name, F.lit(r"(?![\w$])")))
    listed = F.regexp(F.col("bare"), F.concat(F.lit(r"(?U)\bexport\s+(?:type\s+)?\{(?:[^}]*[\s,{])?"), name, F.lit(r"\s*[,}]")))
    problem = (
        F.when(~F.col("ref").rlike(r"(?s)^.+:[^:]+$"), "malformed")
        .when(F.col("path").rlike(r"^/|(^|/)\.\.(/|$)"), "outside")
        .when(F.col("text").isNull(), "missing_file")
        .when(number.isNotNull(), F.when((number < 1) | (number > F.col("lines")), "line_out_of_range"))
        .when(~(declared | listed), "export_not_found")
    )
    return j.select("ref", problem.alias("problem")).filter("problem is not null")


def raw_calls(files: DataFrame, name: str = "fetch") -> DataFrame:
    """``path, line`` of calls of a function by its bare name, outside comments and strings."""
    lines = files.select("path", F.posexplode(F.split(bare_code(F.col("text")), "\n")).alias("line", "code"))
    return lines.filter(F.col("code").rlike(rf"(?<![\w.$]){re.escape(name)}\s*\(")).select("path", (F.col("line") + 1).alias("line"))


def routing_problems(config: Any, tier0_roles: Mapping[str, str], tier3_vendor: str) -> list[str]:
    """What is wrong with a model routing: roles of tier 0, prices where none belong, a vendor outside its tier."""
    out: list[str] = []
    if not isinstance(config, Mapping) or not isinstance(config.get("tiers"), Mapping):
        return ["the configuration has no tiers"]
    for vendor, role in tier0_roles.items():
        entry = config["tiers"].get("tier0", {}).get(vendor)
        if not isinstance(entry, Mapping) or entry.get("role") != role:
            out.append(f"tier0.{vendor}: the role is not {role}")
    for tier, vendors in config["tiers"].items():
        if tier3_vendor in (vendors or {}) and tier != "tier3":
            out.append(f"{tier}: {tier3_vendor} belongs to tier3 only")

    def walk(node: Any, at: str) -> None:
        if isinstance(node, Mapping):
            for k, v in node.items():
                if re.search(r"price|usd_per|cost_per", str(k), re.I):
                    out.append(f"{at}{k}: no prices here")
                walk(v, f"{at}{k}.")
        elif isinstance(node, list):
            for i, v in enumerate(node):
                walk(v, f"{at}{i}.")
        elif isinstance(node, str) and re.search(r"\$ ?[0-9]|usd ?/ ?1?m", node, re.I):
            out.append(f"{at[:-1]}: no prices here")

    walk(config["tiers"], "")
    return out
