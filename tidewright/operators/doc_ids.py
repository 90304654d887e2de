"""Ids that documents define and refer to: taken from their lines, resolved over all documents."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import markup

# Spaces of ids, and what may not stand beside one.
SPACES = ("Q", "DEC", "ADR", "REQ", "NFR", "AC", "TEST", "SPIKE", "TASK", "TRACE", "ASM")
_ID = rf"(?<![A-Za-z0-9_])(?:{'|'.join(SPACES)})-[0-9]{{3,4}}(?![A-Za-z0-9_#-])"
#: Where a line defines an id, the surest first: a heading, a heading that says what became of it, an assumption; and a row of a table.
_HEADING = rf"^ {{0,3}}#+\s+`?({_ID})`?(?::|\b)"
_MOVED = rf"^ {{0,3}}#+\s+[A-Za-z][A-Za-z-]*\s+`?({_ID})`?:"
_ASSUMED = r"^\s*[-*]\s+`?(ASM-[0-9]{3,4})`?\s*:"
_TABLE = rf"^\s*\|\s*`?({_ID})`?\s*\|"
_LINES = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), T.StructField("text", T.StringType())]))


@F.arrow_udf(_LINES)  # type: ignore[call-overload]
def _content(texts: pa.Array) -> pa.Array:
    rows = [None if t is None else [{"line": n, "text": x} for n, x in markup.content_lines(t) if "-" in x] for t in texts.to_pylist()]
    return pa.array(rows, pa.list_(pa.struct([("line", pa.int32()), ("text", pa.string())])))


def found_ids(docs: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """``id, path, line, role``: ``canonical`` and ``table`` definitions, and ``reference`` for each place that names an id.

    Code, comments, addresses and the targets of links name nothing; a link's words do, an image's do not. A
    decision record also defines the id of its file name, unless its lines define one.
    """
    lines = docs.select(F.col(path_col).alias("path"), F.explode(_content(F.when(F.col(text_col).rlike(_ID), F.col(text_col)))).alias("l")).select("path", "l.line", F.col("l.text").alias("t"))
    plain = F.when(F.col("t").rlike(r"^\s{0,3}\[[^\]]+\]:\s*(?:<[^>]+>|\S+)"), "").otherwise(F.col("t"))
    for pattern, to in (
        (r"(`{2,}+).*?\1", ""), (r"<https?://[^>\s]+>", ""), (r"\bhttps?://[^\s)]+", ""), (r"!\[[^\]]*\]\((?:[^()]|\([^()]*\))*+\)", ""), (r"\[([^\]]*)\]\((?:[^()]|\([^()]*\))*+\)", "$1"),
        (r"!\[[^\]]*\]\[[^\]]*\]", ""), (r"\[([^\]]+)\]\[[^\]]*\]", "$1"),
    ):
        plain = F.regexp_replace(plain, pattern, to)
    named = lines.select(F.explode(F.regexp_extract_all(plain, F.lit(f"({_ID})"))).alias("id"), "path", "line", F.lit("reference").alias("role"))
    parts = []
    for pattern, role in ((_HEADING, "canonical"), (_MOVED, "canonical"), (_ASSUMED, "canonical"), (_TABLE, "table")):
        defined = F.regexp_extract("t", pattern, 1)
        parts.append(F.when(defined != "", F.struct(defined.alias("id"), F.lit(role).alias("role"))))
    own = lines.select("path", "line", F.explode(F.array_compact(F.array(*parts))).alias("d")).select("d.id", "path", "line", "d.role")
    # The file's own number.
    number = F.regexp_extract(F.regexp_extract("path", r"(?:^|/)docs/adr/(?:[^/]*/)*([^/]+)$", 1), r"(?i)^(?:ADR-)?([0-9]{3,4})(?:[-_.]|$)", 1)
    files = docs.select(F.col(path_col).alias("path")).withColumn("n", number).filter("n <> ''").select(F.concat(F.lit("ADR-"), "n").alias("id"), "path", F.lit(1).alias("line"), F.lit("canonical").alias("role"))
    inside = own.filter(F.startswith("id", F.lit("ADR-"))).select("path").distinct()
    return named.unionByName(own).unionByName(files.join(inside, "path", "left_anti").select("id", "path", "line", "role"))


def problems(found: DataFrame) -> DataFrame:
    """``id, problem, places``: ids defined more than once, and ids that are named and nowhere defined.

    Where an id has a canonical definition, rows of tables only refer to it. Counts are combined
    before the shuffle, so that an id that all documents name is one row a task.
    """
    sums = found.groupBy("id").agg(*(F.count_if(F.col("role") == r).alias(r) for r in ("canonical", "table", "reference")))
    defined = F.when(F.col("canonical") > 0, F.col("canonical")).otherwise(F.col("table"))
    problem = F.when(defined > 1, "duplicate_definition").when(defined == 0, "dangling_reference")
    return sums.select("id", problem.alias("problem"), F.when(defined > 1, defined).otherwise(F.col("reference")).alias("places")).filter("problem is not null")
