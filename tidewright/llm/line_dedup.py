"""Line dedup over a whole corpus, in DataFrame functions only.

Every row is one document. Its text is split at newlines; a line's key is the
line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased. Keys of at
least ``min_chars`` code points that occur in at least ``min_docs`` documents
lose all their lines; the others are joined again in their order.

Keys are compared by two 64-bit hashes. A document counts once for each of its
keys, and counts are combined before the shuffle, so that a line which a third
of all documents hold is one partial count for each task. Lines travel as
hashes and positions; only documents that lose a line have their marks joined.

Defined cases: a null or empty text is one empty line (its key has no code
points, so it stays where ``min_chars`` is above 0); rows that repeat an id
count as documents of their own; null ids are kept. Columns of the input come
back as they were, but for the text and the names of the result's own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACES = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACES)), _UPPER, _UPPER.lower())


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept text in ``text_col``, ``n_lines`` (before dropping) and ``n_dropped``."""
    if min_docs < 1 or min_chars < 0:
        raise ValueError("min_docs is at least 1 and min_chars at least 0")
    scratch = Scratch(docs.sparkSession, "lines")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Rows with equal id and text get equal marks, so this key need not be unique.
    doc = F.struct(F.col(id_col).cast("string").alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
    exploded = docs.select(doc.alias("doc"), F.posexplode(F.split(text, "\n")).alias("pos", "raw")).select("doc", "pos", line_key(F.col("raw")).alias("key"))
    hashed = exploded.select("doc", "pos", F.when(F.length("key") >= min_chars, F.struct(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))).alias("line"))
    lines = scratch.save(hashed, "hashes")

    # A row's keys, once each: what repeats within a row is nested no further than the row.
    own = docs.select(F.array_distinct(F.transform(F.split(text, "\n"), line_key)).alias("keys"))
    counted = own.select(F.explode("keys").alias("key")).filter(F.length("key") >= min_chars)
    counted = counted.groupBy(F.struct(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")).alias("line")).agg(F.count(F.lit(1)).alias("docs"))
    common = counted.filter(F.col("docs") >= min_docs).select("line", F.lit(True).alias("common"))

    touched = scratch.save(lines.join(common, "line").select("doc", "pos").distinct(), "marks")
    keys = touched.select("doc").distinct()
    flags = lines.select("doc", "pos").distinct().join(keys, "doc", "left_semi").join(touched.withColumn("gone", F.lit(True)), ["doc", "pos"], "left")
    flags = flags.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("gone", F.lit(False)).alias("gone")))).alias("flags"))
    flags = scratch.save(flags.select("doc", F.col("flags.gone").alias("gone_flags")), "flags")
    scratch.drop(lines, touched)

    mine = []  # two names that no column has
    while len(mine) < 2:
        name = "__own" + "_" * len(mine)
        while name in docs.columns or name in mine:
            name += "_"
        mine.append(name)
    out = docs.drop("n_lines", "n_dropped").withColumn(mine[0], doc).join(flags.select(F.col("doc").alias(mine[0]), F.col("gone_flags").alias(mine[1])), mine[0], "left")
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    kept = F.array_join(F.zip_with(split, F.col(mine[1]), lambda line, gone: F.when(~gone, line)), "\n")
    return (
        out.withColumn("n_lines", F.size(split).cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size(F.filter(mine[1], lambda x: x)), F.lit(0)).cast("long"))
        .withColumn(text_col, F.when(F.col(mine[1]).isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(kept))
        .drop(*mine)
    )
