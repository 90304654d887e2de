"""Documents and snapshots: first writer, relinking, chunk upserts, search and lineage."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from ..functions.words import shingle_sets
from ..scratch import Scratch, batches_of
from .components import components
from .mentions import mentions  # noqa: F401
from .ranges import Next, scan


def first_writer(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Adds ``first_doc`` of each key, and whether a row came later.

    The first is an aggregate that is joined back, so that a content with very many
    copies is not one window partition.
    """
    first = rows.groupBy(key).agg(F.min(F.struct(*order)).alias("__first")).select(key, F.col("__first")[order[-1]].alias("first_doc"))
    return rows.join(first, key).withColumn("deduplicated", F.col(order[-1]) != F.col("first_doc"))


def chunk_upsert(old: DataFrame, new: DataFrame, given: DataFrame) -> DataFrame:
    """Chunks after a run. ``given(snap, reject)``: rejected snapshots keep their chunks; of others, indexes beyond the new ones go and known ids stay."""
    accepted = given.filter("reject is null").select("snap")
    fresh = new.join(accepted, "snap", "left_semi").withColumn("__new", F.lit(True))
    joined = fresh.join(old.withColumn("__old", F.lit(True)), ["snap", "chunk_index"], "full")
    rerun = accepted.distinct().withColumn("__run", F.lit(True))
    out = joined.join(rerun, "snap", "left").filter("__new or __run is null")
    change = F.when(F.col("__new").isNull(), "kept").when(F.col("__old").isNull(), "inserted").otherwise("updated")
    return out.select("snap", "chunk_index", F.coalesce("chunk_id", F.concat(F.lit("new_"), "snap", F.lit("_"), "chunk_index")).alias("chunk_id"), "chunk_hash", change.alias("change"))


def relinked(old_edges: DataFrame, new_edges: DataFrame) -> DataFrame:
    """Edges after linking, and which of them are new."""
    cols = old_edges.columns
    added = new_edges.select(*cols).distinct().join(old_edges, cols, "left_anti")
    return old_edges.distinct().withColumn("added", F.lit(False)).unionByName(added.withColumn("added", F.lit(True)))


def merge_created(existing: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Find-or-create by key: what each wanted key becomes."""
    have = existing.select(key).distinct().withColumn("__have", F.lit(True))
    return wanted.select(key).distinct().join(have, key, "left").select(key, F.when(F.col("__have"), "matched").otherwise("created").alias("outcome"))


def missing_parents(rows: DataFrame, key: str, parents: DataFrame) -> DataFrame:
    return rows.join(parents.select(key).distinct(), key, "left_anti")


#: Words that the index leaves out, and endings that it strips, longest first. Fixed values.
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with")


def analysed(text: Column) -> Column:
    """Terms of a text: lower-case runs of letters and digits without stop words, possessives and a plural's ``s``."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+(?:'s)?"), F.lit(0))
    plain = F.transform(words, lambda w: F.regexp_replace(F.regexp_replace(w, "'s$", ""), "([^s]{3})s$", "$1"))
    return F.filter(plain, lambda w: ~w.isin(*STOP_WORDS))


def every_word(text: Column) -> Column:
    """Lower-case runs of letters, digits, marks and underscores, all of them."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}\p{M}_]+"), F.lit(0))


def graph(nodes: Mapping[str, tuple[DataFrame, str]], edges: Mapping[str, tuple[DataFrame, str, str, str, str]]) -> tuple[DataFrame, DataFrame]:
    """A property graph from tables: ``vertices(id, label)`` and ``edges(src, dst, type)``.

    ``nodes``: table and id column of each label; ``edges``: table, source column and
    label, target column and label of each type. An edge whose end is no vertex, or
    null, is left out, as it could not have been created; repeated edges are one.
    """
    vertices = None
    for label, (table, id_col) in nodes.items():
        own = table.select(F.concat(F.lit(f"{label}:"), F.col(id_col).cast("string")).alias("id"), F.lit(label).alias("label")).filter("id is not null").distinct()
        vertices = own if vertices is None else vertices.unionByName(own)
    links = None
    for kind, (table, src, src_label, dst, dst_label) in edges.items():
        own = table.select(F.concat(F.lit(f"{src_label}:"), F.col(src).cast("string")).alias("src"), F.concat(F.lit(f"{dst_label}:"), F.col(dst).cast("string")).alias("dst"), F.lit(kind).alias("type")).distinct()
        links = own if links is None else links.unionByName(own)
    if vertices is None or links is None:
        raise ValueError("a graph has a label and a type at least")
    ids = vertices.select("id")
    sound = links.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return vertices, sound.select("src", "dst", "type")


def lineage(edges: DataFrame, roots: DataFrame, depth: int | None = None) -> DataFrame:
    """``root, node, hops`` along edges, each node once for a root, at its nearest; all that a root leads to, or ``depth`` steps of it.

    Without a depth, walks double in length: what was found within ``2**k`` steps is
    joined with the walks of exactly ``2**k``, until a round finds nothing. A shortest
    walk is put together from such walks, so that rounds grow as the logarithm of the depth,
    and cycles end. Each round is written, so that the next joins what is found instead of
    finding it again.
    """
    scratch = Scratch(edges.sparkSession, "lineage")
    start = scratch.save(roots.select(F.col("node").alias("root"), "node").distinct(), "roots")
    if depth is not None:
        step, out = start, start.withColumn("hops", F.lit(0))
        for hop in range(1, depth + 1):
            step = scratch.save(step.join(edges, step.node == edges.src).select("root", F.col("dst").alias("node")).distinct(), "step")
            out = out.unionByName(step.withColumn("hops", F.lit(hop)))
        return out.groupBy("root", "node").agg(F.min("hops").alias("hops"))
    found = start.withColumn("hops", F.lit(0))
    walks = scratch.save(edges.filter("src is not null and dst is not null").select("src", "dst").distinct(), "walks")
    length = 1
    while True:
        further = found.join(walks, F.col("node") == F.col("src")).select("root", F.col("dst").alias("node"), F.col("hops") + length).toDF("root", "node", "hops")
        new = scratch.save(further.groupBy("root", "node").agg(F.min("hops").alias("hops")).join(found.select("root", "node"), ["root", "node"], "left_anti"), "new")
        if new.isEmpty():
            return found
        found, length = found.unionByName(new), length * 2
        again = walks.select(F.col("src").alias("__mid"), F.col("dst").alias("__end"))
        longer = scratch.save(walks.join(again, F.col("dst") == F.col("__mid")).select("src", F.col("__end").alias("dst")).distinct(), "walks")
        scratch.drop(walks)
        walks = longer


def trace(edges: DataFrame, roots: DataFrame, path: Sequence[str]) -> DataFrame:
    """``root``, a column for each type of ``path`` with the node that an edge ``(src, dst, type)`` of it leads to, and ``hops``.

    One row for each way along the types. A way may end before the last type (a claim
    without a snapshot); ways that end earlier are left out.
    """
    out = roots.select(F.col("node").alias("root"), F.col("node").alias("__at"))
    for k, kind in enumerate(path):
        step = edges.filter(F.col("type") == kind).select(F.col("src").alias("__at"), F.col("dst").alias(kind)).distinct()
        out = out.join(step, "__at", "inner" if k < len(path) - 1 else "left").withColumn("__at", F.col(kind))
    return out.drop("__at").withColumn("hops", F.lit(len(path) - 1).cast("long") + F.col(path[-1]).isNotNull().cast("long"))


#: What may stand in a word around an id.
_WORD = "[A-Za-z0-9_]"


def cited(ids: DataFrame, works: DataFrame, id_col: str = "claim_id") -> DataFrame:
    """Which of ``ids`` a work ``(listed array, body)`` cites: in its list, or as a whole word of its body.

    Ids that are words are joined with the words of bodies; others, which hold marks
    between words, are sought by their rare runs and judged at both ends.
    """
    wanted = ids.select(F.col(id_col).alias("id")).filter("id is not null").distinct()
    listed = works.select(F.explode("listed").alias("id"))
    words = works.select(F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("body", F.lit("")), F.lit(f"({_WORD}+)")))).alias("id"))
    by_word = wanted.join(listed.unionByName(words).distinct(), "id", "left_semi")
    odd = wanted.filter(~F.col("id").rlike(f"^{_WORD}+$")).join(listed, "id", "left_anti")
    bodies = works.filter(F.length("body") > 0).select(F.xxhash64("body").alias("k"), "body").distinct()
    near = mentions(bodies, odd.select("id", F.col("id").alias("needle")), "needle", "k", "body").join(bodies, "k")
    quoted = F.regexp_replace("id", r"([^\p{L}\p{N}_])", r"\\$1")
    whole = near.filter(F.regexp(F.col("body"), F.concat(F.lit(f"(?<!{_WORD})"), quoted, F.lit(f"(?!{_WORD})"))))
    return by_word.unionByName(whole.select("id").distinct()).select(F.col("id").alias(id_col))


def gaps(ids: DataFrame, prefix_col: str = "prefix", number_col: str = "number", ranges: int | None = None) -> DataFrame:
    """Duplicates, and the numbers missing between one id and the next, by prefix; a prefix may hold all ids."""
    n = ids.groupBy(prefix_col, number_col).agg(F.count(F.lit(1)).alias("times"))
    out = scan(n, [prefix_col], [number_col], {"next": Next(F.col(number_col))}, ranges).withColumn("gap", F.coalesce(F.col("next") - F.col(number_col) - 1, F.lit(0)))
    return out.filter("times > 1 or gap > 0").select(prefix_col, number_col, "times", "gap")


def term_usage(docs: DataFrame, terms_col: str) -> DataFrame:
    return docs.select(F.explode(terms_col).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("uses"))


def references(definitions: DataFrame, uses: DataFrame, key: str) -> DataFrame:
    """Keys that are defined more than once, or used and never defined."""
    twice = definitions.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key, F.lit("duplicate_definition").alias("problem"))
    loose = uses.select(key).distinct().join(definitions.select(key).distinct(), key, "left_anti").select(key, F.lit("dangling_reference").alias("problem"))
    return twice.unionByName(loose)


#: Counters of the sketch that orders grams.
SKETCH = 1 << 18


def _set_key(grams: np.ndarray) -> int:
    """A 64-bit hash: two different sets have the same with a chance of 2**-64 a pair."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "big", signed=True)


def _range_counts(grams: np.ndarray) -> bytes:
    """How many grams fall into each of equal ranges of hashes, a byte each (255: or more). Ranges are a power of two, with two to four grams each."""
    bits = max(4, len(grams).bit_length() - 2)
    return np.minimum(np.bincount((grams >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _may_link(n: int, m: int, x: bytes, y: bytes, least: float) -> bool:
    """Whether sets of ``n`` and ``m`` grams with these counts by range may share enough: what the counts differ by, the sets differ by at least."""
    u, v = np.frombuffer(x, np.uint8).astype(np.int32), np.frombuffer(y, np.uint8).astype(np.int32)
    while len(u) > len(v):
        u = u[::2] + u[1::2]
    while len(v) > len(u):
        v = v[::2] + v[1::2]
    both = (n + m - int(np.abs(np.minimum(u, 255) - np.minimum(v, 255)).sum())) // 2
    return both >= (least - 1e-9) * (n + m - both)


def _keyed(words: int, schema: pa.Schema):  # noqa: ANN202
    """Kind 0: each row's id and the hash of its set in ``k`` (null without words), its size and counts by range; 1: a counter of the sketch in ``k`` and its count in ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(SKETCH, np.int64)
        for batch in batches:
            keys, sizes, ranges = [], [], []
            for g in shingle_sets(batch.column(1), words):
                np.add.at(counters, (g & np.uint64(SKETCH - 1)).astype(np.int64), 1)
                keys.append(_set_key(g) if len(g) else None)
                sizes.append(len(g))
                ranges.append(_range_counts(g) if len(g) else None)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(keys), np.int32)), batch.column(0), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ranges, pa.binary())], schema=schema)
        used = np.flatnonzero(counters)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(used), np.int32)), pa.nulls(len(used), schema.field("id").type), pa.array(used), pa.array(counters[used]), pa.nulls(len(used), pa.binary())], schema=schema)

    return run


def _prefixes(sketch, words: int, least: float):  # noqa: ANN001, ANN202
    """The first grams of each text's set in the common order, with the set's size and their place; copies within a task post once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, seen = sketch.value, set()
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for g in shingle_sets(batch.column(0), words):
                if not len(g) or (k := _set_key(g)) in seen:
                    continue
                seen.add(k)
                size = len(g) - int(np.ceil(len(g) * least - 1e-9)) + 1
                first = g[np.lexsort((g, often[(g & np.uint64(SKETCH - 1)).astype(np.int64)]))[:size]].view(np.int64)
                for column, values in zip(columns, (np.full(len(first), k), np.full(len(first), len(g)), np.arange(len(first)), first), strict=True):
                    column.append(values)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(t)) for c, t in zip(columns, (np.int64, np.int32, np.int32, np.int64), strict=True)], ["k", "n", "pos", "gram"])

    return run


def _grams(words: int):  # noqa: ANN202
    """``k`` and the sorted grams, as bytes, of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(0), words))
            yield pa.RecordBatch.from_arrays([pa.array([_set_key(g) for g in sets], pa.int64()), pa.array([g.tobytes() for g in sets], pa.binary())], ["k", "g"])

    return run


def _close(least: float):  # noqa: ANN202
    """``p, q`` of the pairs whose counts by range leave a link open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True)
            open_ = pa.array([_may_link(n, m, x, y, least) for n, m, x, y in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(open_), batch.column(1).filter(open_)], ["p", "q"])

    return run


def _linked(least: float):  # noqa: ANN202
    """``a, b`` of the pairs that are near, from both sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for row, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(u, v, assume_unique=True))
                if both / (len(u) + len(v) - both) >= least:
                    good.append(row)
            near = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(near), batch.column(1).take(near)], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: float = 0.8) -> DataFrame:
    """``id, class_id`` of each row: the smallest id reachable over links; no link is missed.

    Two documents link when they share at least ``least`` of all their distinct
    shingles. Documents with equal shingles are one set in what follows. Two sets that
    link share a gram among the first of both in one order (a prefix filter), where
    enough grams still follow. Grams come in the order of a count sketch over all
    documents, then of their hash: any order that is the same for all is right, this
    one keeps grams of very many sets out of prefixes. Each posting is first compared
    with one anchor of its gram and length class; what links is contracted, and only
    sets of different classes are paired after, so that a large group of near copies
    costs a pair for each member and gram. A pair passes the counts of both sets by range
    of hashes (a byte for two to four grams) before any text of it is read again: most
    pairs share a gram by chance, and their number grows faster than the table.

    A text shorter than a shingle is one shingle; one without words has none, and is
    alone. Rows that repeat an id are one document's, and each is returned; a null id is
    the smallest only where no row of the class has one. Extra columns are ignored.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "near-duplicates")
    schema = StructType([StructField("kind", IntegerType()), StructField("id", docs.schema[id_col].dataType), StructField("k", LongType()), StructField("n", LongType()), StructField("ranges", BinaryType())])
    texts = docs.select(F.col(id_col).alias("id"), F.lower(text_col).alias("text"))
    keyed = scratch.save(texts.mapInArrow(_keyed(words, to_arrow_schema(schema)), schema), "keys")
    rows = keyed.filter("kind = 0").select("id", "k")

    # One id for each set; it may stand for several texts.
    nodes = scratch.save(keyed.filter("kind = 0 and k is not null").groupBy("k").agg(F.min(F.struct(F.col("id").isNull(), "id")).alias("first"), F.first("n").alias("n"), F.first("ranges").alias("ranges")).select("k", F.col("first.id").alias("need"), "n", "ranges"), "nodes")

    counted = keyed.filter("kind = 1").groupBy("k").agg(F.sum("n").alias("n")).toArrow()  # at most SKETCH rows
    often = np.zeros(SKETCH, np.int64)
    often[counted.column("k").to_numpy()] = counted.column("n").to_numpy()
    sketch = spark.sparkContext.broadcast(often)
    posted = scratch.save(texts.select("text").mapInArrow(_prefixes(sketch, words, least), "k long, n int, pos int, gram long"), "posted")
    several = posted.groupBy("gram").agg(F.min("k").alias("first"), F.max("k").alias("last")).filter("first <> last").select("gram")
    lists = scratch.save(posted.join(several, "gram").distinct(), "lists")
    scratch.drop(posted)
    enough = f"least(x.n, y.n) >= {least} * greatest(x.n, y.n) - 1e-9 and (1 + least(x.n - x.pos - 1, y.n - y.pos - 1)) * {1 + least} >= {least} * (cast(x.n as bigint) + y.n) - 1e-9"

    def links(pairs: DataFrame, name: str) -> DataFrame:
        """Which of the different pairs ``(p, q)`` link; only texts of sets that a close pair has are read again."""
        side = lambda k, x, *columns: x.select(F.col("k").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in columns))
        counts = pairs.join(side("p", nodes, "n", "ranges"), "p").join(side("q", nodes, "n", "ranges"), "q").select("p", "q", "n_p", "n_q", "ranges_p", "ranges_q")
        with batches_of(spark, 1000):
            close = scratch.save(counts.mapInArrow(_close(least), "p long, q long"), f"{name}-close")
        wanted = close.select(F.explode(F.array("p", "q")).alias("k")).distinct()
        needed = nodes.join(wanted, "k", "left_semi").select("need").distinct()
        again = texts.join(needed, F.col("id").eqNullSafe(F.col("need")), "left_semi").select("text").mapInArrow(_grams(words), "k long, g binary")
        with batches_of(spark, 1000):
            sets = scratch.save(again.join(wanted, "k", "left_semi").dropDuplicates(["k"]), f"{name}-sets")
        both = close.join(side("p", sets, "g"), "p").join(side("q", sets, "g"), "q").select("p", "q", "g_p", "g_q")
        with batches_of(spark, 500):
            found = scratch.save(both.mapInArrow(_linked(least), "a long, b long"), f"{name}-links")
        scratch.drop(close, sets)
        return found

    # The set that has a gram earliest has the fewest grams of its own: the middle of a group of near copies.
    length = F.floor(F.log("n") / float(-np.log(least))).cast("int") if least < 1 else F.col("n")
    classed = lists.withColumn("c", length)
    anchors = classed.groupBy("gram", "c").agg(F.min(F.struct("pos", "n", "k")).alias("anchor")).select("gram", "c", "anchor.*")
    first = classed.alias("x").join(anchors.alias("y"), F.expr(f"x.gram = y.gram and abs(x.c - y.c) <= 1 and x.k <> y.k and {enough}"))
    met = scratch.save(first.select(F.least("x.k", "y.k").alias("p"), F.greatest("x.k", "y.k").alias("q")).distinct(), "met")
    found = links(met, "anchors")
    groups = components(found, scratch)
    rooted = scratch.save(lists.join(groups.select(F.col("node").alias("k"), "root"), "k", "left").withColumn("root", F.coalesce("root", "k")), "rooted")
    # Two sets in one list have met as set and anchor.
    mixed = rooted.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("sets")).filter("low <> high and sets > 2").select("gram")
    open_lists = scratch.save(rooted.join(mixed, "gram"), "mixed")
    across = open_lists.alias("x").join(open_lists.alias("y"), F.expr(f"x.gram = y.gram and x.k < y.k and x.root <> y.root and {enough}"))
    more = links(across.select(F.col("x.k").alias("p"), F.col("y.k").alias("q")).distinct().join(met, ["p", "q"], "left_anti"), "across")
    if not more.isEmpty():
        groups = components(found.unionByName(more), scratch)
    scratch.drop(nodes, met, lists, rooted, open_lists)

    named = scratch.save(rows.join(groups.select(F.col("node").alias("k"), "root"), "k", "left").select("id", "k", F.coalesce("root", "k").alias("root")), "rooted-rows")
    heads = named.filter("root is not null").groupBy("root").agg(F.min("id").alias("class_id"))
    return named.join(heads, "root", "left").select("id", F.coalesce("class_id", "id").alias("class_id"))
