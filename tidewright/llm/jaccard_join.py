"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters.

Two documents link when ``den * |A & B| >= num * |A | B|`` over their sets of
distinct word n-grams. The steps:

1. One pass hashes every whole text. Documents with equal sets share a 128-bit
   key and are one node from here on, so that copies are never paired.
2. Grams are ordered rare first by a count sketch over all documents (the order
   only has to be the same for all; ties go by hash). Each node posts its
   prefix: a pair that links shares a gram of both prefixes.
3. First each posting is paired only with one anchor of its gram and length
   class, and what links is contracted. Then postings of one gram are paired
   only across the components that remain, under length and positional filters.
   Large groups of near copies so cost one pair for each member and gram.
4. A distinct pair passes the suffix filter (counts of both sets by hash range
   bound their difference) and is then verified once, on the whole texts.

Defined cases: null texts, empty texts and texts without words have an empty set
and link with nothing; texts shorter than a gram are one gram; rows that repeat
an id are separate rows of one document id and each is returned; a null id is
kept, and counts as larger than any other when the smallest id is looked for.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.words import shingle_sets
from ..operators.components import components
from ..scratch import Scratch, batches_of, small

#: Counters of the sketch that orders grams; every partition sends this many.
SKETCH = 1 << 18
#: Hash ranges that the suffix filter counts by.
RANGES = 64
#: Ids of documents to verify that are broadcast at most (8 bytes each).
BROADCAST_IDS = 1_000_000
#: Texts, and pairs of texts, in an Arrow batch.
TEXTS, PAIRS = 1000, 500


@dataclass(frozen=True)
class JaccardRule:
    words: int = 5
    num: int = 4
    den: int = 5

    def __post_init__(self) -> None:
        if not 0 < self.num <= self.den or self.words < 1:
            raise ValueError("the similarity is above 0 and at most 1")

    def least(self, n: int) -> int:
        """Grams that a set of ``n`` shares at least with anything it links with."""
        return -(-self.num * n // self.den)

    def prefix(self, n: int) -> int:
        return n - self.least(n) + 1 if n else 0


def set_key(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def short_key(key: bytes) -> int:
    """The part of a key that postings carry. Where two keys share it, pairs of both are verified."""
    return int.from_bytes(key[:8], "big", signed=True)


def _range_counts(grams: np.ndarray) -> list[int]:
    return np.bincount((grams >> np.uint64(58)).astype(np.int64), minlength=RANGES).tolist() if len(grams) else [0] * RANGES


_SET_TYPE = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), ("ranges", pa.list_(pa.int32()))])
_SET_DDL = "kind int, id long, key binary, n long, ranges array<int>"


def _sets(words: int):
    """kind 0: a document's id, key and size; 1: a counter of the sketch in ``id`` and its count in ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        for batch in batches:
            keys, sizes, ranges = [], [], []
            for grams in shingle_sets(batch.column(1), words):
                np.add.at(sketch, (grams & np.uint64(SKETCH - 1)).astype(np.int64), 1)
                keys.append(set_key(grams) if len(grams) else None)
                sizes.append(len(grams))
                ranges.append(_range_counts(grams))
            k = len(keys)
            yield pa.RecordBatch.from_arrays([pa.array([0] * k, pa.int32()), batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(ranges, pa.list_(pa.int32()))], schema=_SET_TYPE)
        used = np.flatnonzero(sketch)
        k = len(used)
        if k:
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(k, np.int32)), pa.array(used), pa.nulls(k, pa.binary()), pa.array(sketch[used]), pa.nulls(k, pa.list_(pa.int32()))], schema=_SET_TYPE)

    return run


def _postings(rule: JaccardRule, sketch):
    schema = pa.schema([("gram", pa.int64()), ("k", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        seen: set[bytes] = set()  # copies within the partition post once
        for batch in batches:
            grams_out, keys, sizes, took = [], [], [], []
            for grams in shingle_sets(batch.column(1), rule.words):
                if not len(grams) or (key := set_key(grams)) in seen:
                    continue
                seen.add(key)
                p, often = rule.prefix(len(grams)), counts[(grams & np.uint64(SKETCH - 1)).astype(np.int64)]
                grams_out.append(grams[np.lexsort((grams, often))[:p]].view(np.int64))
                keys.append(key)
                sizes.append(len(grams))
                took.append(p)
            if not keys:
                continue
            took_a = np.array(took)
            at = np.repeat(np.arange(len(keys), dtype=np.int32), took_a)
            pos = (np.arange(len(at)) - np.repeat(np.cumsum(took_a) - took_a, took_a)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams_out)), pa.array(np.array([short_key(k) for k in keys], np.int64)[at]), pa.array(np.array(sizes, np.int32)[at]), pa.array(pos)], schema=schema)

    return run


def _texts(words: int):
    """The key beside each whole text, computed anew: an id may stand for several texts."""
    schema = pa.schema([("key", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _keyed_texts(words)(batches):
            yield pa.RecordBatch.from_arrays(batch.columns[1:], schema=schema)

    return run


def _keyed_texts(words: int):
    """:func:`_texts` beside each id."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [set_key(g) if len(g) else None for g in shingle_sets(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), batch.column(1).cast(pa.string())], schema=schema)

    return run


def _verified(rule: JaccardRule):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ok = []
            for i, other in enumerate(shingle_sets(batch.column(3), rule.words)):
                if a[i] != last[0]:
                    last = (a[i], next(shingle_sets(batch.column(2).slice(i, 1), rule.words)))
                both = len(np.intersect1d(last[1], other, assume_unique=True))
                ok.append(rule.den * both >= rule.num * (len(last[1]) + len(other) - both))
            keep = [i for i, x in enumerate(ok) if x]
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.binary()), pa.array([b[i] for i in keep], pa.binary())], schema=schema)

    return run


def _could_link(rule: JaccardRule, x: str, y: str) -> str:
    """Length and positional filter of two postings of one gram: what both sets can still share is enough."""
    s, t = rule.num, rule.den
    n = f"(cast({x}.n as bigint) + {y}.n)"
    return f"{t} * least({x}.n, {y}.n) >= {s} * greatest({x}.n, {y}.n) and (1 + least({x}.n - {x}.pos - 1, {y}.n - {y}.pos - 1)) * {s + t} >= {s} * {n}"


def _close_counts(rule: JaccardRule, x: str, y: str) -> str:
    """Suffix filter: what the counts by hash range differ by, the sets differ by at least."""
    s, t = rule.num, rule.den
    n = f"(cast({x}.n as bigint) + {y}.n)"
    return f"({n} - aggregate(zip_with({x}.ranges, {y}.ranges, (p, q) -> abs(p - q)), 0, (z, p) -> z + p)) * {s + t} >= 2 * {s} * {n}"


class JaccardJoin:
    """The join over one table; :meth:`classes` gives one row for each document."""

    def __init__(self, docs: DataFrame, rule: JaccardRule = JaccardRule(), id_col: str = "doc_id", text_col: str = "text") -> None:
        self.spark = docs.sparkSession
        self.rule = rule
        self.docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        self.scratch = Scratch(self.spark, "jaccard")

    def _pairs_verified(self, pairs: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
        pairs = (
            pairs.join(nodes.alias("x"), F.expr("a = x.k"))
            .join(nodes.alias("y"), F.expr("b = y.k"))
            .filter(_close_counts(self.rule, "x", "y"))
            .select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
        )
        pairs = self.scratch.save(pairs, f"{name}-pairs")
        keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        ids = self.scratch.save(keys.join(nodes.select("key", "id"), "key").select("id"), f"{name}-ids")
        wanted = F.broadcast(ids) if small(ids, BROADCAST_IDS) else ids
        wanted = (wanted.distinct() if wanted is ids else wanted).withColumnRenamed("id", "wanted")
        # A set of rows without ids only has a null id here.
        texts = self.docs.join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi").mapInArrow(_texts(self.rule.words), "key binary, text string")
        texts = texts.join(keys, "key", "left_semi").dropDuplicates(["key"])
        with batches_of(self.spark, TEXTS):
            texts = self.scratch.save(texts, f"{name}-texts")
        both = pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a")
        with batches_of(self.spark, PAIRS):
            links = self.scratch.save(both.select("a", "b", "ta", "tb").mapInArrow(_verified(self.rule), "a binary, b binary"), f"{name}-links")
        self.scratch.drop(pairs, ids, texts)
        return links

    def classes(self) -> DataFrame:
        """``id, n_grams, class_id`` (the smallest id reachable by links), one row for each row of the input."""
        return self.keyed_classes().drop("key")

    def keyed_classes(self) -> DataFrame:
        """:meth:`classes` with the ``key`` of each row's set."""
        spark, rule, scratch = self.spark, self.rule, self.scratch
        with batches_of(spark, TEXTS):
            first = scratch.save(self.docs.mapInArrow(_sets(rule.words), _SET_DDL), "sets")
        summed = first.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).toArrow()  # at most SKETCH rows, however many documents there are
        counts = np.zeros(SKETCH, np.int64)
        counts[summed.column("id").to_numpy()] = summed.column("n").to_numpy()
        sketch = spark.sparkContext.broadcast(counts)
        members = first.filter("kind = 0").select("id", "key", "n")
        nodes = scratch.save(first.filter("kind = 0 and key is not null").groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("ranges").alias("ranges")).withColumn("k", F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long")), "nodes")

        with batches_of(spark, TEXTS):
            posted = scratch.save(self.docs.mapInArrow(_postings(rule, sketch), "gram long, k long, n int, pos int"), "posted")
        shared = posted.groupBy("gram").agg(F.min("k").alias("least"), F.max("k").alias("most")).filter("least <> most").select("gram")
        lists = scratch.save(posted.join(shared, "gram").distinct(), "lists")
        scratch.drop(posted)

        # The set that has a gram earliest has the fewest grams of its own: the middle of a group of near copies.
        length_class = F.floor(F.log("n") / float(np.log(rule.den / rule.num))).cast("int") if rule.num < rule.den else F.col("n")
        classed = lists.withColumn("c", length_class)
        anchors = classed.groupBy("gram", "c").agg(F.min(F.struct("pos", "n", "k")).alias("anchor")).select("gram", "c", "anchor.*")
        near = classed.alias("x").join(anchors.alias("y"), F.expr(f"x.gram = y.gram and abs(x.c - y.c) <= 1 and x.k <> y.k and {_could_link(rule, 'x', 'y')}"))
        near = near.select(F.least("x.k", "y.k").alias("a"), F.greatest("x.k", "y.k").alias("b")).distinct()
        links = self._pairs_verified(near, nodes, "anchors")
        groups = components(links, scratch)

        roots = groups.join(nodes.select(F.col("key").alias("node"), "k"), "node").select("k", F.conv(F.hex(F.substring("root", 1, 8)), 16, -10).cast("long").alias("root"))
        at = scratch.save(lists.join(roots, "k", "left").select("gram", "k", "n", "pos", F.coalesce("root", "k").alias("root")), "rooted")
        # Two sets in one list have met as set and anchor.
        mixed = at.groupBy("gram").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count(F.lit(1)).alias("sets")).filter("least <> most and sets > 2").select("gram")
        at = scratch.save(at.join(mixed, "gram"), "mixed")
        across = at.alias("x").join(at.alias("y"), F.expr(f"x.gram = y.gram and x.k < y.k and x.root <> y.root and {_could_link(rule, 'x', 'y')}"))
        across = across.select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).distinct()
        more = self._pairs_verified(across, nodes, "across")
        if not more.isEmpty():
            groups = components(links.unionByName(more), scratch)
        scratch.drop(lists)

        rooted = members.join(groups.select(F.col("node").alias("key"), "root"), "key", "left")
        linked = scratch.save(rooted.filter("root is not null"), "linked")
        heads = linked.groupBy("root").agg(F.min("id").alias("class_id"))
        grouped = linked.join(heads, "root").select("id", F.col("n").alias("n_grams"), "class_id", "key")
        copies = nodes.select("key", F.col("id").alias("class_id"))
        alone = rooted.filter("root is null").join(copies, "key", "left").select("id", F.col("n").alias("n_grams"), F.coalesce("class_id", "id").alias("class_id"), "key")
        return grouped.unionByName(alone)


def classes(docs: DataFrame, rule: JaccardRule = JaccardRule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return JaccardJoin(docs, rule, id_col, text_col).classes()


def keep_one(docs: DataFrame, rule: JaccardRule = JaccardRule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class; of rows that repeat an id, each is judged by its own text.

    A row without an id stays only where no row of its class has one.
    """
    join = JaccardJoin(docs, rule, id_col, text_col)
    goes = F.coalesce(F.col("class_id") != F.col("id"), F.col("id").isNull() & F.col("class_id").isNotNull())
    found = join.keyed_classes().select("id", "key", goes.alias("goes"))
    fate = join.scratch.save(found.groupBy("id").agg(F.max("goes").alias("some"), F.min("goes").alias("every")).filter("some"), "fate")
    whole, mixed = (fate.filter(cond).select(F.col("id").alias("__id")) for cond in ("every", "not every"))
    kept = docs.join(whole, docs[id_col].cast("long").eqNullSafe(whole["__id"]), "left_anti")
    if mixed.isEmpty():
        return kept
    # Ids with rows of both kinds: the texts whose sets go, each beside its id.
    keys = found.filter("goes").join(mixed, F.col("id").eqNullSafe(F.col("__id")), "left_semi").select("id", "key").distinct()
    texts = join.docs.join(mixed, F.col("id").eqNullSafe(F.col("__id")), "left_semi").mapInArrow(_keyed_texts(rule.words), "id long, key binary, text string")
    gone = texts.alias("t").join(keys.alias("k"), F.expr("t.key = k.key and t.id <=> k.id"), "left_semi").select(F.col("id").alias("__id"), F.col("text").alias("__text")).distinct()
    return kept.join(gone, kept[id_col].cast("long").eqNullSafe(gone["__id"]) & (kept[text_col] == gone["__text"]), "left_anti")
