"""A search index that is kept: written once, extended by segments, read by blocks.

A segment holds, for each kind of node and term, postings in blocks of falling
frequency, with the highest frequency and the smallest node of each block; the terms'
counts; the kinds' sizes; and edges in the order of their ends. A row in ``segments``,
written last, makes a segment visible.

A search first adds up the leading blocks of its terms. The nodes that are best there are
scored in full, from the rows of nodes themselves, which lie in the order of ids: the
last of their scores is one that the results reach at least. A block whose best posting,
with the best of all other terms, stays below it can't hold a result, and is not read. What
is left out of a node's sum this way belongs to nodes that are no results either,
so that scores are those of a full scan. Terms are sorted over all files, and the bound
on frequencies goes down to the reader.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.batches import list_runs
from ..scratch import batches_of

K1, B = 1.2, 0.75
BLOCK = 512
#: Nodes, with all their terms, in an Arrow batch.
ROWS = 500
#: Postings of a query from which a bound is looked for first. Results are the same either way.
PRUNE_FROM = 200_000
_POSTINGS = "kind string, term string, first boolean, max_often int, min_size int, ids array<string>, often array<int>, size array<int>"
_TERMS = "segment long, kind string, term string, df long, min_size int, max_often int"
_KINDS = "segment long, kind string, n long, total long"
_COUNTED = "kind string, id string, terms array<string>, often array<int>, size int"
_NODES = f"segment long, {_COUNTED}"
_EDGES = "segment long, src string, dst string, kind string"
_SCORES = ("bm25", "count")
Analyser = Callable[[Column], Column]


def _blocks(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: Any = None
        for batch in batches:
            kind, term = batch.column("kind").to_pylist(), batch.column("term").to_pylist()
            edges = [0, *(i for i in range(1, len(kind)) if term[i] != term[i - 1] or kind[i] != kind[i - 1]), len(kind)]
            cuts = [(i, min(i + size, b)) for a, b in zip(edges, edges[1:], strict=False) for i in range(a, b, size)]
            often, sizes = batch.column("often"), batch.column("size")
            first = []
            for i, _ in cuts:
                first.append((kind[i], term[i]) != last)
                last = (kind[i], term[i])
            ends = pa.array([0, *(b for _, b in cuts)], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, batch.column(c)) for c in ("id", "often", "size")]
            at = pa.array([i for i, _ in cuts], pa.int64())
            smallest = [min(sizes.slice(i, b - i).to_pylist()) for i, b in cuts]
            yield pa.RecordBatch.from_arrays([batch.column("kind").take(at), batch.column("term").take(at), pa.array(first), often.take(at), pa.array(smallest, pa.int32()), *lists], ["kind", "term", "first", "max_often", "min_size", "ids", "often", "size"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different terms of each node with how often it has them, in place of all of them."""
    for batch in batches:
        for part in list_runs(batch, "terms"):
            counts = [Counter(terms) for terms in part.column("terms").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("kind"), part.column("id"), pa.array([list(c) for c in counts], pa.list_(pa.string())), pa.array([list(c.values()) for c in counts], pa.list_(pa.int32())), pa.array([c.total() for c in counts], pa.int32())],
                ["kind", "id", "terms", "often", "size"],
            )


class SearchIndex:
    """An index below ``path``. ``analyser`` makes the terms of a text and of a query; ``score`` is BM25 within a kind, or the number of occurrences."""

    def __init__(self, spark: SparkSession, path: str, analyser: Analyser, score: str = "bm25") -> None:
        if score not in _SCORES:
            raise ValueError(f"a score is one of {_SCORES}")
        self.spark, self.path, self.analyser, self.score = spark, path.rstrip("/"), analyser, score
        self._segments: list[int] = []
        self._kinds: dict[str, tuple[int, int]] = {}

    def open(self) -> SearchIndex:
        """Reads which segments there are; again after another writer has added one."""
        read = self.spark.read
        self._segments = [r.segment for r in read.schema("segment long").parquet(f"{self.path}/segments").collect()]  # a row for each addition
        self.postings = read.schema(f"segment long, {_POSTINGS}").parquet(f"{self.path}/postings").filter(F.col("segment").isin(self._segments))
        self.terms = read.schema(_TERMS).parquet(f"{self.path}/terms").filter(F.col("segment").isin(self._segments))
        self.nodes = read.schema(_NODES).parquet(f"{self.path}/nodes").filter(F.col("segment").isin(self._segments))
        self.edges = read.schema(_EDGES).parquet(f"{self.path}/edges").filter(F.col("segment").isin(self._segments))
        sums = read.schema(_KINDS).parquet(f"{self.path}/kinds").filter(F.col("segment").isin(self._segments)).groupBy("kind").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        self._kinds = {r.kind: (r.n, r.total) for r in sums.collect()}  # one row a kind
        return self

    def add(self, nodes: DataFrame, text_cols: Sequence[str], edges: DataFrame | None = None, segment: int | None = None, block: int = BLOCK) -> SearchIndex:
        """A segment of new ``nodes(kind, id, …)`` and ``edges(src, dst, kind)``.

        A node's terms are those of all its text columns; a null or empty field has none;
        nodes without terms are counted, and never found.
        """
        number = segment if segment is not None else max(self._segments, default=0) + 1
        if number in self._segments:
            raise ValueError(f"there is a segment {number}")
        write = lambda df, name: df.write.mode("append").option("parquet.block.size", str(8 << 20)).option("compression", "zstd").parquet(f"{self.path}/{name}")
        numbered = lambda df: df.select(F.lit(number).cast("long").alias("segment"), "*")
        terms = nodes.select("kind", F.col("id").cast("string").alias("id"), F.flatten(F.array(*(self.analyser(F.col(c)) for c in text_cols))).alias("terms"))
        with batches_of(self.spark, ROWS):
            write(numbered(terms.mapInArrow(_counted, _COUNTED).repartitionByRange("id").sortWithinPartitions("id")), "nodes")
        rows = self.spark.read.schema(_NODES).parquet(f"{self.path}/nodes").filter(F.col("segment") == number)
        postings = rows.select("kind", "id", "size", F.explode(F.arrays_zip("terms", "often")).alias("p")).select("kind", "id", "size", F.col("p.terms").alias("term"), "p.often")
        order = [F.col("term"), F.col("kind"), F.desc("often"), F.col("size"), F.col("id")]
        write(numbered(postings.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks(block), _POSTINGS)), "postings")
        written = self.spark.read.schema(f"segment long, {_POSTINGS}").parquet(f"{self.path}/postings").filter(F.col("segment") == number)
        of_term = written.groupBy("kind", "term").agg(F.sum(F.size("ids")).alias("df"), F.min("min_size").alias("min_size"), F.max("max_often").alias("max_often"))
        write(numbered(of_term.repartitionByRange("term", "kind").sortWithinPartitions("term", "kind")), "terms")
        write(numbered(rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"))), "kinds")
        links = edges if edges is not None else self.spark.createDataFrame([], "src string, dst string, kind string")
        ends = lambda a, b: F.struct(F.col(a).cast("string").alias("src"), F.col(b).cast("string").alias("dst"), F.col("kind"))
        both = links.select(F.inline(F.array(ends("src", "dst"), ends("dst", "src")))).filter("src is not null and dst is not null").distinct()
        write(numbered(both.repartitionByRange("src").sortWithinPartitions("src", "dst")), "edges")
        write(self.spark.createDataFrame([(number,)], "segment long"), "segments")  # from here on it is there
        return self.open()

    def _asked(self, query: str) -> list[str]:
        words = self.spark.createDataFrame([(query,)], "q string").select(F.array_distinct(self.analyser(F.col("q")))).first()
        return words[0] if words and words[0] else []

    def _weights(self, asked: list[str]) -> dict[tuple[str, str], dict[str, float]]:
        """Of each kind and term of a query: its weight, mean size, and the best that a posting can have."""
        stats: dict[tuple[str, str], list[Any]] = {}
        for r in self.terms.filter(F.col("term").isin(asked)).collect():  # segments times kinds times the query's words
            stats.setdefault((r.kind, r.term), []).append(r)
        out = {}
        for (kind, term), found in sorted(stats.items()):
            (n, total), df, often, size = self._kinds[kind], sum(r.df for r in found), max(r.max_often for r in found), min(r.min_size for r in found)
            idf = math.log(1 + (n - df + 0.5) / (df + 0.5)) if self.score == "bm25" else 1.0
            room = K1 * (1 - B + B * size / (total / n)) if self.score == "bm25" else 0.0
            best = idf * (often * (K1 + 1) / (often + room) if self.score == "bm25" else often)
            out[kind, term] = {"idf": idf, "mean": total / n, "room": room, "best": best, "often": often, "df": df}
        return out

    def _least_often(self, w: dict[str, float], missing: float) -> float:
        """The frequency that a posting needs for a part of ``missing``; more than any has, if none can."""
        x = missing / w["idf"] if w["idf"] > 0 else math.inf
        if x <= 0:
            return 0
        if self.score == "count":
            return math.ceil(x - 1e-9)
        return math.ceil(w["room"] * x / (K1 + 1 - x) - 1e-9) if x < K1 + 1 else w["often"] + 1

    def _scores(self, rows: DataFrame, weights: dict[tuple[str, str], dict[str, float]]) -> DataFrame:
        """Of ``rows(kind, term, id, often, size)``."""
        def of(name: str) -> Column:
            out = F.lit(None).cast("double")
            for (kind, term), w in weights.items():  # kinds times words
                out = F.when((F.col("kind") == kind) & (F.col("term") == term), w[name]).otherwise(out)
            return out

        part = of("idf") * self._part(F.col("often"), F.col("size"), of("mean"))
        return rows.select("kind", "id", part.alias("part")).groupBy("kind", "id").agg(F.round(F.sum("part"), 6).alias("score"))

    @staticmethod
    def _unpacked(blocks: DataFrame) -> DataFrame:
        rows = blocks.select("kind", "term", F.explode(F.arrays_zip("ids", "often", "size")).alias("p"))
        return rows.select("kind", "term", F.col("p.ids").alias("id"), "p.often", "p.size")

    def _in_full(self, ids: list[str], weights: dict[tuple[str, str], dict[str, float]]) -> DataFrame:
        asked = sorted({t for _, t in weights})
        words = self.nodes.filter(F.col("id").isin(ids)).select("kind", "id", "size", F.explode(F.arrays_zip("terms", "often")).alias("p"))
        return self._scores(words.select("kind", "id", "size", F.col("p.terms").alias("term"), "p.often").filter(F.col("term").isin(asked)), weights)

    def _part(self, often: Column, size: Column, mean: Column) -> Column:
        return often * (K1 + 1) / (often + K1 * (1 - B + B * size / mean)) if self.score == "bm25" else often.cast("double")

    def _top(self, scores: DataFrame, limit: int) -> DataFrame:
        order = Window.partitionBy("kind").orderBy(F.desc("score"), "id")
        return scores.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit)

    def _any(self, conditions: list[Column]) -> Column:
        out = F.lit(False)
        for c in conditions:
            out = out | c
        return out

    def blocks(self, query: str, limit: int = 20) -> tuple[DataFrame, dict[tuple[str, str], dict[str, float]]]:
        """The blocks that a search reads, and the weights of its terms."""
        asked = self._asked(query)
        weights = self._weights(asked) if asked else {}
        of = {key: (F.col("term") == key[1]) & (F.col("kind") == key[0]) for key in weights}
        reached: dict[str, float] = {}
        if sum(w["df"] for w in weights.values()) > PRUNE_FROM:  # else reading all is less than asking twice
            leading = self._scores(self._unpacked(self.postings.filter(F.col("first") & self._any(list(of.values())))), weights)
            best = self._in_full([r.id for r in self._top(leading, limit).select("id").collect()], weights)  # results of each kind
            last = self._top(best, limit).groupBy("kind").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
            reached = {r.kind: r.least for r in last.collect() if r.n == limit}  # one row a kind
        wanted = []
        for (kind, term), w in weights.items():
            others = sum(x["best"] for (k, t), x in weights.items() if k == kind and t != term)
            missing = reached.get(kind, 0.0) - 2e-6 - others
            least = self._least_often(w, missing)
            if least <= w["often"]:
                best = w["idf"] * self._part(F.col("max_often"), F.col("min_size"), F.lit(w["mean"]))
                wanted.append(of[kind, term] & (F.col("max_often") >= F.lit(int(least))) & (best >= F.lit(missing)))
        return self.postings.filter(self._any(wanted)), weights

    def search(self, query: str, limit: int = 20) -> DataFrame:
        """``kind, id, score, place``: the best ``limit`` of each kind; ties by id."""
        blocks, weights = self.blocks(query, limit)
        return self._top(self._scores(self._unpacked(blocks), weights), limit)

    def one_hop(self, query: str, limit: int = 20, kinds: Sequence[str] | None = None, neighbours: int = 5) -> DataFrame:
        """A search with the first neighbours of each hit (numbers by value) over edges of the given kinds, taken both ways."""
        found = self.search(query, limit)
        hits = found.collect()  # the best of each kind
        near = self.edges.filter(F.col("src").isin(sorted({r.id for r in hits})))
        near = near if kinds is None else near.filter(F.col("kind").isin(*kinds))
        first = near.select("src", "dst").distinct().withColumn("n", F.row_number().over(Window.partitionBy("src").orderBy(F.col("dst").try_cast("bigint").asc_nulls_last(), "dst"))).filter(F.col("n") <= neighbours)
        lists: dict[str, list[str]] = {}
        for r in sorted(first.collect(), key=lambda r: r.n):  # some for each hit
            lists.setdefault(r.src, []).append(r.dst)
        rows = [(r.kind, r.id, r.score, r.place, ",".join(lists.get(r.id, []))) for r in hits]
        return self.spark.createDataFrame(rows, "kind string, id string, score double, place int, neighbours string")
