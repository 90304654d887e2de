"""Which texts contain which needles, both tables of any size: a join on one rare gram of each needle.

1. Runs of eight bytes of all texts are counted in a sketch of fixed size. A needle's
   key is its run with the smallest count (a shorter needle is its own key).
2. A bitmap of fixed size, of the keys' hashes, keeps most runs of a text from the
   shuffle; what passes is joined with the needles on the run's hash.
3. Texts and the needles found for them meet on a hash of the text, and containment
   itself decides; nothing but rows to be compared depends on sketch, bitmap or hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.words import chunks, mix
from ..scratch import Scratch

#: Bytes of a key, counters of the sketch, and bits of the bitmap.
GRAM, COUNTERS, BITS = 8, 1 << 16, 1 << 26
_BATCH = 1 << 16


def _grams(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` bytes that lie in one text, and the place of that text."""
    n = len(data)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    whole = at[text + 1] - np.arange(n) >= size
    padded = np.concatenate((data, np.zeros(size, np.uint8)))
    out = np.full(n, size, np.uint64) << np.uint64(56) if size < GRAM else np.zeros(n, np.uint64)
    for k in range(size):
        out |= padded[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    return mix(out[whole]), text[whole]


def _counts(texts: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, _, data, at in chunks(batch.column(0)):
                total += np.bincount((_grams(data, at, GRAM)[0] % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot])], ["slot", "n"])

    out = np.zeros(COUNTERS, np.int64)
    for r in texts.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # one row a counter
        out[r.slot] = r.n
    return out


def _keyed(needles: DataFrame, needle_col: str, counts: np.ndarray) -> DataFrame:
    """Adds ``__key``, the hash of each needle's rarest run, and ``__size``, its bytes; null and empty needles go."""
    shared = needles.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for batch in batches:
            key, length = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.int64)
            for i, j, data, at in chunks(batch.column(needle_col)):
                length[i:j] = np.diff(at)
                for size in np.unique(np.minimum(length[i:j], GRAM)):
                    grams, text = _grams(data, at, int(size))
                    mine = np.minimum(length[i + text], GRAM) == size
                    grams, text = grams[mine], text[mine]
                    order = np.lexsort((grams, seen[(grams % np.uint64(COUNTERS)).astype(np.int64)], text))
                    first = np.unique(text[order], return_index=True)[1]
                    key[i + text[order[first]]] = grams[order[first]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key.view(np.int64)), pa.array(np.minimum(length, GRAM))], [*batch.schema.names, "__key", "__size"])

    schema = StructType([*needles.schema.fields, StructField("__key", LongType()), StructField("__size", LongType())])
    return needles.filter(F.length(needle_col) > 0).mapInArrow(run, schema)


def _bitmap(keyed: DataFrame) -> np.ndarray:
    """A bit for each key's hash; the cluster puts it together, 64 bits a row."""
    slot = F.col("__key").bitwiseAND(F.lit(BITS - 1))
    word = keyed.select(F.shiftright(slot, 6).alias("word"), F.expr("shiftleft(1L, cast(__key & 63 as int))").alias("bit"))
    out = np.zeros(BITS // 64, np.uint64)
    for r in word.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():  # as many as the bitmap has words, at most
        out[r.word] = np.uint64(r.bits & (2**64 - 1))
    return out


def mentions(docs: DataFrame, needles: DataFrame, needle_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the other columns of each needle that the text contains, once for each row of both.

    Null and empty needles are in nothing, null texts contain nothing. Any number of needles.
    """
    spark = docs.sparkSession
    rest = [c for c in needles.columns if c != needle_col]
    texts = docs.select(F.col(text_col).alias("__text")).filter(F.length("__text") > 0)
    scratch = Scratch(spark, "mentions")
    keyed = scratch.save(_keyed(needles, needle_col, _counts(texts)), "needles")
    sizes = [int(r["__size"]) for r in keyed.select("__size").distinct().collect()]  # from 1 to GRAM
    schema = StructType([docs.schema[id_col], *(needles.schema[c] for c in rest)])
    if not sizes:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(_bitmap(keyed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            texts_of = batch.column(1).to_numpy(zero_copy_only=False)
            for i, _, data, at in chunks(batch.column(0)):
                for size in sizes:
                    grams, text = _grams(data, at, size)
                    slot = grams & np.uint64(BITS - 1)
                    hit = (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
                    pairs = np.unique(np.stack((texts_of[i + text[hit]], grams[hit].view(np.int64)), 1), axis=0)
                    for k in range(0, len(pairs), _BATCH):
                        yield pa.RecordBatch.from_arrays([pa.array(pairs[k : k + _BATCH, c]) for c in (0, 1)], ["__text_key", "__key"])

    runs = texts.select("__text", F.xxhash64("__text").alias("__text_key")).mapInArrow(run, "__text_key long, __key long")
    # Copies of a text gave the same rows.
    found = runs.distinct().join(keyed.drop("__size"), "__key").select("__text_key", F.col(needle_col).alias("__needle"), *(F.col(c).alias(f"__n_{k}") for k, c in enumerate(rest)))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).withColumn("__text_key", F.xxhash64("__text"))
    whole = rows.join(found, "__text_key").filter(F.contains("__text", "__needle"))
    return whole.select(F.col("__id").alias(id_col), *(F.col(f"__n_{k}").alias(c) for k, c in enumerate(rest)))
