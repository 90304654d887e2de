"""Benchmark decontamination by the q-gram lemma and banded alignment.

A passage of ``m`` characters that occurs with at most ``e`` edits shares at least
``m + 1 - q * (e + 1)`` q-grams with its place in the document, all on diagonals
within ``e`` of each other. Shared q-grams are counted in overlapping bands of
diagonals; bands that reach the bound are verified by banded alignment, and the
best place in the band is reported when it has at most ``e`` edits.

Texts and passages are compared in lower-case letters (A-Z) with each run of
``[\\x20\\x09-\\x0D]`` as one blank; spans refer to the code points of the original
text. ``e`` is ``rate * m``, and less where the lemma would ask for no q-gram.
Passages shorter than ``q`` cannot be told from chance and match nothing.

The benchmark is sent to the executors in blocks of at most ``BLOCK_CHARS``
characters, one after another over the whole table; an ordinary benchmark is one
block. Defined cases: null and empty texts and passages match nothing; repeated
rows are reported each; an empty benchmark or table gives no rows; null ids are
kept; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.words import mix

Q = 10
RATE = 0.08
#: Characters of passages that are broadcast at a time.
BLOCK_CHARS = 4_000_000
_CHUNK = 1 << 20
#: Pairs of equal q-grams that are expanded at a time, and cells of an alignment step.
_PAIRS, _CELLS = 1 << 20, 1 << 20
_STOP = 0x10FFFF  # between texts; no character of a text
_STOP_TEXT = chr(_STOP)
_TABLE_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points to compare, and the place of each in the text."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    blank = (code == 32) | ((code >= 9) & (code <= 13))
    code[blank] = 32
    code[(code >= 65) & (code <= 90)] += 32
    blank[1:] &= blank[:-1].copy()
    blank[:1] = False
    at = np.flatnonzero(~blank)
    return code[at], at


def grams(code: np.ndarray, q: int) -> np.ndarray:
    """A hash of the ``q`` characters from each place on."""
    n = len(code) - q + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        done, width, out, weight, power = 0, 1, np.zeros(n, np.uint64), code.astype(np.uint64), _BASE
        while True:  # by doubling: `weight` hashes `width` characters
            if q & width:
                out = out * power + weight[done : done + n]
                done += width
            if 2 * width > q:
                return mix(out)
            weight = weight[:-width] * power + weight[width:]
            power, width = power * power, 2 * width


@dataclass
class Index:
    ids: list[int | None]
    codes: list[np.ndarray]
    edits: np.ndarray
    needed: np.ndarray
    gram: np.ndarray
    item: np.ndarray
    pos: np.ndarray
    table: np.ndarray
    q: int


def budget(m: int, q: int, rate: float) -> int:
    return min(int(rate * m), m // q - 1)


def index(items: list[tuple[int | None, str | None]], q: int = Q, rate: float = RATE) -> Index:
    ids, codes = [], []
    for key, text in items:
        code = normalised(text or "")[0]
        a, b = (1 if len(code) and code[0] == 32 else 0), (len(code) - 1 if len(code) and code[-1] == 32 else len(code))
        if b - a >= q:
            ids.append(key), codes.append(code[a:b])
    parts = [grams(c, q) for c in codes]
    gram = np.concatenate([*parts, np.zeros(0, np.uint64)])
    item = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    pos = np.concatenate([*(np.arange(len(p)) for p in parts), np.zeros(0, np.int64)])
    order = np.argsort(gram, kind="stable")
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[gram >> np.uint64(64 - _TABLE_BITS)] = True
    size = np.array([len(c) for c in codes], np.int64)
    edits = np.array([budget(int(m), q, rate) for m in size], np.int64)
    return Index(ids, codes, edits, size + 1 - q * (edits + 1), gram[order], item[order], pos[order].astype(np.int64), table, q)


def _summed(keys: list[np.ndarray], often: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]), return_inverse=True)
    return key, np.bincount(at, np.concatenate([*often, np.zeros(0, np.int64)]), len(key)).astype(np.int64)


def _strip_counts(ix: Index, at: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared q-grams by strip of diagonals and item (``strip * items + item``); ``at`` in the text meets postings ``lo`` to ``lo + n``."""
    keys, often = [], []
    heavy = _heavy(at, lo, n)
    for places, postings in heavy.values():  # a gram that both sides repeat: its diagonals by a correlation
        for k in np.unique(ix.item[postings]):
            own = ix.pos[postings[ix.item[postings] == k]]
            first, last = int(places[0]), int(own[-1])
            a, b = np.zeros(int(places[-1]) - first + 1), np.zeros(last + 1)
            a[places - first], b[last - own] = 1, 1
            size = 1 << (len(a) + len(b)).bit_length()
            shared = np.rint(np.fft.irfft(np.fft.rfft(a, size) * np.fft.rfft(b, size), size)).astype(np.int64)
            d = np.flatnonzero(shared)
            keys.append((d + first - last) // (2 * ix.edits[k] + 1) * len(ix.ids) + k)
            often.append(shared[d])
    light = np.flatnonzero(~np.isin(lo, np.array(list(heavy), np.int64))) if heavy else np.arange(len(at))
    at, lo, n = at[light], lo[light], n[light]
    total = np.concatenate([[0], np.cumsum(n)])
    i = 0
    while i < len(at):  # so many pairs at a time
        j = max(i + 1, int(np.searchsorted(total, total[i] + _PAIRS, "right")) - 1)
        which = np.repeat(lo[i:j] - (total[i:j] - total[i]), n[i:j]) + np.arange(total[j] - total[i])
        item = ix.item[which]
        strip = (np.repeat(at[i:j], n[i:j]) - ix.pos[which]) // (2 * ix.edits[item] + 1)
        key, c = np.unique(strip * len(ix.ids) + item, return_counts=True)
        keys.append(key), often.append(c)
        i = j
    return _summed(keys, often)


def _heavy(at: np.ndarray, lo: np.ndarray, n: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places in the text and postings of grams whose pairs would be too many, by first posting."""
    if int(n.sum()) <= _PAIRS:
        return {}
    first, inverse = np.unique(lo, return_inverse=True)
    pairs = np.bincount(inverse, n, len(first))
    return {int(first[g]): (at[inverse == g], np.arange(first[g], first[g] + n[inverse == g][0])) for g in np.flatnonzero(pairs > _PAIRS // 4)}


def bands(ix: Index, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Item and first diagonal of the bands (two strips of diagonals each, so that bands overlap) with enough shared q-grams."""
    g = grams(code, ix.q)
    at = np.flatnonzero(ix.table[g >> np.uint64(64 - _TABLE_BITS)])
    lo, hi = np.searchsorted(ix.gram, g[at], "left"), np.searchsorted(ix.gram, g[at], "right")
    key, often = _strip_counts(ix, at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo])
    items = max(1, len(ix.ids))
    key, often = _summed([key, key - items], [often, often])  # the band before has this strip too
    item, band = key % items, key // items
    ok = often >= ix.needed[item]
    return item[ok], band[ok] * (2 * ix.edits[item[ok]] + 1)


def align(ix: Index, code: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits of each item within its band, and where it then starts and ends."""
    e = ix.edits[item]
    width = int((4 * e + 2 + 2 * e + 1).max())
    size = np.array([len(ix.codes[k]) for k in item])
    longest = int(size.max())
    pad, over = width + 2 * longest, int(e.max()) + 1
    text = np.concatenate([np.full(pad, _STOP), code.astype(np.int64), np.full(pad, _STOP)])
    pattern = np.full((len(item), longest), -1)
    for row, k in enumerate(item):
        pattern[row, : size[row]] = ix.codes[k]
    # Cell t of row i stands before text place base + i + t; values are edits * one + start.
    base, one = diagonal - e + pad, np.int64(1) << np.int64(32)
    cells = base[:, None] + np.arange(width)
    value = cells.copy()
    best = np.full(len(item), np.iinfo(np.int64).max)
    where = np.zeros(len(item), np.int64)
    for i in range(1, longest + 1):
        here = text[cells + i - 1]
        stop = (here == _STOP) * over
        same = value + ((here != pattern[:, i - 1 : i]) + stop) * one
        drop = np.full_like(value, np.iinfo(np.int64).max // 2)
        drop[:, :-1] = value[:, 1:] + one
        value = np.minimum(same, drop)
        grown = np.cumsum((1 + stop) * one, axis=1)
        value = np.minimum.accumulate(value - grown, axis=1) + grown
        done = size == i
        if done.any():
            t = value[done].argmin(1)
            best[done] = value[done, t]
            where[done] = cells[done, t] + i
    return best >> np.int64(32), (best & (one - 1)) - pad, where - pad


def _alignments(ix: Index, item: np.ndarray) -> Iterator[np.ndarray]:
    """Candidates to align together: of like size, and no more than ``_CELLS`` cells of a band or of passages."""
    size = np.array([len(ix.codes[k]) for k in item])
    order = np.lexsort((size, ix.edits[item]))
    i = 0
    while i < len(order):
        j, longest = i + 1, size[order[i]]
        while j < len(order) and (j + 1 - i) * max(6 * int(ix.edits[item[order[j]]]) + 3, longest := max(longest, size[order[j]])) <= _CELLS:
            j += 1
        yield order[i:j]
        i = j


def find(ix: Index, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
    """``(row, item, start, end, edits)`` of every passage found."""
    out: list[tuple[int, int, int, int, int]] = []
    row = 0
    while row < len(texts):
        first, parts, total = row, [], 0
        while row < len(texts) and (not parts or total < _CHUNK):
            parts.append((texts[row] or "").replace(_STOP_TEXT, "\ufffd"))
            total += len(parts[-1]) + 1
            row += 1
        code, place = normalised(_STOP_TEXT.join([*parts, ""]))
        begins = np.cumsum([0] + [len(p) + 1 for p in parts])
        item, diagonal = bands(ix, code)
        seen: dict[tuple[int, int], tuple[int, int, int]] = {}
        for mine in _alignments(ix, item):
            some = item[mine]
            edits, a, b = align(ix, code, some, diagonal[mine])
            for j in np.flatnonzero(edits <= ix.edits[some]):
                key, got = (int(some[j]), int(b[j])), (int(edits[j]), int(a[j]), int(b[j]))
                seen[key] = min(seen.get(key, got), got)
        places: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for (k, _), (edits, a, b) in sorted(seen.items(), key=lambda x: (x[0][0], x[1])):
            local = int(np.searchsorted(begins, place[a], "right")) - 1
            span = (int(place[a] - begins[local]), int(place[b - 1] - begins[local]) + 1)
            taken = places.setdefault((local, k), [])
            if all(y <= span[0] or span[1] <= x for x, y in taken):  # else the same place with no fewer edits
                taken.append(span)
                out.append((first + local, k, *span, edits))
    return out


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", q: int = Q, rate: float = RATE) -> DataFrame:
    """``doc, item, start, end, edits`` for every place where a document holds a passage."""
    return _matches(docs, benchmark, id_col, text_col, item_col, item_text_col, q, rate).drop("row")


def _matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", q: int = Q, rate: float = RATE) -> DataFrame:
    """:func:`matches` and ``row``, the hash of the text."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).filter(F.length("text") >= q)
    total = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // BLOCK_CHARS))
    found = []
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()  # about BLOCK_CHARS characters
        shared = spark.sparkContext.broadcast(index(sorted(((r["item"], r["text"]) for r in mine), key=lambda x: (x[0] is None, x[0] or 0, x[1])), q, rate))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            names = ["doc", "item", "start", "end", "edits", "row"]
            for batch in batches:
                ids, rows, hits = batch.column(0).to_pylist(), batch.column(2).to_pylist(), find(shared.value, batch.column(1).to_pylist())
                columns = [[ids[h[0]] for h in hits], [shared.value.ids[h[1]] for h in hits], *([h[k] for h in hits] for k in (2, 3, 4)), [rows[h[0]] for h in hits]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        found.append(docs.select(F.col(id_col).cast("long"), text_col, F.xxhash64(text_col)).mapInArrow(run, "doc long, item long, start long, end long, edits long, row long"))
    return reduce(DataFrame.unionByName, found)


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:  # noqa: ANN003
    """The rows of ``docs`` without a match; of rows that share an id, also null, each is judged by its own text."""
    found = _matches(docs, benchmark, id_col, text_col, **options).select(F.col("doc").alias("__doc"), F.col("row").alias("__row")).distinct()
    return docs.join(found, docs[id_col].cast("long").eqNullSafe(found["__doc"]) & (F.xxhash64(docs[text_col]) == found["__row"]), "left_anti")
