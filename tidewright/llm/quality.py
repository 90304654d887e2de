"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the text alone. The trees are grown in numpy on the driver
from at most ``max_rows`` labelled rows (those with the smallest hash of their
id, a bounded sample), flattened into arrays, broadcast, and walked for all rows
of an Arrow batch at a time; every row of the table is scored on its whole text.

Defined cases: null and empty texts have zero statistics and a score; rows that
repeat an id are scored each; a null id is never a training row; labels that are
null are ignored and several labels of one id all count; without labelled rows
the score is 0.5, with one class only it is near that class's share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.words import chunks, word_hashes, word_spans

#: Labelled rows that are fitted on at most.
MAX_ROWS = 20_000
THRESHOLD = 0.3

_CLASS = np.zeros(256, np.int64)  # 0: other symbols
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[0x20, 9, 11, 12, 13]], _CLASS[10], _CLASS[128:] = 4, 5, 6
_CLASS[[ord(c) for c in ".,;:!?'\"-()"]] = 7

FEATURES = (
    "log_bytes", "log_words", "log_lines", "symbols", "lower", "upper", "digits", "blanks", "high_bytes", "punctuation",
    "word_bytes", "word_bytes_spread", "longest_word", "distinct_words", "top_word", "same_as_last", "odd_endings", "line_bytes", "repeated_lines", "short_lines", "words_in_line",
)


def features(texts: pa.Array) -> np.ndarray:
    """One row of :data:`FEATURES` for each text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, j, data, at in chunks(texts):
        start, end, first = word_spans(data, at)
        hashes, size = word_hashes(data, start, end), end - start
        kinds = _CLASS[data]
        breaks = np.flatnonzero(data == 10)
        from_break = np.searchsorted(breaks, at)
        last = kinds[end - 1] if len(end) else np.zeros(0, np.int64)
        for row in range(j - i):
            a, b, w, v = at[row], at[row + 1], first[row], first[row + 1]
            if b == a:
                continue
            x, n = out[i + row], float(b - a)
            share = np.bincount(kinds[a:b], minlength=8) / n
            lines = breaks[from_break[row] : from_break[row + 1]] - a
            edges = np.concatenate(([-1], lines, [b - a]))
            long = np.diff(edges) - 1
            x[0], x[1], x[2] = np.log1p(n), np.log1p(v - w), np.log1p(len(long))
            x[3:10] = share[[0, 1, 2, 3, 4, 6, 7]]
            if v > w:
                h, s = hashes[w:v], size[w:v]
                _, often = np.unique(h, return_counts=True)
                x[10], x[11], x[12] = s.mean(), s.std(), np.log1p(s.max())
                x[13], x[14] = len(often) / (v - w), often.max() / (v - w)
                x[15] = (h[1:] == h[:-1]).mean() if v - w > 1 else 0
                x[16] = np.isin(last[w:v], (0, 3)).mean()
            x[17] = np.log1p(long.mean())
            if len(long) > 1:
                keys = [data[a + p + 1 : a + q].tobytes() for p, q in zip(edges[:-1], edges[1:], strict=True)]
                x[18] = 1 - len(set(keys)) / len(keys)
            x[19], x[20] = (long < 40).mean(), (v - w) / len(long)
    return out


@dataclass
class Trees:
    """All trees in flat arrays: a node's children are at ``left`` and ``left + 1``; leaves point to themselves."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                down = self.left[at]
                at = np.where(down < 0, at, down + (x[rows, self.feature[at]] > self.cut[at]))
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: int = 10, ridge: float = 1.0) -> Trees:
    """Logistic loss; splits are sought over ``bins`` quantile bins of each feature."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    feature, cut, left, value, roots = [], [], [], [], []
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
        total = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-total))
            g, h = p - y, p * (1 - p)
            node = np.full(len(y), len(feature))
            roots.append(len(feature))
            feature.append(0), cut.append(0.0), left.append(-1), value.append(0.0)
            level = [roots[-1]]
            for _ in range(depth):
                low = level[0]
                live = node >= low
                k, own = len(level), node[live] - low
                gain, split = np.full(k, 1e-6), np.full((k, 2), -1)
                gs, hs = np.bincount(own, g[live], k), np.bincount(own, h[live], k)
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    m = len(e) + 1
                    key = own * m + binned[live, f]
                    gl, hl, nl = (np.cumsum(np.bincount(key, w, k * m).reshape(k, m), 1)[:, :-1] for w in (g[live], h[live], None))
                    n = np.bincount(own, minlength=k)[:, None]
                    gr, hr = gs[:, None] - gl, hs[:, None] - hl
                    better = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (gs**2 / (hs + ridge))[:, None]
                    better[(nl < least) | (n - nl < least)] = -1
                    best = better.argmax(1)
                    top = better[np.arange(k), best]
                    take = top > gain
                    gain[take], split[take] = top[take], np.stack([np.full(k, f), best], 1)[take]
                new = []
                for i, at in enumerate(level):
                    if split[i, 0] < 0:
                        continue
                    f, b = split[i]
                    feature[at], cut[at], left[at] = int(f), float(edges[f][b]), len(feature)
                    mine = node == at
                    node[mine] = left[at] + (binned[mine, f] > b)
                    for _ in range(2):
                        new.append(len(feature))
                        feature.append(0), cut.append(0.0), left.append(-1), value.append(0.0)
                if not new:
                    break
                level = new
            used = np.unique(node)
            gs, hs = np.bincount(node, g, len(feature)), np.bincount(node, h, len(feature))
            for at in used:
                value[at] = float(-rate * gs[at] / (hs[at] + ridge))
            total += np.array(value)[node]
    return Trees(np.array(feature, np.int64), np.array(cut), np.array(left, np.int64), np.array(value), np.array(roots, np.int64), base, depth)


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS) -> Trees:
    """Trees from the labelled rows whose fold is not 0."""
    marked = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).filter(fold(id_col, folds) != 0)
    marked = marked.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("__y")).orderBy(F.xxhash64("__id"), "__id", "__y").limit(max_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(marked), "__id")  # at most max_rows rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64())), batch.column(3)], ["id", "y", "x", "hash"])

    stated = rows.select("__id", "__y", "__text", F.xxhash64("__id", "__text")).mapInArrow(run, "id long, y int, x array<double>, hash long")
    # An id that many rows repeat could bring more rows than labels; of those too the smallest hashes count.
    got = stated.orderBy("hash", "id", "y", "x").limit(max_rows).collect()
    got.sort(key=lambda r: (r["id"], r["y"], r["x"]))
    x = np.array([r["x"] for r in got]).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["y"] for r in got], float))


def score(docs: DataFrame, trees: Trees, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality in ``out_col``; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("double")  # type: ignore[call-overload]
    def of(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(shared.value.score(features(pa.array(texts, pa.string(), from_pandas=True))))

    return docs.withColumn(out_col, of(F.col(text_col)))
