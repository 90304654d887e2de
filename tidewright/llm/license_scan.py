"""Licences named in texts: ordered signature rules over normalised words.

A text's words are runs of digits, letters a to z (A-Z count as a-z) and characters
beyond ASCII. The words, with one blank between, are searched as bytes:

1. A rule of :mod:`.license_rules` is tried only where the text holds the words that every
   match of it has.
2. Every match is a detection: a range of words with a label, a priority and a weight.
3. A detection inside one of an earlier priority, or inside a longer one of the
   same, is suppressed; so is the same range by a later rule. Whatever is suppressed
   by a suppressed detection also lies inside the one that suppressed that, so that
   detections can be judged all at once.
4. A text's score is the chance that one of its labels is right, if the weights of
   labels were independent chances; 0 without detections.

Places of base phrases are kept whatever covers them.

Defined cases: null and empty texts have no words; rows that repeat an id are
scanned each; a null id stays; ties go to the earlier rule; texts are scanned
whole, however long, and normalised a piece at a time; an empty table gives no rows;
extra columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_rules import Rule, rules

PIECE = 1 << 20
_TO = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Detection(NamedTuple):
    rule: Rule
    start: int  # words
    end: int


@lru_cache(maxsize=1)
def _table() -> tuple[list[Rule], frozenset[bytes], list[tuple[tuple[frozenset[bytes], ...], Rule]]]:
    table = rules()
    gates = [(tuple(frozenset(w.encode() for w in words) for words in r.words), r) for r in table]
    return table, frozenset(w for sets, _ in gates for words in sets for w in words), gates


def normalised(raw: bytes) -> tuple[bytes, int, set[bytes]]:
    """The words of a text with a blank before and after each, their number, and those that rules ask for."""
    keywords = _table()[1]
    raw = raw.translate(_TO)
    parts, n, found, i = [], 0, set(), 0
    while i < len(raw):
        j = raw.find(b" ", i + PIECE)
        j = len(raw) if j < 0 else j
        words = raw[i:j].split()
        found.update(keywords.intersection(words))
        n += len(words)
        if words:
            parts.append(b" ".join(words))
        i = j
    return b" " + b" ".join(parts) + b" " if n else b"", n, found


def detections(text: bytes, found: set[bytes]) -> list[Detection]:
    """All matches of all rules that the words found let pass."""
    out: list[Detection] = []
    blanks: np.ndarray | None = None
    for sets, rule in _table()[2]:
        if not any(words <= found for words in sets):
            continue
        for m in rule.pattern.finditer(text):
            if blanks is None:
                blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
            a, b = np.searchsorted(blanks, (m.start(), m.end()))
            out.append(Detection(rule, int(a) - 1, int(b)))
    return out


def survivors(found: list[Detection]) -> list[Detection]:
    """Detections that no stronger one contains, by place. Of equal ranges and priorities the earliest rule stays."""
    order = sorted(found, key=lambda d: (d.start, -d.end, d.rule.priority, d.rule.number))
    kept: list[Detection] = []
    #: By priority: the furthest end so far of detections that start no later.
    furthest: list[int] = []
    for d in order:
        p = d.rule.priority
        furthest += [-1] * (p + 1 - len(furthest))
        inside = any(end >= d.end for end in furthest[: p + 1])
        # What starts at the same word and ends later came before; an earlier priority with the same range too.
        furthest[p] = max(furthest[p], d.end)
        if not inside:
            kept.append(d)
    return kept


def score(labels: dict[str, float]) -> float:
    miss = 1.0
    for label in sorted(labels):
        miss *= 1.0 - labels[label]
    return 1.0 - miss


def _characters(raw: bytes, words: list[int]) -> dict[int, tuple[int, int]]:
    """Start and end of some words in characters of the text."""
    data = np.frombuffer(raw, np.uint8)
    word = np.frombuffer(raw.translate(_TO), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    character = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return {w: (int(character[edge[2 * w]]), int(character[edge[2 * w + 1]])) for w in words}


_FOUND = "array<struct<rule: int, label: string, priority: int, start: long, end: long, char_start: long, char_end: long, text: string>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_words``, ``base`` (places of base phrases), ``found`` (detections that are not suppressed), ``score``.

    Places are words from 0 and characters, the end exclusive, with the text there.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("rule", pa.int32()), ("label", pa.string()), ("priority", pa.int32()), *((c, pa.int64()) for c in ("start", "end", "char_start", "char_end")), ("text", pa.string())]))
        for batch in batches:
            count, base, rest, scores = [], [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                raw = text.encode()
                flat, n, words = normalised(raw)
                matches = detections(flat, words)
                of_base = sorted((d for d in matches if d.rule.base), key=lambda d: (d.start, d.rule.number))
                stay = survivors(matches)
                at = _characters(raw, sorted({w for d in matches for w in (d.start, d.end - 1)})) if matches else {}

                def described(some: list[Detection], at: dict[int, tuple[int, int]] = at, text: str = text) -> list[dict]:
                    ends = [(at[d.start][0], at[d.end - 1][1]) for d in some]
                    return [dict(rule=d.rule.number, label=d.rule.label, priority=d.rule.priority, start=d.start, end=d.end, char_start=a, char_end=b, text=text[a:b]) for d, (a, b) in zip(some, ends, strict=True)]

                weights: dict[str, float] = {}
                for d in [*of_base, *stay]:
                    weights[d.rule.label] = max(weights.get(d.rule.label, 0.0), d.rule.weight)
                count.append(n)
                base.append(described(of_base))
                rest.append(described(stay))
                scores.append(score(weights))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(base, kinds), pa.array(rest, kinds), pa.array(scores, pa.float64())], ["id", "n_words", "base", "found", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(rows, f"id {kind}, n_words long, base {_FOUND}, found {_FOUND}, score double")
