"""Alignment of two tokenizers' tokens over the same bytes, and how common each linked pair of ids is.

A is a byte-level BPE, B a sentence-piece BPE with byte fallback that puts one
space before the text; both cut the bytes of a space and the text.

1. A block of texts is laid out byte after byte. Packed bitsets mark the last
   byte of each token of A and of B. Their AND marks the shared cuts, their OR the
   segments in which exactly one token of A meets exactly one of B.
2. Counts of set bits before a word, and within it, turn a byte into the number
   of tokens that ended before it (rank); unpacking turns marks into bytes
   (select). Shared cuts so become ranges of tokens (groups), and segments become
   links: all pairs of tokens whose bytes overlap.
3. A block keeps a dictionary of its distinct id pairs with the number of its
   documents that hold each; dictionaries are added up over the corpus, and the
   sums come back block by block (:mod:`.block_lookup`). A pair that nearly all
   documents hold costs one row a block.

Both tokenizers work on the stretches between a character that is no white space
and a space, which no token of either crosses; a stretch's tokens are kept for
as long as a bounded table of them lasts.

Defined cases: null and empty texts, and those where a tokenizer's bytes are not
the space and the text (B writes U+2581 as a space), have no tokens, hence zeros
and an empty digest; rows that repeat an id or a text are documents of their own;
a null id stays; ties for the highest count all count as best; an empty table
gives no rows; extra columns of the input, whatever their names, are not read.
A block ends with the text that takes it over :data:`BLOCK_BYTES`; a longer text is a
block of its own.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import Scratch
from .block_lookup import entries, look_up, numbers
from .tokens import encode_plain, vocabulary

BLOCK_BYTES = 2 << 20
#: Stretches whose tokens a worker remembers, and the longest that it does.
REMEMBERED, MOST_CHARS = 200_000, 64

_STRETCH = re.compile(r"(?<=\S)(?= )")
#: Where splitting at each single space would not give the stretches.
_UNEVEN = re.compile(r"\s |^ | $")


class Marks:
    """Set bits among ``n`` packed ones, with their ranks."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @classmethod
    def at(cls, places: np.ndarray, n: int) -> Marks:
        bits = np.zeros((n // 64 + 1) * 64, bool)
        bits[places] = True
        return cls(np.packbits(bits, bitorder="little").view(np.uint64))

    def __and__(self, other: Marks) -> Marks:
        return Marks(self.words & other.words)

    def __or__(self, other: Marks) -> Marks:
        return Marks(self.words | other.words)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many are set before each place."""
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & low)

    def places(self) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


def _byte_level() -> dict[str, int]:
    """Which byte each character of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the stretches seen so far."""

    def __init__(self, a: str, b: str) -> None:
        import sentencepiece

        from .tokens import _plain

        self.a_path, self.pieces = a, sentencepiece.SentencePieceProcessor(model_file=b)
        bytes_of, slow = _byte_level(), _plain(a)
        _plain.cache_clear()  # needed again for very long runs only
        self.a = [bytes(bytes_of[c] for c in slow.id_to_token(i)) if i < 50256 else slow.id_to_token(i).encode() for i in range(slow.get_vocab_size())]
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.vocab_size())]
        self.b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.splits = not any(re.search("[^▁]▁", p) for p in names)
        self.blank = [names.index("▁")]
        self.a_bytes, self.b_bytes = (np.array([len(x) for x in t], np.int64) for t in (self.a, self.b))
        self.seen: dict[str, tuple[bytes, bytes] | None] = {}
        # Each token as text before what follows it: another of the group, the other tokenizer's, the next group.
        decimal = [str(i).encode() for i in range(max(len(self.a), len(self.b)))]
        self.written = [d + end for end, n in ((b",", len(self.a)), (b"|", len(self.a)), (b",", len(self.b)), (b";", len(self.b))) for d in decimal[:n]]

    def _ids_of_a(self, stretches: list[str]) -> list[bytes]:
        """Short stretches that end in no white space are cut as one text: no token crosses from one to the next."""
        alone = [len(s) > MOST_CHARS or s[-1].isspace() for s in stretches]
        whole = [s for s, x in zip(stretches, alone, strict=True) if not x]
        ids = np.array(encode_plain("".join(whole), self.a_path), np.int32)
        ends = np.cumsum([len(s.encode()) for s in whole], dtype=np.int64)
        to = (np.searchsorted(np.cumsum(self.a_bytes[ids]), ends, "right") * 4).tolist()
        raw = ids.tobytes()
        cut = iter([raw[i:j] for i, j in zip([0, *to], to, strict=False)])
        return [array("i", encode_plain(s, self.a_path)).tobytes() if x else next(cut) for s, x in zip(stretches, alone, strict=True)]

    def _tokens(self, stretches: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Of each stretch, which starts with a space, the ids of A and B as 32-bit integers, or None where either's bytes differ."""
        ids_a = self._ids_of_a(stretches)
        ids_b = [array("i", b if s != " " else self.blank).tobytes() for s, b in zip(stretches, self.pieces.encode([s[1:] for s in stretches], num_threads=1), strict=True)]
        raw = [s.encode() for s in stretches]
        bad: set[int] = set()
        for ids, table, size in ((ids_a, self.a, self.a_bytes), (ids_b, self.b, self.b_bytes)):
            # Told from all joined bytes and the lengths of each, or else one by one.
            flat = np.frombuffer(b"".join(ids), np.int32)
            total = np.concatenate(([0], np.cumsum(size[flat])))[np.cumsum([0, *map(len, ids)]) // 4]
            if not np.array_equal(np.diff(total), [*map(len, raw)]) or b"".join(map(table.__getitem__, flat.tolist())) != b"".join(raw):
                bad.update(k for k, (x, r) in enumerate(zip(ids, raw, strict=True)) if b"".join(map(table.__getitem__, np.frombuffer(x, np.int32).tolist())) != r)
        return [None if k in bad else pair for k, pair in enumerate(zip(ids_a, ids_b, strict=True))]

    def stretches(self, text: str) -> list[str]:
        if not self.splits:
            return [f" {text}"]
        if _UNEVEN.search(text):
            return _STRETCH.split(f" {text}")
        return [f" {word}" for word in text.split(" ")]

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """The ids of A and of B in each text, as 32-bit integers."""
        parts = [self.stretches(t) if t else [] for t in texts]
        met = {s for part in parts for s in part}
        new = list(met.difference(self.seen))
        tokens = dict(zip(new, self._tokens(new), strict=True))
        if len(self.seen) + len(new) > REMEMBERED:
            self.seen = {s: self.seen[s] for s in met.intersection(self.seen)}
        found = self.seen | tokens
        self.seen.update((s, v) for s, v in tokens.items() if len(s) <= MOST_CHARS and len(self.seen) < REMEMBERED)
        out = []
        for part in parts:
            values = [found[s] for s in part]
            out.append((b"", b"") if None in values else (b"".join([v[0] for v in values]), b"".join([v[1] for v in values])))
        return out


@lru_cache(maxsize=2)
def _vocabularies(a: str, b: str) -> Vocabularies:
    return Vocabularies(a, b)


class Aligned(NamedTuple):
    """A block of documents. Arrays end in ``_of`` where they have one more entry than documents, from which to which one's are."""

    a: np.ndarray
    b: np.ndarray
    a_of: np.ndarray
    b_of: np.ndarray
    group_a: np.ndarray  # of each group the first token of A, and one more
    group_b: np.ndarray
    group_of: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_of: np.ndarray
    start: np.ndarray  # of each link the first byte and the one after its last, in its document's space and text
    end: np.ndarray


def align_block(texts: list[str | None], words: Vocabularies) -> Aligned:
    tokens = words.encode(texts)
    a_of, b_of = (np.concatenate(([0], np.cumsum([len(t[k]) // 4 for t in tokens], dtype=np.int64))) for k in (0, 1))
    a, b = (np.frombuffer(b"".join([t[k] for t in tokens]), np.int32).astype(np.int64) for k in (0, 1))
    a_end, b_end = np.cumsum(words.a_bytes[a]), np.cumsum(words.b_bytes[b])
    byte_of = np.concatenate(([0], a_end))[a_of]
    n = int(byte_of[-1])
    ends_a, ends_b = Marks.at(a_end - 1, n), Marks.at(b_end - 1, n)
    shared, either = ends_a & ends_b, ends_a | ends_b
    cuts, segments = shared.places(), either.places()
    link_of = either.rank(byte_of)
    end = segments + 1
    start = np.concatenate(([0], end[:-1])) if len(end) else end
    base = np.repeat(byte_of[:-1], np.diff(link_of))
    return Aligned(
        a, b, a_of, b_of, np.concatenate(([0], ends_a.rank(cuts + 1))), np.concatenate(([0], ends_b.rank(cuts + 1))), shared.rank(byte_of),
        ends_a.rank(segments), ends_b.rank(segments), link_of, start - base, end - base,
    )


def digests(block: Aligned, words: Vocabularies) -> list[str]:
    """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    n_a, n_b = np.diff(block.group_a), np.diff(block.group_b)
    shape = np.zeros(len(block.a) + len(block.b), np.int64)
    # A group's tokens of A stand behind all tokens of the groups before it, those of B behind them.
    a_at = np.arange(len(block.a)) + np.repeat(block.group_b[:-1], n_a)
    b_at = np.arange(len(block.b)) + np.repeat(block.group_a[1:], n_b)
    last_a, last_b = block.group_a[1:] - 1, block.group_b[1:] - 1
    many_a, many_b = len(words.a), len(words.b)
    shape[a_at], shape[b_at] = block.a, block.b + 2 * many_a
    shape[a_at[last_a]] += many_a
    shape[b_at[last_b]] += many_b
    out, of = [], block.a_of + block.b_of
    for i in range(len(of) - 1):
        if of[i] == of[i + 1]:
            out.append("")
            continue
        sha = hashlib.sha256()
        for at in range(of[i], of[i + 1], 1 << 20):
            last = min(at + (1 << 20), of[i + 1])
            text = b"".join(map(words.written.__getitem__, shape[at:last].tolist()))
            sha.update(text if last < of[i + 1] else text[:-1])
        out.append(sha.hexdigest())
    return out


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of about :data:`BLOCK_BYTES` of text."""
    first, held = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        held += n or 0
        if held >= BLOCK_BYTES:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def groups_and_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str | None = None, b: str | None = None) -> DataFrame:
    """Each document's ids, groups and links in full.

    ``id``, ``a_ids``, ``b_ids``; ``groups`` by the first tokens (``a``, ``b``) of each; ``links`` by
    tokens (``a``, ``b``) and the bytes they share (``start``, ``end``) of a space and the text.
    """
    a, b = a or vocabulary(), b or vocabulary("piece_bpe_32k.model")
    kind = docs.schema[id_col].dataType
    pair = [T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]
    shared = [T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    ids = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("id", kind), T.StructField("a_ids", ids), T.StructField("b_ids", ids), T.StructField("groups", T.ArrayType(T.StructType(pair))), T.StructField("links", T.ArrayType(T.StructType(pair + shared)))])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _vocabularies(a, b)
        for batch in batches:
            for i, j in _runs(batch.column(1)):
                x = align_block(batch.column(1).slice(i, j - i).to_pylist(), words)
                of_link_a, of_link_b = (np.repeat(of[:-1], np.diff(x.link_of)) for of in (x.a_of, x.b_of))
                of_group_a, of_group_b = (np.repeat(of[:-1], np.diff(x.group_of)) for of in (x.a_of, x.b_of))
                groups = pa.StructArray.from_arrays([pa.array(x.group_a[:-1] - of_group_a), pa.array(x.group_b[:-1] - of_group_b)], ["a", "b"])
                links = pa.StructArray.from_arrays([pa.array(v) for v in (x.link_a - of_link_a, x.link_b - of_link_b, x.start, x.end)], ["a", "b", "start", "end"])
                lists = [pa.ListArray.from_arrays(pa.array(of, pa.int32()), v) for of, v in ((x.a_of, pa.array(x.a)), (x.b_of, pa.array(x.b)), (x.group_of, groups), (x.link_of, links))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *lists], schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(align, schema)


def score_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str | None = None, b: str | None = None) -> DataFrame:
    """Counts of each document's tokens, groups and links, and how common its links are in the corpus.

    ``n_best``: links of which no other id of B is linked with that id of A in more documents;
    ``count_sum``: over links, the number of documents that hold the pair of ids linked.
    """
    a, b = a or vocabulary(), b or vocabulary("piece_bpe_32k.model")
    kind = docs.schema[id_col].dataType
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    fields = [T.StructField("block", T.LongType()), T.StructField("id", kind), *(T.StructField(c, T.LongType()) for c in counts), T.StructField("groups_sha256", T.StringType())]
    vectors = [T.StructField("places", T.BinaryType()), T.StructField("times", T.BinaryType()), T.StructField("pair", T.ArrayType(T.LongType())), T.StructField("docs", T.ArrayType(T.IntegerType()))]
    kept = T.StructType(fields + vectors)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = _vocabularies(a, b), numbers()
        for batch in batches:
            for i, j in _runs(batch.column(1)):
                n = j - i
                x = align_block(batch.column(1).slice(i, n).to_pylist(), words)
                pairs, place = np.unique((x.a[x.link_a] << 32) | x.b[x.link_b], return_inverse=True)
                most = max(1, len(pairs))
                held, times = np.unique(np.repeat(np.arange(n), np.diff(x.link_of)) * most + place, return_counts=True)
                doc, place = held // most, (held % most).astype(np.int32)
                of = np.searchsorted(doc, np.arange(n + 1)) * 4
                in_docs = np.bincount(place, minlength=len(pairs)).astype(np.int32)
                raw = [(place.tobytes(), of), (times.astype(np.int32).tobytes(), of)]
                first = [[v] + [None] * (n - 1) for v in (pairs, in_docs)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, next(number))), batch.column(0).slice(i, n), *(pa.array(np.diff(v)) for v in (x.a_of, x.b_of, x.group_of, x.link_of)), pa.array(digests(x, words), pa.string()),
                        *(pa.array([data[s:e] for s, e in zip(o[:-1], o[1:], strict=True)], pa.binary()) for data, o in raw), pa.array(first[0], pa.list_(pa.int64())), pa.array(first[1], pa.list_(pa.int32())),
                    ],
                    kept.names,
                )

    scratch = Scratch(docs.sparkSession, "alignment")
    blocks = scratch.save(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(align, kept), "blocks")

    held = entries(blocks, "pair", "docs")
    of_pair = held.groupBy("pair").agg(F.sum("docs").alias("n"))
    highest = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))  # one id of A meets at most B's vocabulary
    found = held.select("block", "place", "pair").join(of_pair.select("pair", "n", (F.col("n") == highest).alias("best")), "pair").select("block", "place", "n", "best")

    def total(rows: pa.Table, values: pa.Table) -> pa.Table:
        n, best = (values.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "best"))
        sums = []
        for place, times in zip(rows.column("places").to_pylist(), rows.column("times").to_pylist(), strict=True):
            at, k = np.frombuffer(place, np.int32), np.frombuffer(times, np.int32).astype(np.int64)
            sums.append((int(best[at] @ k), int(n[at] @ k)))
        out = [rows.column(c) for c in ("id", *counts)]
        return pa.Table.from_arrays([*out, *(pa.array([s[k] for s in sums], pa.int64()) for k in (0, 1)), rows.column("groups_sha256")], ["id", *counts, "n_best", "count_sum", "groups_sha256"])

    schema = T.StructType([fields[1], *(T.StructField(c, T.LongType()) for c in [*counts, "n_best", "count_sum"]), fields[6]])
    return look_up(blocks.drop("pair", "docs"), found, total, schema)
