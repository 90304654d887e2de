"""Alignment, licence scan and vector codes against plain code."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.llm import alignment, code_compression, license_rules, license_scan, personal_data, queries, tokens

# --- alignment ---------------------------------------------------------------------------------------------------------------

TEXTS = [
    (1, None), (2, ""), (3, " "), (4, "   "), (5, "Plain words, and more words."), (5, "Plain words, and more words."), (None, "null id"), (6, "two  blanks\n\n and\t tabs \n"), (7, " leading and trailing "),
    (8, "<|endoftext|> is <s> ordinary </s> <0x41> text"), (9, "a▁b ▁ c"), (10, "naïve café — 東京 🙂 　 é é ½ ﬁ"), (11, "x" * 70_000), (12, "a\x00b \x1c \x85 c\xa0d"), (13, "word " * 3000), (14, "\n \n\nb \n c"), (15, "it's we'll 2024's"),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in TEXTS], "doc_id long, text string, block int, pair string, places string").repartition(3)


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokens.vocabulary())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary("piece_bpe_32k.model"))


def plain_alignment(text, both):
    a, b = both
    if not text:
        return [], [], [], []
    x, ids_b = a.encode(f" {text}", add_special_tokens=False), b.encode(text)
    level = alignment._byte_level()
    raw_a = [bytes(level[c] for c in t) for t in x.tokens]
    raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(raw_a) == f" {text}".encode() == b"".join(raw_b):
        return [], [], [], []
    end_a, end_b = np.cumsum([len(t) for t in raw_a]).tolist(), np.cumsum([len(t) for t in raw_b]).tolist()
    links, i, j = [], 0, 0
    while i < len(end_a):
        links.append((x.ids[i], ids_b[j]))
        p, q = end_a[i], end_b[j]
        i += p <= q
        j += q <= p
    groups, i, j = [], 0, 0
    at_a, at_b = ({e: k for k, e in enumerate(x)} for x in (end_a, end_b))
    for cut in sorted(set(end_a) & set(end_b)):
        k, m = at_a[cut] + 1, at_b[cut] + 1
        groups.append((x.ids[i:k], ids_b[j:m]))
        i, j = k, m
    return x.ids, ids_b, groups, links


def test_alignment_scores(spark, texts, both):
    want, plain = [], [(i, plain_alignment(t, both)) for i, t in TEXTS]
    held = Counter(pair for _, (_, _, _, links) in plain for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    for i, (a, b, groups, links) in plain:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        want.append((i, len(a), len(b), len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    got = [tuple(r) for r in alignment.score_links(texts).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(r[1] == 0 for r in got) and alignment.score_links(texts.limit(0)).count() == 0


def test_alignment_in_full_and_in_small_blocks(spark, texts, both, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 10)
    for r in alignment.groups_and_links(texts.filter("doc_id <> 11")).collect():
        text = next(t for i, t in TEXTS if i == r.id)
        a, b, groups, links = plain_alignment(text, both)
        assert (r.a_ids, r.b_ids) == (a, b)
        assert [(a[x.a], b[x.b]) for x in r.links] == links
        firsts = [(g.a, g.b) for g in r.groups]
        assert firsts == [(sum(len(x) for x, _ in groups[:k]), sum(len(y) for _, y in groups[:k])) for k in range(len(groups))]
        assert [x.start for x in r.links[1:]] == [x.end for x in r.links[:-1]] and (not a or r.links[-1].end == len(f" {text}".encode()))


def test_alignment_of_the_small_table(spark, small, both):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = queries.op11_cross_tokenizer_alignment(spark, small).collect()
    assert len(got) == len(texts)
    held, links = Counter(), {}
    for i, t in texts.items():
        *_, links[i] = plain_alignment(t, both)
        held.update(set(links[i]))
    assert all(r.n_links == len(links[r.doc_id]) and r.count_sum == sum(held[p] for p in links[r.doc_id]) for r in got)


def test_marks_rank_and_select():
    rng = np.random.default_rng(1)
    for n in (1, 63, 64, 65, 1000):
        places = np.unique(rng.integers(0, n, n // 2 + 1))
        m = alignment.Marks.at(places, n)
        assert m.places().tolist() == places.tolist()
        assert m.rank(np.arange(n + 1)).tolist() == [int((places < k).sum()) for k in range(n + 1)]


# --- licences ----------------------------------------------------------------------------------------------------------------

LICENCES = [
    (1, None), (2, ""), (3, "Licensed under CC BY-NC 4.0."), (4, "Released under the MIT License. All rights reserved. ALL RIGHTS RESERVED"), (5, "GNU General Public License, version 3 or the general\npublic   license"),
    (5, "cc by cc by"), (None, "ñcc by, cc byñ"), (6, "SPDX-License-Identifier: Apache-2.0"), (7, "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    (8, "word " * 400_000 + "All rights reserved"), (9, "Copyright (c) 2020 Some One. All rights reserved."), (10, "Dual licensed: GPL-2.0 or MIT license"), (11, "Licensed under the mpl 2.0 and under the Foo licence"),
]


def plain_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    base = [(label, i, i + len(p.split())) for label, p in license_rules.BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    flat = f" {' '.join(words)} "
    found = []
    for rule in license_rules.rules():  # no gate
        for m in re.finditer(rule.pattern.pattern.decode(), flat):
            found.append((rule, flat[: m.start()].count(" ") - 1, flat[: m.end()].count(" ")))
    stay = []
    for k, (r, a, b) in enumerate(found):
        stronger = [(s, c, d) for j, (s, c, d) in enumerate(found) if j != k and c <= a and d >= b]
        if not any(s.priority < r.priority or (s.priority == r.priority and (d - c > b - a or (d - c == b - a and s.number < r.number))) for s, c, d in stronger):
            stay.append((r, a, b))
    weights = {}
    for label, *_ in base:
        weights[label] = license_rules.BASE_WEIGHT
    for r, *_ in stay:
        weights[r.label] = max(weights.get(r.label, 0), r.weight)
    return len(words), base, stay, 1 - math.prod(1 - weights[x] for x in sorted(weights))


def test_licence_scan(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in LICENCES], "doc_id long, text string, base string, score int").repartition(3)
    got = license_scan.scan(docs).collect()
    assert len(got) == len(LICENCES) and license_scan.scan(docs.limit(0)).count() == 0
    seen = []
    for r in got:
        text = next(t for i, t in LICENCES if i == r.id and (i != 5 or len(license_scan.normalised(t.encode())[0].split()) == r.n_words))
        if len(text or "") > 100_000:
            assert (r.n_words, [b.start for b in r.base], r.base[0].text) == (400_003, [400_000], "All rights reserved")
            continue
        n, base, stay, score = plain_scan(text)
        assert (r.n_words, sorted((b.label, b.start, b.end) for b in r.base)) == (n, sorted(base))
        assert sorted((d.rule, d.start, d.end) for d in r.found) == sorted((x.number, a, b) for x, a, b in stay) and r.score == pytest.approx(score)
        assert all(text[d.char_start : d.char_end] == d.text and d.text.strip() == d.text for d in [*r.base, *r.found])
        seen += [d.label for d in r.found]
    assert {"cc-by-nc-4.0", "mit", "gpl-3.0", "apache-2.0", "reserved", "gpl-2.0"} <= set(seen)


def test_licence_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = queries.op12_license_scan(spark, small).collect()
    assert len(got) == len(texts)
    for r in got:
        n, base, stay, score = plain_scan(texts[r.doc_id])
        starts = [a for _, a, _ in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(base), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for x, *_ in base})) and r.labels == ",".join(sorted({x for x, *_ in base} | {x.label for x, *_ in stay}))
        assert 0 <= r.score <= 1 and r.score == pytest.approx(score)


def test_licence_rules_are_hundreds_and_gated():
    table = license_rules.rules()
    assert len(table) > 200 and all(r.words and all(r.words) for r in table) and [r.priority for r in table[3:]] == sorted(r.priority for r in table[3:])


# --- codes -------------------------------------------------------------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds, size):
    kept = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows if v and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = size // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, _, v in kept[:entries]] for p in range(parts)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            groups = defaultdict(list)
            for _, _, v in kept:
                groups[best(cut(v, p), book)[1]].append(cut(v, p))
            new.append([[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(book)])
        books = new
    return [(i, lab, [best(cut(v, p), books[p])[1] for p in range(parts)], sum(best(cut(v, p), books[p])[0] for p in range(parts))) for i, lab, v in kept], books


def test_codes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.2, 8)], int(i) % 3 if i % 5 else None) for i in range(40)]
    rows += [(100 + i, rows[0][1], 1) for i in range(30)]  # a hot vector
    rows += [(3, rows[7][1], 2), (None, rows[8][1], 0), (200, None, 1), (201, [], 1), (202, [None] * 8, 1), (203, [float("nan")] * 8, 1), (204, [1.0] * 7 + [float("inf")], 1), (205, [0.1] * 4, 1), (206, [0.1] * 9, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, block string, code int").repartition(4)
    for block in (1 << 20, 64):
        monkeypatch.setattr(code_compression, "BLOCK_COMPONENTS", block)
        coded, books = code_compression.compress(df, parts=4, entries=6, rounds=2)
        want, want_books = plain_codes(rows, 4, 6, 2, 8)
        assert books == want_books
        assert sorted(((r.id, r.label, r.codes, r.error) for r in coded.collect()), key=repr) == sorted(want, key=repr)
    totals = Counter()
    for _, lab, _, e in want:
        totals[lab] += e
    assert all(r.label_error == totals[r.label] for r in code_compression.with_label_error(coded).collect())
    for r in code_compression.decoded(coded, books).collect():
        assert [math.floor(256 * x) for x in r.vector] == [c for p in range(4) for c in books[p][r.codes[p]]]
    assert code_compression.with_label_error(code_compression.compress(df.limit(0))[0]).count() == 0
    with pytest.raises(Exception, match="would not fit"):
        code_compression.compress(df.withColumn("embedding", F.transform("embedding", lambda x: x * 1e30)), parts=4)[0].count()


# --- personal data -----------------------------------------------------------------------------------------------------------


def plain_reconcile(pieces):
    out = []
    for kind in personal_data.KINDS:
        whole = sorted({(a, b) for k, a, b, cut in pieces if k == kind and not cut})
        mine = whole + [(a, b) for k, a, b, cut in pieces if k == kind and cut and not any(a < y and x < b for x, y in whole)]
        joined = []
        for a, b in sorted(mine):
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(b, joined[-1][1])
            else:
                joined.append([a, b])
        out += [(kind, a, b) for a, b in joined]
    kept = []
    for kind, a, b in sorted(out, key=lambda s: (s[1] - s[2], s[1])):
        if all(b <= x or y <= a for _, x, y in kept):
            kept.append((kind, a, b))
    return kept


def test_spans_of_all_windows_are_reconciled_as_by_comparing_all():
    rng = random.Random(2)
    for _ in range(300):
        pieces = [(rng.choice(personal_data.KINDS), a := rng.randint(0, 200), a + rng.randint(1, 30), rng.random() < 0.4) for _ in range(rng.randint(0, 40))]
        assert personal_data.reconcile(pieces) == plain_reconcile(pieces)


def test_a_long_log_and_long_spans():
    """Time in proportion to the number of spans, and no limit to the length of one."""
    pieces = [("ip", 24 * k, 24 * k + 11, False) for k in range(100_000)] + [("email", 24 * k + 12, 24 * k + 20, k % 2 == 0) for k in range(100_000)]
    start = time.process_time()
    assert len(personal_data.reconcile(pieces)) == 200_000
    assert time.process_time() - start < 4
    long = "x" * 70 + " [at] " + "y" * 60 + " [dot] org"
    assert personal_data.valid("email", f"mail {long} now", 5, 5 + len(long))
