"""Personal data: patterns, and a character BiLSTM-CRF that adds what they miss.

Base spans (emails, IPv4 addresses, card and phone numbers) come from fixed
patterns and are always kept. The model is trained in numpy on the driver from
labelled spans: those of generated examples in many spellings, set in passages
of a bounded sample of the documents, beside numbers that are no personal data.
It reads whole texts in overlapping windows; each is decoded by Viterbi under the
CRF's transitions, and the spans of all windows of a text are reconciled: pieces
cut by a window's edge give way to whole ones or are joined, then the longer
span wins. A span of the model is kept only if it can be what it is said to be (Luhn, four
parts of at most 255, the digits of a telephone number, one "at" before a host) and
it meets no base span; how it is spelled is for the model to tell.

A span holds a digit, an at sign, a bracketed "at" or the word "dot". A window without
one can give no span and is not decoded; this changes no result (tests compare).

Defined cases: null and empty texts have no spans; rows that repeat an id are
each searched; null ids are kept; offsets count code points, ends exclusive; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# ---- base spans -------------------------------------------------------------

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number can only begin where digits begin: a match that starts later in a run would have matched from its start.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def is_octet(digits: str) -> bool:
    """At most 255, with any number of leading zeros."""
    rest = digits.lstrip("0")
    return len(rest) <= 3 and int(rest or "0") <= 255


def _emails(text: str) -> Iterator[Span]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _HOST.match(text, at + 1)):
            end = m.end()
            yield ("email", start, end)
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """In the order of :data:`KINDS`, then by start."""
    out = list(_emails(text))
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(is_octet(p) for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


# ---- characters and labels --------------------------------------------------

_LISTED = "abcdefghijklmnopqrstuvwxyz@.-_+()[]{}/:;,#%&*|=\"'!?~<>"
_CODE = np.full(0x180, 3, np.int64)  # 0 nothing, 1 digit, 2 upper case, 3 other, 4 blank, 5 newline, 6 other letters
_CODE[48:58], _CODE[65:91], _CODE[[32, 9, 11, 12, 13]], _CODE[10], _CODE[0xC0:] = 1, 2, 4, 5, 6
for _i, _c in enumerate(_LISTED):
    _CODE[ord(_c)] = 7 + _i
CHARS = 7 + len(_LISTED)
LABELS = 1 + 2 * len(KINDS)  # nothing, then each kind's first and further characters
_ALLOWED = np.zeros((LABELS, LABELS), bool)
_ALLOWED[:, 0] = True
for _k in range(len(KINDS)):
    _ALLOWED[:, 1 + 2 * _k] = True
    _ALLOWED[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = True
_FORBID = np.where(_ALLOWED, 0, -1e4).astype(np.float32)
_START = np.where(np.arange(LABELS) % 2 == 0, -1e4, 0).astype(np.float32)
_START[0] = 0
HIDDEN, WINDOW, STRIDE = 16, 96, 48
SEED = re.compile(r"[0-9@]|[(\[{<] ?[Aa][Tt] ?[)\]}>]| [Dd][Oo][Tt] ")


def char_codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < len(_CODE), _CODE[np.minimum(points, len(_CODE) - 1)], 6)


# ---- the network ------------------------------------------------------------


@dataclass
class Network:
    """``inputs``: each character's part of the gates, one table a direction; ``inner``: the state's; then emissions and transitions."""

    inputs: np.ndarray
    inner: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    transitions: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.inner, self.out, self.bias, self.transitions]


def network(seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)
    inputs = rng.standard_normal((2, CHARS, 4 * HIDDEN)) * 0.3
    inputs[:, :, HIDDEN : 2 * HIDDEN] += 1.0
    parts = [inputs, rng.standard_normal((2, HIDDEN, 4 * HIDDEN)) * 0.2, rng.standard_normal((2 * HIDDEN, LABELS)) * 0.2, np.zeros(LABELS), np.zeros((LABELS, LABELS))]
    return Network(*(p.astype(np.float32) for p in parts))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def states(net: Network, codes: np.ndarray):  # noqa: ANN201
    """Both directions' states, ``time x 2 x batch``; the second direction runs over reversed windows."""
    n, length = codes.shape
    both = np.stack([codes, codes[:, ::-1]]).transpose(2, 0, 1)
    h, c = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
    hs, cs, gates = (np.zeros((length, 2, n, k), np.float32) for k in (HIDDEN, HIDDEN, 4 * HIDDEN))
    for t in range(length):
        z = h @ net.inner
        z[0] += net.inputs[0][both[t, 0]]
        z[1] += net.inputs[1][both[t, 1]]
        g = gates[t]
        g[..., : 3 * HIDDEN] = _sigmoid(z[..., : 3 * HIDDEN])
        g[..., 3 * HIDDEN :] = np.tanh(z[..., 3 * HIDDEN :])
        c = g[..., HIDDEN : 2 * HIDDEN] * c + g[..., :HIDDEN] * g[..., 3 * HIDDEN :]
        h = g[..., 2 * HIDDEN : 3 * HIDDEN] * np.tanh(c)
        hs[t], cs[t] = h, c
    return both, hs, cs, gates


def emissions(net: Network, hs: np.ndarray) -> np.ndarray:
    """``time x batch x labels``."""
    return np.concatenate([hs[:, 0], hs[::-1, 1]], -1) @ net.out + net.bias


def decode(net: Network, codes: np.ndarray) -> np.ndarray:
    """The best labels of each window."""
    e = emissions(net, states(net, codes)[1])
    step = net.transitions + _FORBID
    best, back = e[0] + _START, []
    for t in range(1, len(e)):
        s = best[:, :, None] + step
        back.append(s.argmax(1))
        best = s.max(1) + e[t]
    out = np.zeros(codes.shape, np.int64)
    at = best.argmax(1)
    out[:, -1] = at
    rows = np.arange(len(codes))
    for t in range(len(e) - 2, -1, -1):
        at = back[t][rows, at]
        out[:, t] = at
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def loss_gradient(net: Network, codes: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log-likelihood of the labels under the CRF, and its gradient by part."""
    both, hs, cs, gates = states(net, codes)
    e = emissions(net, hs)
    length, n, _ = e.shape
    step = net.transitions + _FORBID
    alpha, beta = np.zeros_like(e), np.zeros_like(e)
    alpha[0] = e[0] + _START
    for t in range(1, length):
        alpha[t] = e[t] + _logsum(alpha[t - 1][:, :, None] + step, 1)
    for t in range(length - 2, -1, -1):
        beta[t] = _logsum((beta[t + 1] + e[t + 1])[:, None, :] + step, 2)
    z = _logsum(alpha[-1], 1)
    de = np.exp(alpha + beta - z[:, None])
    pair = np.zeros((LABELS, LABELS), np.float64)
    for t in range(1, length):
        pair += np.exp(alpha[t - 1][:, :, None] + step + (e[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
    gold = labels.T
    tt, rr = np.meshgrid(np.arange(length), np.arange(n), indexing="ij")
    score = e[tt, rr, gold].sum() + net.transitions[gold[:-1], gold[1:]].sum()
    de[tt, rr, gold] -= 1
    np.subtract.at(pair, (gold[:-1], gold[1:]), 1)
    de = (de / n).astype(np.float32)
    cat = np.concatenate([hs[:, 0], hs[::-1, 1]], -1)
    d_out, d_bias = np.einsum("tnh,tnl->hl", cat, de), de.sum((0, 1))
    d_cat = de @ net.out.T
    d_hs = np.stack([d_cat[..., :HIDDEN], d_cat[::-1, :, HIDDEN:]], 1)
    d_inputs, d_inner = np.zeros_like(net.inputs), np.zeros_like(net.inner)
    dh, dc = np.zeros_like(hs[0]), np.zeros_like(hs[0])
    for t in range(length - 1, -1, -1):
        g, before = gates[t], cs[t - 1] if t else np.zeros_like(cs[0])
        i, f, o, u = (g[..., k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
        tc = np.tanh(cs[t])
        dh = dh + d_hs[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * u * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u * u)], -1)
        for k in range(2):
            np.add.at(d_inputs[k], both[t, k], dz[k])
        if t:
            d_inner += hs[t - 1].transpose(0, 2, 1) @ dz
        dh, dc = dz @ net.inner.transpose(0, 2, 1), dc * f
    return float((z.sum() - score - _START[gold[0]].sum()) / n), [d_inputs, d_inner, d_out, d_bias, (pair / n * _ALLOWED).astype(np.float32)]


# ---- labelled spans ---------------------------------------------------------


def _card(rng: random.Random) -> str:
    body = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(14))
    return next(body + d for d in "0123456789" if luhn(body + d))


def _example(rng: random.Random) -> tuple[str, str | None]:
    """A piece of text and the kind of personal data that it is, if any."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda a, b: "".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randint(a, b)))
    kind = rng.choice([*KINDS, None, None])
    if kind == "email":
        name, host, top = word(2, 9) + rng.choice(["", "." + d(2), "_" + word(2, 5), d(2)]), rng.choice([word(3, 8), "mail" + d(1) + ".example", word(2, 6) + "-" + word(2, 5)]), rng.choice(["com", "org", "net", "de", "fr", "es"])
        at, dot = rng.choice([("@", "."), ("@", "."), ("@", "."), (" (at) ", " (dot) "), ("(at)", "."), (" [at] ", " [dot] "), ("[at]", "[dot]"), (" @ ", "."), ("{at}", "."), (" at ", " dot "), ("@", " . "), ("<at>", "<dot>")])
        return name + at + (host + "." + top).replace(".", dot), kind
    if kind == "ip":
        return rng.choice([".", ".", "[.]", "(.)", " . ", "[dot]", " dot "]).join(str(rng.randint(0, 255)) for _ in range(4)), kind
    if kind == "card":
        c, s, n = _card(rng), rng.choice(["", "", " ", "-", ".", "/", "_"]), rng.choice([4, 4, 4, 8, 6])
        return s.join(c[i : i + n] for i in range(0, 16, n)), kind
    if kind == "phone":
        a, b, c = d(3), d(3), d(4)
        parts = rng.choice([(2, 2, 2, 2, 2), (4, 3, 3), (2, 4, 4), (3, 2, 2, 2), (4, 7), (3, 4, 4), (5, 6)])
        if rng.random() < 0.5:
            head = rng.choice(["+", "+", "00"]) + str(rng.randint(1, 99)) + rng.choice([" ", "-", ".", " (0)", "/"]) if len(parts) < 4 or rng.random() < 0.4 else "0"
            rest = rng.choice([" ", " ", "-", ".", "/"]).join(d(n) for n in parts)
            return head + (rest[1:] if head == "0" else rest), kind
        return rng.choice([f"+1 ({a}) {b}-{c}", f"+{rng.randint(1, 99)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"00{rng.randint(1, 99)} {a} {b} {c}", f"({a}){b}-{c}"]), kind
    return rng.choice([
        d(rng.randint(1, 7)), f"{d(4)}-{d(2)}-{d(2)}", f"{d(2)}/{d(2)}/{d(4)}", f"{d(2)}:{d(2)}", f"{d(1)}.{d(1)}.{d(1)}", f"{d(3)}.{d(2)}", f"v{d(1)}.{d(2)}", "".join(rng.choice("0123456789abcdef") for _ in range(40)),
        f'token = "{"".join(rng.choice("0123456789abcdef") for _ in range(40))}"', "AKIA" + "".join(rng.choice("ABCDEFGHIJ0123456789") for _ in range(16)), f"CC BY-NC {d(1)}.0", f"@{word(3, 8)}", f"{word(3, 6)} @ {word(3, 6)}", d(rng.randint(20, 30)), f"{d(4)}-{d(2)}-{d(2)} {d(2)}:{d(2)}", f"{d(2)}.{d(2)}.{d(4)}", f"{d(1)},{d(3)},{d(3)}", f"{d(3)} {d(3)}", f"{d(4)}-{d(4)}", f"{word(3, 6)} at {word(3, 6)} dot", f"the {word(3, 6)} dot {word(3, 6)}", f"{d(1)}.{d(2)}.{d(3)}-{d(1)}", f"http://{word(3, 8)}.example.net/{d(5)}", f"({d(4)})", f"| {d(2)} | {d(3)} |",
    ]), None


def examples(texts: list[str], windows: int = 4000, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Windows of characters and labels: examples set between words of the texts, which keep their own base spans."""
    rng = random.Random(seed)
    texts = [t for t in texts if t] or ["the and of in to"]
    codes, labels = np.zeros((windows, WINDOW), np.int64), np.zeros((windows, WINDOW), np.int64)
    for w in range(windows):
        parts, spans, size = [], [], 0
        while size < WINDOW + 40:
            t = rng.choice(texts)
            at = rng.randrange(len(t))
            piece = t[at : at + rng.randint(5, 70)].split(" ", 1)[-1].rsplit(" ", 1)[0] + " "
            spans += [(k, size + a, size + b) for k, a, b in base_spans(piece)]
            parts.append(piece)
            size += len(piece)
            got, kind = _example(rng)
            if kind:
                spans.append((kind, size, size + len(got)))
            got += rng.choice([" ", " ", ". ", ", ", "\n"])
            parts.append(got)
            size += len(got)
        text, cut = "".join(parts), rng.randrange(0, 40)
        codes[w] = char_codes(text[cut : cut + WINDOW])
        for kind, a, b in spans:
            a, b = max(0, a - cut), min(WINDOW, b - cut)
            if a < b:
                k = KINDS.index(kind)
                labels[w, a], labels[w, a + 1 : b] = 1 + 2 * k, 2 + 2 * k
    return codes, labels


def train(texts: list[str], windows: int = 8000, epochs: int = 4, batch: int = 64, rate: float = 0.02) -> Network:
    net = network()
    codes, labels = examples(texts, windows)
    parts = net.parts()
    m, v, t = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    total = epochs * -(-windows // batch)
    for epoch in range(epochs):
        order = np.random.default_rng(epoch).permutation(windows)
        for i in range(0, windows, batch):
            _, grads = loss_gradient(net, codes[order[i : i + batch]], labels[order[i : i + batch]])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            t += 1
            for k, g in enumerate(grads):
                g = g * np.float32(min(1, 5 / max(norm, 1e-9)))
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
                parts[k] -= (rate * (1 - 0.95 * t / total) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
    return net


# ---- spans of the model -----------------------------------------------------

_AT = re.compile(r"@|[(\[{<] ?at ?[)\]}>]| at ", re.I)
_DOT = re.compile(r" ?[(\[{<] ?(?:dot|\.) ?[)\]}>] ?| dot | ?\. ?", re.I)


def valid(kind: str, text: str, start: int, end: int) -> bool:
    """Whether the span can be what it is said to be, and no digit or letter goes on beside it.

    Only what the kind is made of is asked for (its numbers, their size and checksum, or
    one "at" with a host of several parts behind it); how it is spelled is the model's
    decision.
    """
    got = text[start:end]
    if len(got) < 5 or "\n" in got or (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return False
    digits = re.sub("[^0-9]", "", got)
    if kind == "email":
        ats = list(_AT.finditer(got))
        if len(ats) != 1:
            return False
        local, host = got[: ats[0].start()].strip(), _DOT.split(got[ats[0].end() :].strip())
        return bool(local) and local[0].isalnum() and len(host) > 1 and not any(c.isspace() for part in (local, *host) for c in part) and all(part.replace("-", "").isalnum() for part in host) and len(host[-1]) > 1
    apart = re.split("[0-9]+", got)
    if any(c.isalpha() for part in apart for c in part.lower().replace("dot", "")):
        return False
    if kind == "ip":
        return len(apart) == 5 and not apart[0] and not apart[-1] and all(_DOT.fullmatch(part) for part in apart[1:-1]) and all(is_octet(part) for part in re.findall("[0-9]+", got))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits) and all(len(part) <= 1 for part in apart)
    # A telephone number says that it is one, by its start or by its length and parts.
    stated = got.startswith(("+", "00", "("))
    return (8 if stated else 9) <= len(digits) <= 15 and all(len(part) <= 3 and set(part) <= set(" ()./-+") for part in apart) and (stated or len(apart) >= 4)


class Cover:
    """Intervals that are asked which of them an interval overlaps, by bisection."""

    def __init__(self, spans: Iterable[tuple[int, int]]) -> None:
        ordered = sorted(spans)
        self.starts = [a for a, _ in ordered]
        self.furthest = list(accumulate((b for _, b in ordered), max))  # end of those up to each

    def meets(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.furthest[k - 1] > start


def reconcile(pieces: list[tuple[str, int, int, bool]]) -> list[Span]:
    """Spans of all windows of a text (``cut``: by a window's edge) as disjoint ones."""
    out: list[Span] = []
    for kind in KINDS:
        whole = {(a, b) for k, a, b, cut in pieces if k == kind and not cut}
        cover = Cover(whole)
        mine = [*whole, *((a, b) for k, a, b, cut in pieces if k == kind and cut and not cover.meets(a, b))]
        joined: list[list[int]] = []
        for a, b in sorted(mine):
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(b, joined[-1][1])
            else:
                joined.append([a, b])
        out += [(kind, a, b) for a, b in joined]
    # Spans that no chain of overlaps connects are chosen apart.
    kept: list[Span] = []
    near: list[Span] = []
    reach = 0
    for span in sorted(out, key=lambda s: s[1]):
        if near and span[1] >= reach:
            kept += _longest(near)
            near = []
        near.append(span)
        reach = max(reach, span[2])
    return sorted(kept + _longest(near), key=lambda s: (s[1] - s[2], s[1]))


def _longest(spans: list[Span]) -> list[Span]:
    """Of overlapping spans the longer ones, the earlier of equal ones."""
    if len(spans) < 2:
        return spans
    kept: list[Span] = []
    starts: list[int] = []  # of kept spans, which are disjoint, with their ends
    ends: list[int] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1] - s[2], s[1], KINDS.index(s[0]))):
        k = bisect_left(starts, a)
        if (k == 0 or ends[k - 1] <= a) and (k == len(starts) or b <= starts[k]):
            starts.insert(k, a)
            ends.insert(k, b)
            kept.append((kind, a, b))
    return kept


def _windows(text: str, gate: bool) -> list[int]:
    last = max(0, len(text) - WINDOW + STRIDE - 1) // STRIDE
    if not gate:
        return [k * STRIDE for k in range(last + 1)]
    live: set[int] = set()
    for m in SEED.finditer(text):
        low = max(0, -(-(m.end() - WINDOW) // STRIDE))
        live.update(range(low, min(last, m.start() // STRIDE) + 1))
    return [k * STRIDE for k in sorted(live)]


def model_spans(net: Network, texts: list[str], gate: bool = True, batch: int = 512) -> list[list[Span]]:
    places = [(row, at) for row, text in enumerate(texts) for at in _windows(text, gate)]
    pieces: list[list[tuple[str, int, int, bool]]] = [[] for _ in texts]
    for i in range(0, len(places), batch):
        some = places[i : i + batch]
        codes = np.zeros((len(some), WINDOW), np.int64)
        for j, (row, at) in enumerate(some):
            part = char_codes(texts[row][at : at + WINDOW])
            codes[j, : len(part)] = part
        labels = decode(net, codes)
        for j in np.flatnonzero(labels.any(1)):
            row, at = some[j]
            text, size = texts[row], min(WINDOW, len(texts[row]) - at)
            t = 0
            while t < size:
                label = int(labels[j, t])
                if not label:
                    t += 1
                    continue
                end = t + 1
                while end < size and labels[j, end] == (label + 1 if label % 2 else label):
                    end += 1
                a, b = at + t, at + end
                cut = (t == 0 and at > 0) or (end == size and at + size < len(text))
                if SEED.search(text, a, b):
                    pieces[row].append((KINDS[(label - 1) // 2], a, b, cut))
                t = end
    return [reconcile(p) for p in pieces]


def find(net: Network, texts: list[str], gate: bool = True) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    out = []
    for text, more in zip(texts, model_spans(net, texts, gate), strict=True):
        base = base_spans(text)
        cover = Cover((a, b) for _, a, b in base)
        extra = []
        for kind, a, b in more:
            while a < b and text[a] in " \n.,;:":
                a += 1
            while a < b and text[b - 1] in " \n.,;:":
                b -= 1
            if not cover.meets(a, b) and valid(kind, text, a, b):
                extra.append((kind, a, b))
        out.append((base, sorted(base + extra, key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


def fit(docs: DataFrame, text_col: str = "text", sample: int = 300, chars: int = 4000) -> Network:
    """Trains in passages (of at most ``chars`` characters, from a hashed place on) of at most ``sample`` documents, those with the smallest hashes."""
    rows = docs.filter(F.col(text_col).isNotNull()).select(F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t"))
    bound = rows.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    got = [] if bound is None else rows.filter(F.col("h") <= bound).select("h", F.substring(F.col("t"), (1 + F.pmod(F.col("h"), F.greatest(F.length("t") - chars, F.lit(0)) + 1)).cast("int"), F.lit(chars)).alias("t")).groupBy("h").agg(F.first("t").alias("t")).collect()
    got.sort(key=lambda r: r["h"])
    return _trained(tuple(r["t"] for r in got))


@lru_cache(maxsize=4)
def _trained(texts: tuple[str, ...]) -> Network:
    """The weights that a sample gives are the same each time; the driver keeps the last ones."""
    return train(list(texts))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def search(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, base, spans``: arrays of ``(kind, start, end)`` for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = find(shared.value, texts)
            columns = [[[{"kind": k, "start": a, "end": b} for k, a, b in f[i]] for f in found] for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, kind) for c in columns)], ["id", "base", "spans"])

    ddl = "array<struct<kind:string,start:long,end:long>>"
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, f"id long, base {ddl}, spans {ddl}")


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
