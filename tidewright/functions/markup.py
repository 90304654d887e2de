"""Markup and source code cut apart in time proportional to their length.

Plain functions on one string, used by Arrow-batched functions of :mod:`.text` and
:mod:`..sources.files`. Patterns here match a single mark (never a run that may
have to be given back), a closing mark is sought once where it is missing, and where
quotes decide what closes a tag, the answer is kept for each quote.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

# Fixed values of the cleaning pipeline.
DANGEROUS_TAGS = ("script", "style", "noscript", "iframe", "object", "embed")
NAMED_ENTITIES = {
    "&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ",
    "&AMP;": "&", "&LT;": "<", "&GT;": ">", "&QUOT;": '"', "&NBSP;": " ", "&#39;": "'",
}
MOST_DECODES = 100
_ENTITY = re.compile(r"&(?:(?i:(?P<open>lt|gt|quot|amp))(?!;)|(?P<named>amp|lt|gt|quot|apos|nbsp|AMP|LT|GT|QUOT|NBSP);|#(?:(?P<dec>[0-9]+);|[xX](?P<hex>[0-9a-fA-F]+);|(?P<dec7>[0-9]{1,7})(?![0-9;])|[xX](?P<hex6>[0-9a-fA-F]{1,6})(?![0-9a-fA-F;])))")
_TAG = re.compile("</?[a-zA-Z]")
_EDGE = re.compile("[\"'>]")
_CDATA = re.compile(r"<!\[CDATA\[", re.I | re.A)
_OPENS = {tag: re.compile(rf"<{tag}\b", re.I | re.A) for tag in DANGEROUS_TAGS}
_CLOSES = {tag: re.compile(rf"</{tag}[ \t\n\x0b\f\r]*+>", re.I | re.A) for tag in DANGEROUS_TAGS}
_ANY_OPENS = re.compile(rf"<(?:{'|'.join(DANGEROUS_TAGS)})\b", re.I | re.A)


def _between(text: str, start: re.Pattern[str], end: str, keep: bool = False) -> str:
    """Without what stands from each ``start`` to the next ``end`` (its inside between blanks, if kept), then without all after a start that is not ended."""
    out, at = [], 0
    while m := start.search(text, at):
        close = text.find(end, m.end())
        if close < 0:
            break
        out.append(text[at : m.start()])
        if keep:
            out.append(f" {text[m.end() : close]} ")
        at = close + len(end)
    text = "".join(out) + text[at:]
    # What is left may have come together just now.
    m = start.search(text)
    return text[: m.start()] if m else text


_COMMENT, _INSTRUCTION = re.compile("<!--"), re.compile(r"<\?")


def strip_declarations(text: str) -> str:
    """Comments, CDATA marks, doctypes and instructions; what is not closed goes to the end."""
    if "<!" in text:
        text = _between(_between(text, _COMMENT, "-->"), _CDATA, "]]>", keep=True)
        out, at = [], 0
        while (i := text.find("<!", at)) >= 0 and (close := text.find(">", i)) >= 0:
            out.append(text[at:i])
            at = close + 1
        text = "".join(out) + text[at:]
    return _between(text, _INSTRUCTION, "?>") if "<?" in text else text


def _without(text: str, start: re.Pattern[str], last: re.Pattern[str] | None) -> str:
    """Without elements: from an opening to the last closing, or the opening alone if it closes itself, or all that follows."""
    out, at = [], 0
    while m := start.search(text, at):
        inside = text.find(">", m.end())
        if inside < 0:
            break
        out.append(text[at : m.start()])
        closed = [e.end() for e in last.finditer(text, inside + 1)] if last else []
        last = None  # nothing closes after the last
        if closed:
            at = closed[-1]
        elif text[inside - 1] == "/":
            at = inside + 1
        else:
            return "".join(out)
    return "".join(out) + text[at:]


def strip_dangerous(text: str) -> str:
    """Elements that carry code: from a kind's first opening to its last closing, or a lone one (to the end, if it does not close itself)."""
    for tag in DANGEROUS_TAGS:
        if _OPENS[tag].search(text):
            text = _without(text, _OPENS[tag], _CLOSES[tag])
    # What only came together where an element was cut out.
    return _without(text, _ANY_OPENS, None)


class _Ends:
    """Where a tag ends whose rest begins at a place: at the first ``>`` outside quotes, or nowhere if a quote is not closed."""

    def __init__(self, text: str) -> None:
        self.at = [m.start() for m in _EDGE.finditer(text)]
        n = len(self.at)
        self.end = [-1] * (n + 1)  # of a rest whose next edge is the k-th
        later = {'"': n, "'": n}
        for k in range(n - 1, -1, -1):
            c = text[self.at[k]]
            if c == ">":
                self.end[k] = self.at[k]
            else:
                self.end[k] = self.end[later[c] + 1] if later[c] < n else -1
                later[c] = k

    def of(self, start: int) -> int:
        return self.end[bisect_left(self.at, start)]


def strip_tags(text: str) -> str:
    """A blank for each tag; quoted ``>`` do not end one. Then one for each that no quote-aware reading ends, up to its first ``>`` or the end."""
    out, at, ends = [], 0, None
    i = 0
    while m := _TAG.search(text, i):
        ends = ends or _Ends(text)
        close = ends.of(m.end())
        if close < 0:
            i = m.start() + 1
            continue
        out += [text[at : m.start()], " "]
        at = i = close + 1
    text = "".join(out) + text[at:]
    out, at = [], 0
    while m := _TAG.search(text, at):
        close = text.find(">", m.end())
        out += [text[at : m.start()], " "]
        at = len(text) if close < 0 else close + 1
    return "".join(out) + text[at:]


def _character(m: re.Match[str]) -> str:
    """What one entity stands for; nothing beyond the last code point, however many digits it has."""
    kind, value = m.lastgroup or "", m[m.lastgroup or 0]
    if kind == "named":
        return NAMED_ENTITIES[f"&{value};"]
    if kind == "open":
        return NAMED_ENTITIES[f"&{value.lower()};"]
    digits = value.lstrip("0")
    if len(digits) > 7:
        return ""
    point = int(digits or "0", 16 if kind.startswith("hex") else 10)
    return chr(point) if point <= 0x10FFFF else ""


def decode_entities(text: str) -> str:
    """Decodes until nothing changes; text that never settles is dropped."""
    for _ in range(MOST_DECODES + 1):
        text, found = _ENTITY.subn(_character, text)
        if not found:
            return text
    return ""


def to_text(html: str) -> str:
    """What a page says; entities may hide markup, so that all is done again after decoding. White space stays as it is."""
    text = decode_entities(strip_tags(strip_dangerous(strip_declarations(html))))
    text = strip_tags(strip_dangerous(strip_declarations(text)))
    return text.encode("utf-8", "replace").decode()


def compose(text: str) -> str:
    return unicodedata.normalize("NFC", text)


_LITERAL = {
    "`": re.compile(r"(?:[^`\\]++|\\.)*+", re.S),
    '"': re.compile(r'(?:[^"\\\n]++|\\.)*+', re.S),
    "'": re.compile(r"(?:[^'\\\n]++|\\.)*+", re.S),
}
_QUIET_START = re.compile("[`\"'/]")
_LINE = re.compile("[^\n]+")


def quiet_parts(code: str) -> Iterator[tuple[int, int]]:
    """Where literals and comments start and end, whichever begins first; a mark that nothing closes is an ordinary character."""
    #: No literal of a kind is closed that begins before; all its marks up to there stand behind a backslash of one that was tried.
    open_until = dict.fromkeys(_LITERAL, 0)
    last_comment, at = code.rfind("*/"), 0
    while m := _QUIET_START.search(code, at):
        i, c, end = m.start(), m[0], -1
        if c == "/":
            follows = code[i + 1 : i + 2]
            if follows == "/":
                end = code.find("\n", i)
                end = len(code) if end < 0 else end
            elif follows == "*" and last_comment >= i + 2:
                end = code.find("*/", i + 2) + 2
        elif i >= open_until[c]:
            stop = _LITERAL[c].match(code, i + 1).end()  # type: ignore[union-attr]
            if code[stop : stop + 1] == c:
                end = stop + 1
            else:
                open_until[c] = stop
        if end < 0:
            at = i + 1
            continue
        yield i, end
        at = end


def bare_code(code: str) -> str:
    """Source text with a blank for each line of a literal or comment; line breaks stay, so that line numbers hold."""
    out, at = [], 0
    for i, end in quiet_parts(code):
        out += [code[at:i], _LINE.sub(" ", code[i:end])]
        at = end
    return "".join(out) + code[at:]


_FENCE = re.compile(r" {0,3}(`{3,}|~{3,})(.*)")


def content_lines(text: str) -> list[tuple[int, str]]:
    """Lines of a Markdown text with their numbers, without fenced and indented code and without HTML comments."""
    out, fence, comment = [], "", False
    for number, line in enumerate(text.split("\n"), 1):
        mark = _FENCE.match(line)
        if fence:
            if mark and mark[1][0] == fence[0] and len(mark[1]) >= len(fence) and not mark[2].strip():
                fence = ""
            continue
        if not comment:
            if mark and not (mark[1][0] == "`" and "`" in mark[2]):
                fence = mark[1]
                continue
            if line.startswith(("    ", "\t")):
                continue
        kept, at = [], 0
        while at < len(line):
            end = line.find("-->" if comment else "<!--", at)
            if not comment:
                kept.append(line[at:] if end < 0 else line[at:end])
            if end < 0:
                break
            at, comment = end + (3 if comment else 4), not comment
        out.append((number, "".join(kept)))
    return out
