"""Markup and literals: linear time, and equal to the patterns that say what they mean."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidewright.functions import markup as M
from tidewright.functions import text as X
from tidewright.sources import files


def by_patterns_declarations(t):
    for p, to, f in ((r"<!--.*?-->", "", re.S), (r"<!--.*\Z", "", re.S), (r"<!\[CDATA\[(.*?)\]\]>", r" \1 ", re.S | re.I), (r"<!\[CDATA\[.*\Z", "", re.S | re.I), (r"<![^>]*>", "", 0), (r"<\?.*?\?>", "", re.S), (r"<\?.*\Z", "", re.S)):
        t = re.sub(p, to, t, flags=f)
    return t


def by_patterns_dangerous(t):
    for tag in M.DANGEROUS_TAGS:
        t = re.sub(rf"(?sia)<{tag}\b[^>]*(?:>.*</{tag}[ \t\n\x0b\f\r]*>|(?<=/)>|>.*)", "", t)
    return re.sub(rf"(?sia)<(?:{'|'.join(M.DANGEROUS_TAGS)})\b[^>]*(?:(?<=/)>|>.*)", "", t)


def by_patterns_tags(t):
    t = re.sub(r"""</?[a-zA-Z][^"'>]*(?:(?:"[^"]*"|'[^']*')[^"'>]*)*>""", " ", t)
    return re.sub(r"</?[a-zA-Z].*?(?:>|\Z)", " ", t, flags=re.S)


def by_patterns_code(t):
    quiet = r"""(?s:`(?:\\.|[^`\\])*`|"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'|//[^\n]*|/\*.*?\*/)"""
    return re.sub(rf"({quiet})|[^`\"'/]+|[`\"'/]", lambda m: re.sub("[^\n]+", " ", m[0]) if m[1] is not None else m[0], t)


PIECES = ["<", ">", "</", "/>", "<!--", "-->", "<![CDATA[", "]]>", "<!", "<?", "?>", "<script", "</script", "<STYLE", "</style >", "<embed", "script", "<a", "<b ", '"', "'", "a", " ", "\n", "x", "=", "&lt;", "&amp;", "ſ", "-", "--"]
MARKS = ["`", '"', "'", "/", "*", "//", "/*", "*/", "\\", "\n", "a", " ", "${", "}"]


@pytest.mark.parametrize("seed", range(4))
def test_equal_to_patterns(seed):
    rng = random.Random(seed)
    for _ in range(5000):
        t = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25)))
        assert M.strip_declarations(t) == by_patterns_declarations(t), t
        assert M.strip_dangerous(t) == by_patterns_dangerous(t), t
        assert M.strip_tags(t) == by_patterns_tags(t), t
        c = "".join(rng.choice(MARKS) for _ in range(rng.randint(0, 25)))
        assert M.bare_code(c) == by_patterns_code(c), c


MB = 1 << 20
PAGES = {
    "attributes": "<a " + " ".join(f'k{i}="v>{i}"' for i in range(100_000)) + ">x", "openings": "<a" * (MB // 2), "openings and a quote": "<a" * (MB // 2) + '"', "quotes": "<a" + "\"'" * (MB // 2), "quoted openings": '<a "' * (MB // 4),
    "scripts": "<script" * (MB // 7), "closed scripts": "<script/>" * (MB // 9), "open scripts": "<script>" * (MB // 8), "closings": "</script " * (MB // 9), "blanks": "</script" + " " * MB, "comments": "<!--" * (MB // 4), "cdata": "<![CDATA[" * (MB // 9),
    "declarations": "<!" * (MB // 2), "instructions": "<?" * (MB // 2), "ampersands": "&" * MB, "numbers": "&#" + "1" * MB, "entities": "&amp;" * (MB // 5), "nested entities": "&" + "amp;" * (MB // 4) + "lt;",
}
CODE = {"template": "`" + "x" * MB + "`", "escapes": "'" + "\\'" * (MB // 2), "open templates": "`\\" * (MB // 2), "open comments": "/*" * (MB // 2), "quotes": "'\"" * (MB // 2), "slashes": "/ " * (MB // 2), "lines": "'\n" * (MB // 2), "backslashes": '"' + "\\" * MB}


@pytest.mark.parametrize("name", [*PAGES, *CODE])
def test_linear(name):
    f, text = (M.to_text, PAGES[name]) if name in PAGES else (M.bare_code, CODE[name])
    start = time.process_time()
    f(text)
    took = time.process_time() - start
    assert took < 3, f"{took:.1f} s for {len(text)} characters"


def test_long_pages_in_spark(spark):
    """One such page used to end an executor."""
    pages = spark.createDataFrame([(1, PAGES["attributes"]), (2, None), (3, "no markup  at all"), (4, PAGES["openings"] + ">")], "id int, html string")
    got = {r.id: r.t for r in pages.select("id", X.html_to_text(F.col("html")).alias("t")).collect()}
    assert got == {1: "x", 2: "", 3: "no markup at all", 4: ""}
    code = spark.createDataFrame([(CODE["template"] + "\nexport const a = 1",), (None,)], "code string")
    assert [r.b for r in code.select(files.bare_code(F.col("code")).alias("b")).collect()] == [" \nexport const a = 1", None]
