"""Operator 1: licence scan. An Aho-Corasick automaton finds phrases and tags, a shunting-yard parser reads expressions.

Null and empty texts have no words and no labels; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from ebbtide.llm.common import per_batch

# Base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notice phrases that the method adds, in the same spelling (words joined by one blank).
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons": "cc",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG_PHRASE = "spdx license identifier"
#: How strongly one place supports the claim that the text carries a licence.
BASE_WEIGHT, NOTICE_WEIGHT, TAG_WEIGHT = 0.6, 0.4, 0.9
#: What an identifier demands, by its beginning: 0 permissive, 1 weak copyleft, 2 copyleft, 3 restricted or unknown.
DEMANDS = {
    "mit": 0, "apache": 0, "bsd": 0, "isc": 0, "cc0": 0, "cc-by-4": 0, "cc-by-3": 0, "unlicense": 0, "zlib": 0, "bsl": 0,
    "lgpl": 1, "mpl": 1, "epl": 1, "cddl": 1,
    "gpl": 2, "agpl": 2, "cc-by-sa": 2,
}
TERMS = ("permissive", "weak-copyleft", "copyleft", "restricted")

#: First parts of the identifiers that an expression may hold besides those above; ``LicenseRef-`` names any other.
_OTHER_FAMILIES = (
    "0bsd", "afl", "agpl", "artistic", "blueoak", "bzip2", "cc-by", "cc-pddc", "cecill", "cpl", "curl", "ecl", "eupl", "fsfap",
    "ftl", "gfdl", "hpnd", "icu", "ijg", "ipl", "json", "libpng", "licenseref", "lppl", "ms-pl", "ms-rl", "naist", "ncsa",
    "ncl", "odbl", "ofl", "oldap", "openssl", "osl", "php", "postgresql", "psf", "python", "qpl", "ruby", "sissl", "sleepycat",
    "spl", "tcl", "upl", "vim", "w3c", "wtfpl", "x11", "xfree86", "zpl",
)
_IDENTIFIER = re.compile("(?:%s)(?:-[a-z0-9.]+)*[+]?" % "|".join(map(re.escape, (*DEMANDS, *_OTHER_FAMILIES))))
_EXCEPTION = re.compile(r"[a-z0-9.+-]*exception[a-z0-9.-]*")

#: ASCII outside 0-9 and a-z separates words, A-Z becomes a-z, every other byte is part of a word.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_TAG = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE | re.ASCII)
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9.+:-]+)")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}

SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
     ("base_labels", pa.string()), ("labels", pa.string()), ("terms", pa.string()), ("score", pa.float64())]
)
DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, terms string, score double"
)


class Expression(NamedTuple):
    identifiers: tuple[str, ...]
    demand: int


@cache
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in [*BASE_PHRASES, *NOTICE_PHRASES, TAG_PHRASE]:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def demand(identifier: str) -> int:
    starts = [start for start in DEMANDS if identifier.startswith(start)]
    return DEMANDS[max(starts, key=len)] if starts else len(TERMS) - 1


def parse_expression(line: str) -> Expression | None:
    """Read the longest valid licence expression at the start of ``line``.

    Shunting yard: ``with`` binds an exception to its licence, ``and`` binds closer than ``or``. A choice (``or``)
    demands what its mildest side demands, a conjunction what its strictest side demands. The expression ends before the
    first operand that is no known identifier, ``LicenseRef-...`` or, after ``with``, exception, so words of the text
    behind it are no labels. None without an identifier. Takes time in proportion to the line.
    """
    values: list[int] = []
    pending: list[str] = []
    names: list[str] = []

    def apply(operator: str) -> None:
        right, left = values.pop(), values.pop()
        values.append({"or": min(left, right), "and": max(left, right), "with": left}[operator])

    at, operand_next, best, open_brackets = 0, True, None, 0
    while match := _TOKEN.match(line, at):
        token = match[1].lower()
        at = match.end()
        if operand_next:
            if token == "(":
                pending.append(token)
                open_brackets += 1
                continue
            exception = bool(pending) and pending[-1] == "with"
            if not (_EXCEPTION if exception else _IDENTIFIER).fullmatch(token):
                break
            values.append(0 if exception else demand(token))
            names.append(token)
            operand_next = False
        elif token == ")":
            while pending and pending[-1] != "(":
                apply(pending.pop())
            if not pending:
                break
            pending.pop()
            open_brackets -= 1
        elif token in _PRECEDENCE:
            while pending and pending[-1] != "(" and _PRECEDENCE[pending[-1]] >= _PRECEDENCE[token]:
                apply(pending.pop())
            pending.append(token)
            operand_next = True
            continue
        else:
            break
        if not open_brackets:  # a complete expression ends here; text after it may still extend it
            rest = values.copy()
            for operator in reversed(pending):
                right, left = rest.pop(), rest.pop()
                rest.append({"or": min(left, right), "and": max(left, right), "with": left}[operator])
            best = len(names), rest[0]
    return best and Expression(tuple(names[: best[0]]), best[1])


def scan_text(text: str | None) -> tuple:
    """All result columns of one text but doc_id."""
    words = (text or "").encode().translate(_WORD_BYTES).split()
    line = f" {b' '.join(words).decode('latin-1')} "
    base_at: list[int] = []
    base: set[str] = set()
    extra: set[str] = set()
    doubt, counted_to, blanks, tagged = 1.0, 0, 0, False
    places = sorted((end - len(phrase) - 1, phrase) for end, phrase in automaton().iter(line))
    for start, phrase in places:
        blanks += line.count(" ", counted_to, start)  # words before this place
        counted_to = start
        if phrase in BASE_PHRASES:
            base_at.append(blanks)
            base.add(BASE_PHRASES[phrase])
            doubt *= 1 - BASE_WEIGHT
        elif phrase in NOTICE_PHRASES:
            extra.add(NOTICE_PHRASES[phrase])
            doubt *= 1 - NOTICE_WEIGHT
        else:
            tagged = True
    terms = None
    if tagged:
        read = [found for match in _TAG.finditer(text or "") if (found := parse_expression(match[1]))]
        extra.update(name for found in read for name in found.identifiers)
        doubt *= (1 - TAG_WEIGHT) ** len(read)
        terms = TERMS[max(found.demand for found in read)] if read else None
    return (
        len(words), len(base_at), base_at[0] if base_at else None, base_at[-1] if base_at else None,
        ",".join(sorted(base)), ",".join(sorted(base | extra)), terms, 1.0 - doubt,
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Licence words, places, labels and a score per document; no shuffle."""

    def rows(ids: Iterable, texts: Iterable) -> Iterator[tuple]:
        for doc_id, text in zip(ids, texts):
            yield doc_id, *scan_text(text)

    return per_batch(docs.select("doc_id", "text"), SCHEMA, DDL, rows)
