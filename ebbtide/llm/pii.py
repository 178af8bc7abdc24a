"""Operator 3: personal data by weak supervision.

Regular expressions propose spans; pattern, gazetteer, checksum and context labelers vote for, against or not at all;
expectation-maximisation estimates each labeler's reliability per kind from vote counts over all documents, and a
logistic span classifier is fitted to the resulting probabilities. Valid spans of the base kinds always stay; other
proposals are spans where the classifier says so. What reaches the driver is one count per distinct pattern of kind,
votes and shape, whose number is bounded by these small domains.

Null and empty texts have no spans. Repeated rows count and are reported each time. An empty table trains nothing: the
prior reliabilities stand.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import per_batch

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "local_phone", "ssn", "iban", "loose_card")

# Base patterns, in forms that start only where the plain pattern's leftmost match can start.
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Proposals of the method.
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)[ -]?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}(?![0-9-])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NOT_DIGIT = re.compile(r"[^0-9]")

#: Words that speak for a kind when they stand shortly before a span, and words that speak against any kind.
CONTEXT = {
    "email": ("mail", "contact", "@", "write", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr", "adresse", "client"),
    "card": ("card", "visa", "master", "amex", "karte", "carte", "tarjeta", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "llama", "anruf", "appel"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "llama", "anruf", "appel"),
    "ssn": ("ssn", "social", "security"),
    "iban": ("iban", "account", "konto", "compte", "cuenta", "bank"),
    "loose_card": ("card", "visa", "master", "amex", "karte", "carte", "tarjeta", "pay"),
}
AGAINST = ("version", "isbn", "order", "invoice", "serial", "sha", "token", "uuid", "build", "issue", "id=")
CONTEXT_WIDTH = 40
#: Gazetteers: top-level domains, first digits of card networks, calling codes, countries with account numbers.
TOP_LEVEL = frozenset(("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info"))
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "30")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "4", "5", "6", "8", "9")
IBAN_COUNTRIES = frozenset(("DE", "FR", "ES", "GB", "IT", "NL", "BE", "AT", "CH", "PT", "IE", "PL"))

LABELERS = ("pattern", "gazetteer", "checksum", "context", "surroundings")
VOTE_CHARS = {1: "+", 0: ".", -1: "-"}
#: Prior of the labelers: pseudo-counts of right and wrong votes, and the prior share of true spans.
PRIOR_RIGHT, PRIOR_WRONG, PRIOR_TRUE = 8.0, 2.0, 0.5
ROUNDS = 50
THRESHOLD = 0.5


class Candidate(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool
    votes: str
    shape: str


class SpanModel(NamedTuple):
    """Weights of the classifier by feature name, and the reliabilities that it was trained from."""

    weights: dict[str, float]
    reliability: dict[str, list[float]]

    def probability(self, kind: str, votes: str, shape: str) -> float:
        z = sum(self.weights.get(name, 0.0) for name in features(kind, votes, shape))
        return float(1 / (1 + np.exp(-z)))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    compact = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, looked for around each @ so that no long run is tried from every place."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def spans_of(text: str) -> Iterator[tuple[str, int, int, bool, bool]]:
    """(kind, start, end, base, checksum or structure holds) of every proposal."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end, True, True
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            yield "ip", *m.span(), True, True
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 12:
            continue
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19:
            valid = luhn(digits)
            yield "card" if valid else "loose_card", *m.span(), valid, valid
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                yield "phone", *m.span(), True, True
    for m in _LOCAL_PHONE.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        yield "local_phone", *m.span(), False, digits[0] not in "01" and digits[3] not in "01"
    for m in _SSN.finditer(text):
        yield "ssn", *m.span(), False, m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00"
    for m in _IBAN.finditer(text):
        yield "iban", *m.span(), False, iban_valid(m[0])


def gazetteer_vote(kind: str, span: str) -> int:
    digits = _NOT_DIGIT.sub("", span)
    if kind == "email":
        return 1 if span.rsplit(".", 1)[-1].lower() in TOP_LEVEL else -1
    if kind == "ip":
        return -1 if digits.strip("0") == "" or span.startswith(("0.", "255.")) else 0
    if kind in ("card", "loose_card"):
        return 1 if digits.startswith(CARD_STARTS) else -1
    if kind == "phone":
        return 1 if digits.startswith(CALLING_CODES) else -1
    if kind == "iban":
        return 1 if span[:2] in IBAN_COUNTRIES else -1
    return 0


def candidates(text: str | None) -> list[Candidate]:
    """Proposals with votes and shape, by start, then kind as listed; none of the method's own across a base span."""
    found = []
    for kind, start, end, base, holds in spans_of(text or ""):
        span = text[start:end]
        before, after = text[max(0, start - 1) : start], text[end : end + 1]
        nearby = text[max(0, start - CONTEXT_WIDTH) : start].lower()
        votes = (
            1 if base else 0,
            gazetteer_vote(kind, span),
            1 if holds else -1,
            -1 if any(word in nearby for word in AGAINST) else int(any(word in nearby for word in CONTEXT[kind])),
            -1 if before.isalnum() or after.isalnum() or before in ("_", "/", "=") else int(before in ("", " ", "\n")),
        )
        separators = sum(not c.isdigit() for c in span)
        shape = f"{min((end - start) // 4, 9)}{min(separators, 4)}"
        found.append(Candidate(kind, start, end, base, "".join(VOTE_CHARS[v] for v in votes), shape))
    covered: list[list[int]] = []  # by base spans, in order and apart from each other
    for c in sorted((c for c in found if c.base), key=lambda c: c.start):
        if covered and c.start < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], c.end)
        else:
            covered.append([c.start, c.end])

    def free(c: Candidate) -> bool:
        place = bisect_left(covered, c.end, key=lambda span: span[0])
        return not place or covered[place - 1][1] <= c.start

    found = [c for c in found if c.base or free(c)]
    return sorted(found, key=lambda c: (c.start, KINDS.index(c.kind), c.end))


def vote_counts(docs: DataFrame) -> DataFrame:
    """(kind, votes, shape, n) over all texts, counted per batch before the shuffle."""
    schema = pa.schema([("kind", pa.string()), ("votes", pa.string()), ("shape", pa.string()), ("n", pa.int64())])

    def rows(texts: Iterable) -> Iterator[tuple]:
        counts: dict[tuple, int] = {}
        for text in texts:
            for c in candidates(text):
                key = (c.kind, c.votes, c.shape)
                counts[key] = counts.get(key, 0) + 1
        for key, n in counts.items():
            yield *key, n

    counted = per_batch(docs.select("text"), schema, "kind string, votes string, shape string, n long", rows)
    return counted.groupBy("kind", "votes", "shape").agg(F.sum("n").alias("n"))


def features(kind: str, votes: str, shape: str) -> list[str]:
    return ["bias", kind, f"{kind}/{shape}", *(f"{name}{vote}" for name, vote in zip(LABELERS, votes) if vote != ".")]


def reliabilities(votes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over patterns of votes (-1, 0, 1) with counts: chance that a vote is right, and P(true) per pattern."""
    right = np.full(votes.shape[1], PRIOR_RIGHT / (PRIOR_RIGHT + PRIOR_WRONG))
    share = PRIOR_TRUE
    for _ in range(ROUNDS):
        z = np.log(share / (1 - share)) + votes @ np.log(right / (1 - right))
        true = 1 / (1 + np.exp(-z))
        agrees = np.where(votes > 0, true[:, None], 1 - true[:, None]) * (votes != 0) * n[:, None]
        cast = (votes != 0) * n[:, None]
        right = (agrees.sum(0) + PRIOR_RIGHT) / (cast.sum(0) + PRIOR_RIGHT + PRIOR_WRONG)
        right = np.clip(right, 0.55, 0.99)  # a labeler is never taken for worse than chance, nor for infallible
        share = float(np.clip((true @ n + 2 * PRIOR_TRUE) / (n.sum() + 2), 0.02, 0.98))
    return right, true


def train(docs: DataFrame) -> SpanModel:
    """Vote counts of all documents -> reliabilities per kind -> logistic classifier on the probabilities."""
    patterns = sorted(tuple(row) for row in vote_counts(docs).collect())
    targets: list[tuple[list[str], float, float]] = []
    reliability = {}
    for kind in KINDS:
        mine = [p for p in patterns if p[0] == kind]
        if not mine:
            continue
        value = {char: vote for vote, char in VOTE_CHARS.items()}
        votes = np.array([[value[char] for char in p[1]] for p in mine], float)
        n = np.array([p[3] for p in mine], float)
        right, true = reliabilities(votes, n)
        reliability[kind] = right.round(6).tolist()
        targets += [(features(*p[:3]), weight, t) for p, weight, t in zip(mine, n, true)]
    if not targets:
        odds = float(np.log(PRIOR_RIGHT / PRIOR_WRONG))
        return SpanModel({f"{name}{c}": odds * v for name in LABELERS for v, c in VOTE_CHARS.items() if v}, {})
    names = sorted({name for names, _, _ in targets for name in names})
    at = {name: i for i, name in enumerate(names)}
    x = np.zeros((len(targets), len(names)))
    for row, (used, _, _) in enumerate(targets):
        x[row, [at[name] for name in used]] = 1
    weight = np.array([t[1] for t in targets])
    weight = weight / weight.sum() * len(targets)
    y = np.array([t[2] for t in targets])
    w = np.zeros(len(names))
    for _ in range(30):  # Newton steps of a ridge-penalised logistic fit
        p = 1 / (1 + np.exp(-(x @ w)))
        gradient = x.T @ (weight * (p - y)) + 0.1 * w
        curvature = (x.T * (weight * p * (1 - p))) @ x + 0.1 * np.eye(len(names))
        w -= np.linalg.solve(curvature, gradient)
    return SpanModel(dict(zip(names, w.tolist())), reliability)


def kept_spans(text: str | None, model: SpanModel, known: dict) -> list[Candidate]:
    """Base spans and the proposals that the classifier accepts. ``known`` remembers probabilities by pattern."""
    out = []
    for c in candidates(text):
        if not c.base:
            key = (c.kind, c.votes, c.shape)
            if key not in known:
                known[key] = model.probability(*key)
            if known[key] < THRESHOLD:
                continue
        out.append(c)
    return out


SCHEMA = pa.schema(
    [("doc_id", pa.int64()), *((f"n_{kind}", pa.int64()) for kind in BASE_KINDS), ("base_sha256", pa.string()), ("spans", pa.string())]
)
DDL = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def joined(spans: list[Candidate]) -> str:
    return ",".join(f"{c.kind}:{c.start}:{c.end}" for c in spans)


def find_personal_data(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """Spans per document; trains on the same documents where no model is given. No text is shuffled."""
    model = model or train(docs)

    def rows(ids: Iterable, texts: Iterable) -> Iterator[tuple]:
        known: dict = {}
        for doc_id, text in zip(ids, texts):
            spans = kept_spans(text, model, known)
            base = [c for c in spans if c.base]
            counts = [sum(c.kind == kind for c in base) for kind in BASE_KINDS]
            yield doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)

    return per_batch(docs.select("doc_id", "text"), SCHEMA, DDL, rows)


def redacted(text: str, spans: list[Candidate]) -> str:
    """The text with every span, overlapping ones as one, replaced by the kind of its first."""
    out, done = [], 0
    for c in spans:
        if c.start >= done:
            out += [text[done : c.start], f"<{c.kind.upper()}>"]
        done = max(done, c.end)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """The same rows and columns, personal data in ``text`` replaced and ``n_chars``, where it is there, counted anew."""
    model = model or train(docs)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            text_at = batch.schema.get_field_index("text")
            texts = [t and redacted(t, kept_spans(t, model, known)) for t in batch.column(text_at).to_pylist()]
            batch = batch.set_column(text_at, "text", pa.array(texts, batch.schema.field(text_at).type))
            if (n_at := batch.schema.get_field_index("n_chars")) >= 0:
                counts = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(n_at).type)
                batch = batch.set_column(n_at, "n_chars", counts)
            yield batch

    return docs.mapInArrow(run, schema)
