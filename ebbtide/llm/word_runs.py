"""Operator 13: periodic runs of words, by recursive frequency splitting and a lag scan of what survives.

A run is a stretch of at least ``LEAST_WORDS`` words and ``LEAST_COPIES`` smallest periods that no neighbouring word
extends. Each of its words stands in it ``LEAST_COPIES`` times or more, so a word that a segment holds less often than
that is in no run of the segment: it splits the segment, and the pieces are split again until nothing splits. Counts of
the largest piece are those of the segment less the rest, so a word is counted again only where its piece has halved.

The lag scan looks for periods g to 2 g - 1 with blocks of 2 g words, g = 1, 2, 4 and so on. A run of such a period q
holds, from a multiple of g on, a block that comes again q words later, and not sooner: a block longer than the period
that came sooner would make the period smaller. So each block names one lag, the distance to its next occurrence; a run
is found from any of its blocks by comparing words at that lag in both directions, and q is its smallest period. Blocks
are numbered exactly, by the pair of numbers of their halves. Work is a few sorts of the surviving words for each of the
log n sizes, also for a text of one word a million times over.

Words are separated by ASCII white space. Null and empty texts have no words and no runs. Documents are handled row by
row: repeated rows and rows with a null doc_id give a row each. Columns other than doc_id and text are not read. What a
task holds is a batch of texts and, for one text at a time, some tens of bytes per word that survives.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import per_batch

LEAST_COPIES = 4
LEAST_WORDS = 6


class Run(NamedTuple):
    start: int
    length: int
    period: int

    @property
    def least(self) -> int:
        return max(LEAST_WORDS, LEAST_COPIES * self.period)


def segments(words: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """Stretches (begin, end) in which every word occurs ``LEAST_COPIES`` times or more; all runs lie inside them."""
    places: dict[bytes, list[int]] = {}
    for place, word in enumerate(words):
        places.setdefault(word, []).append(place)
    counts = {word: len(held) for word, held in places.items()}
    pending = [(0, len(words), counts, list(counts))]
    while pending:
        begin, end, counts, suspects = pending.pop()
        cuts = []
        for word in suspects:
            if 0 < counts[word] < LEAST_COPIES:
                first = bisect_left(places[word], begin)
                cuts += places[word][first : first + counts[word]]
        cuts.sort()
        pieces = [(a, b) for a, b in zip([begin, *(c + 1 for c in cuts)], [*cuts, end]) if b - a >= LEAST_WORDS]
        if not cuts:
            yield from pieces
            continue
        for a, b in pieces:
            if 2 * (b - a) > end - begin:  # the one large piece keeps the counts, less those of what it lost
                lost = Counter(words[begin:a])
                lost.update(words[b:end])
                for word, n in lost.items():
                    counts[word] -= n
                pending.append((a, b, counts, list(lost)))
            else:
                mine = Counter(words[a:b])
                pending.append((a, b, mine, list(mine)))


def _first_difference(codes: np.ndarray, at: int, lag: int, forward: bool) -> int:
    """Going from ``at``, the first place whose word differs from the one ``lag`` later (or the place before it)."""
    step, end = 64, len(codes) - lag
    while at < end if forward else at > 0:
        low, high = (at, min(at + step, end)) if forward else (max(at - step, 0), at)
        other = np.flatnonzero(codes[low:high] != codes[low + lag : high + lag])
        if len(other):
            return low + int(other[0]) if forward else low + int(other[-1]) + 1
        at, step = high if forward else low, min(2 * step, 1 << 16)
    return at


def lag_scan(codes: np.ndarray) -> Iterator[Run]:
    """All runs of a segment."""
    names, g = codes.astype(np.int64), 1
    while 4 * g <= len(codes) or g == 1 and len(codes) >= LEAST_WORDS:
        # names of blocks of 2 g words from those of g words, and for each block its next occurrence
        pairs = names[: len(names) - g] * (int(names.max()) + 1) + names[g:]
        order = np.argsort(pairs, kind="stable")
        changes = pairs[order[1:]] != pairs[order[:-1]]
        if changes.all():
            return  # no block comes twice
        names = np.empty(len(pairs), np.int64)
        names[order] = np.concatenate([[0], np.cumsum(changes)])
        lags = np.zeros(len(pairs), np.int64)
        lags[order[:-1]] = np.where(changes, 0, order[1:] - order[:-1])
        anchors = np.arange(0, len(pairs), g)
        anchors = anchors[(lags[anchors] >= g) & (lags[anchors] < 2 * g)]
        anchors = anchors[np.argsort(lags[anchors], kind="stable")]
        periods, firsts = np.unique(lags[anchors], return_index=True)
        for period, mine in zip(periods.tolist(), np.split(anchors, firsts[1:])):
            at = 0
            while at < len(mine):
                start = _first_difference(codes, int(mine[at]), period, forward=False)
                stop = _first_difference(codes, int(mine[at]), period, forward=True)
                run = Run(start, stop + period - start, period)
                if run.length >= run.least:
                    yield run
                at = int(np.searchsorted(mine, stop))  # blocks up to there are in the same stretch
        g *= 2


def find_runs(words: Sequence[bytes]) -> list[Run]:
    """All runs by start, then period."""
    found = []
    for begin, end in segments(words):
        number: dict[bytes, int] = {}
        codes = np.array([number.setdefault(word, len(number)) for word in words[begin:end]], np.int64)
        found += [run._replace(start=run.start + begin) for run in lag_scan(codes)]
    return sorted(found, key=lambda run: (run.start, run.period))


def most_repeated(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period; of several the first, then the one of the smallest period."""
    best = None
    for run in runs:
        if best is None or run.length * best.period > best.length * run.period:
            best = run
    return best


def collapsed(words: Sequence[bytes], runs: list[Run]) -> Sequence[bytes]:
    """The words that are not in a run after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for run in runs:
        kept[run.start + run.period : run.start + run.length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(_RUN)), ("best", _RUN), ("collapsed", pa.string())])
_RUN_DDL = "struct<start:long,length:long,period:long>"
DDL = f"doc_id long, runs array<{_RUN_DDL}>, best {_RUN_DDL}, collapsed string"


def collapse_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, best, collapsed): all runs of a text, the most repeated one, and the text without repeats."""

    def rows(ids: Iterable, texts: Iterable) -> Iterator[tuple]:
        for doc_id, text in zip(ids, texts):
            words = (text or "").encode().split()  # bytes: ASCII white space only
            runs = find_runs(words)
            best = most_repeated(runs)
            yield doc_id, [r._asdict() for r in runs], best and best._asdict(), b" ".join(collapsed(words, runs)).decode()

    return per_batch(docs.select(F.col("doc_id").cast("long"), "text"), SCHEMA, DDL, rows)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which the tail of about every tenth text repeats its own first words.

    h is the crc32 of the id as text and g = floor(h / 10). Where h % 10 is 0, the words from a = g % n on repeat with
    period 1 + floor((n - a) / (3 + g % 8)). Texts without words and rows without an id stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")

    def planted(row: Column) -> Column:
        n, g = F.size(row["words"]), F.floor(row["h"] / 10)
        a = F.pmod(g, n)
        period = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        place = F.transform(
            F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i.cast("long")).otherwise(a + F.pmod(i - a, period))
        )
        repeated = F.transform(place, lambda i: F.get(row["words"], i.cast("int")))
        return F.when(n > 0, F.concat_ws(" ", repeated)).otherwise(F.lit(""))

    row = F.array(F.struct(words.alias("words"), h.alias("h")))
    text = F.when(h % 10 == 0, F.element_at(F.transform(row, planted), 1)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """What ``collapse_runs`` found, with digests in place of the runs and the text."""
    best = F.col("best")
    line = F.array_join(
        F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), ""
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(line.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
