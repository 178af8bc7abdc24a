"""Operators 11 to 13 against brute force, on odd and empty tables, and on hot groups."""

import hashlib
import random
import zlib
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest

from ebbtide.llm import filter_audit, neighbours, word_runs
from ebbtide.llm.queries import queries
from oracle import canonical

SF_DIR = "/root/testdata/sf0.001"


# --- filter audit -----------------------------------------------------------------


def failed_filters(text):
    words = text.encode().split()
    failed = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
    failed += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text))
    return failed + "D" * any(c in "#$%&*|" for c in text)


def plain_audit(docs, labels):
    """``docs``: (doc_id, text, source); ``labels``: (doc_id, quality, toxic)."""
    good = {i for i, quality, _ in labels if i is not None and quality == 1}
    toxic = {i for i, _, is_toxic in labels if i is not None and is_toxic == 1}
    ids = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            ids.setdefault(text or "", set()).add(doc_id)
    parts = {}
    for doc_id, text, source in docs:
        later = doc_id is not None and min(ids[text or ""]) < doc_id
        parts.setdefault(source or "", []).append((doc_id, failed_filters(text or "") + "E" * later))
    out = []
    for part, held in parts.items():
        removed_by = dict.fromkeys("ABCDE", 0)
        rows = []
        for order in permutations("ABCDE"):
            left = held
            for step, letter in enumerate(order, 1):
                here = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                removed_by[letter] += len(here)
                failing = sum(letter in f for _, f in held)
                rows.append(
                    [part, "".join(order), step, len(left), len(here), failing - len(here)]
                    + [sum(f == letter for _, f in held), sum(i in good for i, _ in here), sum(i in toxic for i, _ in here)]
                )
        out += [(*row, removed_by[row[1][row[2] - 1]]) for row in rows]
    return out


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def check_audit(spark, docs, labels):
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit_filters(frame, marks)
    assert canonical(found.columns, [tuple(r) for r in found.collect()]) == canonical(COLUMNS, plain_audit(docs, labels))


def test_audit_equals_a_plain_one(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text", "source").where("source < 'src15'").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()]
    check_audit(spark, docs, labels)


def test_audit_of_odd_rows_and_of_a_hot_text(spark, odd_docs):
    """Nulls, ties, repeated rows, several label rows, one text that most documents share, an id with two texts."""
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text", "source").collect()]
    docs += [(100 + i, "the same text " * 30, ["s", None, "t"][i % 3]) for i in range(2_500)]
    docs += [(5, "another text of one id", "s"), (None, None, None), (None, "the same text " * 30, "s"), (-7, "", "t")]
    labels = [(100, 1, 0), (101, 0, 1), (101, 1, 0), (None, 1, 1), (5, None, 1), (7, 1, None), (102, 1, 1)]
    check_audit(spark, docs, labels)


def test_audit_of_no_rows(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(no_docs, labels).count() == 0


# --- nearest neighbours -----------------------------------------------------------


def plain_nearest(rows, queries_, k):
    """rows and queries_: (id, vector); products added up in order."""
    out = {}
    for name, query in queries_:
        products = [
            (-sum_in_order(query, vector), i) for i, vector in rows if i != name and len(vector) == len(query)
        ]
        out[name] = [(i, -p) for p, i in sorted(products)[:k]]
    return out


def sum_in_order(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += float(x) * float(y)
    return total


def by_query(frame):
    out = {}
    for row in frame.orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row["rank"] == len(out[row.query_id])
    return out


def recall(found, truth):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in best}) for q, best in truth.items())
    return hits / sum(map(len, truth.values()))


def test_recall_and_scores_on_the_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    truth = plain_nearest(rows, [r for r in rows if r[0] % 20 == 0], 20)
    found = by_query(queries()["op12_neighbours"](spark, SF_DIR))
    assert found.keys() == truth.keys() and all(len(best) == 20 for best in found.values())
    assert recall(found, truth) >= 0.97
    vectors = dict(rows)
    for query, best in found.items():
        assert best == sorted(best, key=lambda hit: (-hit[1], hit[0]))
        assert all(score == sum_in_order(vectors[query], vectors[i]) for i, score in best)


@pytest.mark.parametrize("kind", ["norms", "clusters", "wide"])
def test_recall_over_many_blocks(spark, monkeypatch, kind):
    """Small blocks: norms over six powers of ten, tight clusters with copies, more dimensions than projections."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 200)
    monkeypatch.setattr(neighbours, "FIRST_LOOK", 40)
    monkeypatch.setattr(neighbours, "GROUP_QUERIES", 30)
    random_ = np.random.default_rng(7)
    dim = 160 if kind == "wide" else 12
    matrix = random_.standard_normal((1_200, dim))
    if kind == "norms":
        matrix *= 10.0 ** random_.integers(-3, 4, (1_200, 1))
    if kind == "clusters":
        matrix = matrix[random_.integers(0, 6, 1_200)] + 1e-4 * random_.standard_normal((1_200, dim))
        matrix[:500] = 1.5 * matrix[0]  # copies of one vector, the nearest of each other
    rows = list(enumerate(matrix.tolist()))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = by_query(neighbours.nearest(frame.where("vec_id % 20 = 0"), frame, k=10))
    truth = plain_nearest(rows, rows[::20], 10)
    assert recall(found, truth) >= 0.95
    if kind == "clusters":  # ties go to the smaller id
        assert [i for i, _ in found[0]] == list(range(1, 11))


def test_odd_vectors(spark):
    """Null, empty, zero, unfinished and infinite vectors, other lengths, repeated rows, few candidates, extra columns."""
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]),
        (5, [1.0, None]), (6, [nan, 1.0]), (7, [1.0, -inf]), (None, [1.0, 1.0]), (8, [1.0, 1.0, 1.0]), (20, [0.0, -2.0]),
        (40, [3.0, 4.0, 0.0]), (9, [0.5, 0.5]),
    ]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, id string")
    found = by_query(neighbours.nearest(frame.where("vec_id % 20 = 0"), frame, k=20))
    assert found == {
        0: [(1, 0.5), (9, 0.5), (20, 0.0)],
        20: [(0, 0.0), (1, -1.0), (9, -1.0)],
        40: [(8, 7.0)],
    }
    none = frame.where("vec_id < 0")
    assert neighbours.nearest(none, frame).count() == 0 and neighbours.nearest(frame, none).count() == 0
    assert neighbours.nearest(frame, none).columns == ["query_id", "rank", "vec_id", "score"]


# --- runs -------------------------------------------------------------------------


def plain_runs(words):
    found = []
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at < len(words) - period:
            end = at
            while end < len(words) - period and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            stretch = words[at : at + length]
            smaller = any(stretch[p:] == stretch[:-p] for p in range(1, period))
            if end > at and length >= max(6, 4 * period) and not smaller:
                found.append((at, length, period))
            at = max(end, at + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % period] for i in range(n)]


def plain_row(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    kept = b" ".join(word for i, word in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_equal_a_plain_scan_on_random_words():
    chance = random.Random(13)
    for _ in range(1_500):
        words = [b"%d" % chance.randrange(chance.choice([1, 2, 3, 6])) for _ in range(chance.choice([0, 5, 7, 20, 90, 160]))]
        for _ in range(chance.randrange(4) if len(words) > 8 else 0):
            a = chance.randrange(len(words))
            period = 1 + chance.randrange(max(1, (len(words) - a) // 3))
            for i in range(a, chance.randrange(a, len(words) + 1)):
                words[i] = words[a + (i - a) % period]
        assert [tuple(run) for run in word_runs.find_runs(words)] == plain_runs(words)


def test_segments_lose_no_run_and_split_to_stability():
    words = b"a b a b c a b a b x a b a b a b a b y z".split()
    for begin, end in word_runs.segments(words):
        held = words[begin:end]
        assert min(map(held.count, held)) >= word_runs.LEAST_COPIES
    assert [tuple(r) for r in word_runs.find_runs(words)] == [(10, 8, 2)]


@pytest.mark.parametrize("name", ["one word", "two words", "one long period"])
def test_ten_megabytes(name):
    chance = random.Random(3)
    if name == "one word":
        words, least = [b"abcd"] * 2_000_000, 1
    elif name == "two words":
        words, least = [b"%d" % chance.randrange(2) for _ in range(400_000)], 1_000
    else:
        words, least = [b"%d" % chance.randrange(50_000) for _ in range(90_000)] * 5, 1
    assert len(word_runs.find_runs(words)) >= least


def test_the_query_equals_a_plain_scan(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found = queries()["op13_word_runs"](spark, SF_DIR)
    expected = [plain_row(*row) for row in rows]
    assert sum(row[1] > 0 for row in expected) > 10
    assert canonical(found.columns, [tuple(r) for r in found.collect()]) == canonical(found.columns, expected)


def test_runs_of_odd_and_no_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()] + [(i, "", ) for i in range(50, 90)]
    frame = spark.createDataFrame([(*row, "x") for row in rows], "doc_id long, text string, runs string")
    found = word_runs.run_digests(word_runs.collapse_runs(word_runs.with_planted_repeats(frame)))
    assert canonical(found.columns, [tuple(r) for r in found.collect()]) == canonical(
        found.columns, [plain_row(*row) for row in rows]
    )
    assert word_runs.run_digests(word_runs.collapse_runs(word_runs.with_planted_repeats(no_docs))).count() == 0
