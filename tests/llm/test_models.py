"""Quality, near duplicates and decontamination against brute force and held-out rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import decontaminate, minhash, quality
from ebbtide.llm.components import connected_components


def test_held_out_quality(spark):
    """Area on held-out rows, which are never learned from."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = quality.score_quality(docs, quality.train(docs, labels))
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    good = np.array([r.score for r in rows if r.quality == 1])
    poor = np.array([r.score for r in rows if r.quality == 0])
    assert (good[:, None] > poor[None, :]).mean() > 0.99
    assert (good >= quality.THRESHOLD).mean() > 0.98 and (poor < quality.THRESHOLD).mean() > 0.9


def test_quality_of_odd_and_empty_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 1), (6, None), (99, 1)], "doc_id long, quality int")
    model = quality.train(odd_docs, labels)
    rows = quality.score_quality(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= quality.THRESHOLD) for r in rows)
    assert quality.keep_good(odd_docs, model).schema == odd_docs.schema
    untrained = quality.train(no_docs, labels.where("false"))
    assert quality.score_quality(no_docs, untrained).collect() == []
    assert quality.score_quality(odd_docs, untrained).first().score == 0.5


def test_pair_tables_learn_what_no_single_feature_shows():
    rng = np.random.default_rng(1)
    rows = rng.random((4000, 3))
    target = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    model = quality.fit(rows, target)
    assert (1, 0) in model.pairs[:1]
    assert ((model.score(rows) > 0.5) == (target == 1)).mean() > 0.9


def words_of(text):
    return (text or "").encode().lower().split()


def brute_components(texts, size, percent):
    sets = {}
    for i, text in texts.items():
        words = words_of(text)
        grams = zip(*(words[k:] for k in range(size))) if len(words) >= size else [tuple(words)] if words else []
        sets[i] = set(grams)
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {i: (len(sets[i]), find(i)) for i in texts}


@pytest.mark.parametrize(("size", "percent"), [(2, 80), (5, 80)])
def test_near_duplicates_equal_all_pairs(documents, texts, size, percent):
    rows = minhash.near_duplicates(documents, size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(texts, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_a_large_group_of_unlike_neighbours(spark, monkeypatch):
    """Copies of one text with ever more words changed: links form chains that no hub reaches."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    base = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(base[: 60 - i] + [f"x{j}" for j in range(i)]) for i in range(40)}
    texts |= {100 + i: " ".join(base[:50] + [f"y{i}_{j}" for j in range(10)]) for i in range(40)}
    texts |= {200: None, 201: "", 202: "one", 203: "ONE", 204: "one two", 205: "one two"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = minhash.near_duplicates(docs, 2, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(texts, 2, 80)


def test_keep_one_keeps_columns_and_rows_without_id(odd_docs, no_docs):
    kept = minhash.keep_one(odd_docs, 2, 80)
    assert kept.columns == odd_docs.columns and kept.dtypes == odd_docs.dtypes
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 1 and len(ids) == len(set(ids)) and 3 in ids and 4 not in ids and {0, 1, 2} <= set(ids)
    assert minhash.near_duplicates(no_docs).collect() == []


def test_posterior_bounds_prune_and_keep():
    needed = minhash.least_matches(80)
    assert [n for n, _ in needed] == list(range(25, 201, 25))
    same = np.zeros((1, minhash.SIGNATURE), np.uint32)
    far = np.arange(minhash.SIGNATURE, dtype=np.uint32)[None, :] + 1
    assert minhash.may_reach(same, same, needed).all() and not minhash.may_reach(same, far, needed).any()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "u long, v long")
    roots = {r.node: r.root for r in connected_components(links).collect()}
    assert roots == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert connected_components(links.where("false")).collect() == []


def plain_alignment(item, text):
    """Smith-Waterman cell by cell."""
    best = [[0.0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item):
        for j, b in enumerate(text):
            best[i + 1][j + 1] = max(0, best[i][j] + (1 if a == b else -decontaminate.MISMATCH),
                                     best[i][j + 1] - decontaminate.GAP, best[i + 1][j] - decontaminate.GAP)
    return max(map(max, best))


def test_alignment_equals_the_plain_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(50):
        item, text = rng.integers(0, 6, 12).astype(np.uint64), rng.integers(0, 6, 30).astype(np.uint64)
        assert decontaminate.best_local(item, text)[0] == pytest.approx(plain_alignment(item, text))


def test_copies_and_edits_are_found_and_clean_documents_are_not(spark, documents):
    item = " ".join(f"word{i}" for i in range(40))
    edited = " ".join("other" if i % 5 == 2 else f"word{i}" for i in range(40) if i != 20)
    benchmark = spark.createDataFrame([(1, item), (2, "Tiny item."), (3, None), (4, "")], "item_id long, text string")
    rows = [(9001, f"before {item.upper()} after"), (9002, f"a b {edited} c"), (9003, "a tiny thing"),
            (9004, "it says tiny item!"), (9005, None), (9006, "word1 word2 word3 word4 and more")]
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert set(found) == {(9001, 1), (9002, 1), (9004, 2)}
    assert found[9001, 1].score == 1 and (found[9001, 1].first_word, found[9001, 1].last_word) == (1, 40)
    kept = decontaminate.drop_leaks(docs, benchmark)
    assert kept.count() == docs.count() - 3 and kept.where(F.col("doc_id").isin(9001, 9002, 9004)).count() == 0


def test_leaks_of_odd_and_empty_tables(spark, odd_docs, no_docs):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert decontaminate.find_leaks(no_docs, benchmark).collect() == []
    assert decontaminate.find_leaks(odd_docs, benchmark.where("false")).collect() == []
    assert decontaminate.drop_leaks(odd_docs, benchmark).schema == odd_docs.schema


@pytest.mark.parametrize("copies", [50, 1000])
def test_parts_of_an_item_are_found_however_many_documents_hold_them(spark, copies):
    """What is copied is common, the rest of the item is not."""
    item = [f"word{i}" for i in range(40)]
    edited = " ".join("other" if i % 4 == 3 else word for i, word in enumerate(item))
    half = " ".join(item[11:31])
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = [(i, f"x{i} {edited} y{i}") for i in range(copies)] + [(copies + i, f"{half} z{i}") for i in range(copies)]
    rows += [(-1 - i, f"word{i} and {' '.join(item[2 * i : 2 * i + 3])} alone") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.score for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert sorted(found) == list(range(2 * copies))
    assert all(score == (0.6375 if i < copies else 0.5) for i, score in found.items())
    assert decontaminate.drop_leaks(docs, benchmark).count() == 10


def test_an_excerpt_of_a_long_item_is_found_wherever_it_begins():
    """As many words of the excerpt as a part would need, across the borders too; one word less is not enough."""
    item = decontaminate.word_hashes(" ".join(f"word{i}" for i in range(401)))
    block = decontaminate.Block([decontaminate.Passage(1, words, unit) for words, unit in decontaminate.cut(item)])
    noise = decontaminate.word_hashes(" ".join(f"noise{i}" for i in range(60)))
    for length, found in ((54, True), (100, True), (401, True), (53, False)):
        for begin in range(0, 402 - length, 7):
            got = block.matches(np.concatenate([noise, item[begin : begin + length], noise]))
            assert bool(got) == found, (length, begin)
            assert not found or (got[1][1] >= 60 and got[1][2] < 60 + length and got[1][0] <= 1)
    edited = np.where(np.arange(401) % 4 == 3, noise[0], item)
    assert all(block.matches(edited[begin : begin + 100]) for begin in range(0, 302))


def test_regular_edits_leave_seeds(spark):
    """Every third word replaced, one put in after every word, every third left out."""
    items = [r.text.lower().split() for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()]
    for i, item in enumerate(items):
        words = decontaminate.word_hashes(" ".join(item))
        block = decontaminate.Block([decontaminate.Passage(i, words, len(words))])
        other = np.arange(1, len(words) + 1).astype(np.uint64)
        replaced = np.where(np.arange(len(words)) % 3 == 2, other, words)
        put_in = np.stack([words, other], axis=1).ravel()
        left_out = words[np.arange(len(words)) % 3 != 2]
        assert all(block.matches(text) for text in (replaced, put_in, left_out))


def test_no_alignment_of_the_least_score_is_missed():
    """Few different words, so that scores lie on both sides of the least one; every text is aligned whole."""
    rng = np.random.default_rng(9)
    reached = 0
    for words in (4, 12, 40):
        held = [rng.integers(1, words, n).astype(np.uint64) for n in (1, 2, 5, 7, 8, 9, 13, 20, 30)]
        block = decontaminate.Block([decontaminate.Passage(i, item, len(item)) for i, item in enumerate(held)])
        for _ in range(60):
            text = rng.integers(1, words, rng.integers(1, 80)).astype(np.uint64)
            got = block.matches(text)
            for i, item in enumerate(held):
                score = round(decontaminate.best_local(item, text)[0] / len(item), 6)
                reached += score >= block.held[i].least_score
                assert (i in got) == (score >= block.held[i].least_score)
                assert i not in got or got[i][0] == score
    assert 300 < reached < 1500


def test_an_item_is_reported_once_however_many_blocks_there_are(spark, monkeypatch):
    items = {i: " ".join(f"w{i}x{j}" for j in range(900)) for i in range(4)}
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    docs = spark.createDataFrame([(10 + i, f"a {text} b") for i, text in items.items()], "doc_id long, text string")
    at_once = sorted(decontaminate.find_leaks(docs, benchmark).collect())
    assert [(r.doc_id, r.item_id) for r in at_once] == [(10 + i, i) for i in range(4)]
    monkeypatch.setattr(decontaminate, "BLOCK_PASSAGES", 3)
    assert sorted(decontaminate.find_leaks(docs, benchmark).collect()) == at_once


def test_scores_equal_sums_made_row_by_row(spark, documents):
    """Bins and pair bins looked up one value at a time; features with few values have several pair bins."""
    model = quality.train(documents, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    texts = [r.text for r in documents.select("text").limit(60).collect()]
    rows = quality.feature_rows(texts)
    used = set()
    for row, score in zip(rows, model.score(rows)):
        bins = [sum(value >= edge for edge in edges) for value, edges in zip(row, model.edges)]
        total = model.base + sum(table[b] for table, b in zip(model.tables, bins))
        few = [b if len(edges) < 8 else b * 8 // (len(edges) + 1) for b, edges in zip(bins, model.edges)]
        total += sum(table[few[a], few[b]] for (a, b), table in zip(model.pairs, model.pair_tables))
        used |= {(i, b) for i, b in enumerate(few)}
        assert score == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-12)
    for i, edges in enumerate(model.edges):
        if len(edges) > 1 and len({row[i] for row in rows}) > 3:
            assert len({b for j, b in used if j == i}) > 1


def test_training_rows_are_bounded_and_any_integer_names_a_document(spark, monkeypatch):
    docs = spark.range(3).selectExpr("CAST(id % 2 + 1 AS INT) AS doc_id", "'some words here' AS text")
    docs = docs.union(spark.range(500).selectExpr("CAST(7 AS INT) AS doc_id", "concat('text ', id) AS text"))
    labels = spark.range(40).selectExpr("CAST(id AS INT) AS doc_id", "CAST(id % 2 AS INT) AS quality")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, target: seen.append(len(rows)) or quality.QualityModel(0.0, [np.array([])] * len(quality.FEATURES), [np.zeros(quality.BINS)] * len(quality.FEATURES), [], []))
    model = quality.train(docs, labels, rows=20)
    assert seen[0] <= 3  # one row per document, however often it is in the table
    assert quality.score_quality(docs, model).count() == 503
