"""The pipeline stage by stage, and the registration of its queries."""

import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

import __spark_entry__ as contract
import corpus_pipeline
from ebbtide.llm import decontaminate, minhash, quality, queries
from oracle import canonical, connect, run_sql

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    names = contract.queries()
    assert {name.split("_")[0] for name in queries.queries()} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.queries()) | {"pipeline"} <= set(names)


def test_stages_follow_each_other(spark, documents):
    docs = documents
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR).cache()
        assert after.columns == docs.columns, name
        kept.append(after.count())
        docs = after
    assert kept[0] > kept[1] > kept[2] > kept[3] == kept[4] > 0
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def test_stages_on_odd_rows(spark, odd_docs):
    """Which rows each stage keeps, row by row: nulls, repeated rows, a row without id, a clashing column."""
    stages = dict(corpus_pipeline.STAGES)
    rows = sorted(map(tuple, odd_docs.collect()), key=key)
    scored = quality.score_quality(odd_docs, quality.train(odd_docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")))
    rejected = {r.doc_id for r in scored.collect() if not r.predicted}
    good = stages["keep_good_documents"](spark, odd_docs, SF_DIR)
    assert sorted(map(tuple, good.collect()), key=key) == [r for r in rows if r[0] not in rejected]
    once = stages["keep_one_of_near_duplicates"](spark, odd_docs, SF_DIR)
    alike = {r for r in rows if r[0] == 4}  # the same text as document 3
    assert sorted(map(tuple, once.collect()), key=key) == sorted(set(rows) - alike, key=key)
    clean = stages["drop_benchmark_leaks"](spark, odd_docs, SF_DIR)
    assert sorted(map(tuple, clean.collect()), key=key) == rows
    plain = stages["redact_personal_data"](spark, odd_docs, SF_DIR)
    assert sorted((r.doc_id is None, r.doc_id) for r in plain.select("doc_id").collect()) == sorted(
        (r[0] is None, r[0]) for r in rows
    )
    changed = {r.doc_id for r in plain.collect()} - {r[0] for r in map(tuple, plain.collect()) if r in rows}
    assert changed == {0, 12}  # a null text has no number of characters; the one text with personal data


def test_stages_on_no_rows(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.collect() == []


def test_the_ids_decode_to_the_redacted_texts(spark, odd_docs):
    """The product: the documents' columns and their ids, which a library turns back into the texts."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(corpus_pipeline.STAGES)["redact_personal_data"](spark, odd_docs, SF_DIR).cache()
    encoded = corpus_pipeline.encode_tokens(spark, texts, SF_DIR)
    others = [name for name in odd_docs.columns if name != "text"]
    assert encoded.columns == [*others, "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    decoded = []
    for row in encoded.collect():
        ids = np.frombuffer(row.ids, "<u4").tolist()
        text = library.decode(ids)
        assert ids == library.encode_ordinary(text) and len(ids) == row.n_tokens
        decoded.append((*[row[name] for name in others], text))
    want = [(*[row[name] for name in others], row.text or "") for row in texts.collect()]
    assert sorted(decoded, key=key) == sorted(want, key=key)


def test_one_id_with_two_texts_loses_neither(spark):
    long = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(5, long, "a"), (5, "an altogether different text of another kind it is", "a"), (5, long, "a"), (6, long, "b"),
            (None, "no id and no like in the whole table here", "c"), (None, long, "c"), (7, None, "d"), (8, "", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = sorted(map(tuple, minhash.keep_one(docs).collect()), key=key)
    assert kept == sorted([rows[0], rows[1], rows[4], rows[6], rows[7]], key=key)


@pytest.mark.parametrize("module", [decontaminate, minhash])
def test_a_worker_remembers_few_words(module):
    """A worker process keeps what it remembers through all stages; what it forgets is hashed again, to the same."""
    words = [f"w{i}" for i in range(60_000)]
    text = " ".join(words + words[:100])
    if module is minhash:
        assert len(minhash.shingle_set(text, 1)) == len(words)
    else:
        want = [xxhash.xxh3_64_intdigest(word.encode()) for word in words + words[:100]]
        assert decontaminate.word_hashes(text).tolist() == want
    assert len(module._word_hashes) <= 25_000


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    df = queries.queries()[name](spark, sf_dir)
    with connect(sf_dir) as duck:
        columns, _, expected = run_sql(duck, queries.oracle_sql()[name])
    assert canonical(df.columns, [tuple(row) for row in df.collect()]) == canonical(columns, expected)
