"""Byte-level BPE, token files, archives and fingerprints against libraries, round trips and plain versions."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from ebbtide.llm import bpe, fingerprints, token_files, warc

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def key(row):
    return tuple("" if v is None else str(v) for v in row)


@pytest.mark.parametrize("frame", ["odd_docs", "documents", "no_docs"])
def test_bpe_equals_the_library(request, frame, vocabulary, library, sha256):
    docs = request.getfixturevalue(frame)
    got = [tuple(r) for r in bpe.round_trip_digests(docs, vocabulary).collect()]
    want = []
    for row in docs.collect():
        ids = library.encode_ordinary(row.text or "")
        want.append((row.doc_id, len(ids), sha256(np.array(ids, "<u4").tobytes()), sha256(row.text or "")))
    assert sorted(got, key=key) == sorted(want, key=key)


def test_bpe_without_known_words_and_with_long_words(spark, vocabulary, library, monkeypatch):
    """What no sample knows is merged where it stands; long words go the other way."""
    monkeypatch.setattr(bpe, "SAMPLE_BYTES", 0)
    monkeypatch.setattr(bpe, "LONG_WORD", 6)
    texts = ["unbelievable circumstances", "aaaaaaaaaaaaaaaa", "ab" * 300, "  " * 50 + "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()
    for row in rows:
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode_ordinary(texts[row.doc_id])
        assert bytes(row.decoded).decode() == texts[row.doc_id]


def test_the_ranks_are_in_no_text_of_the_plan_and_in_no_row(spark, vocabulary, plan_text):
    """The driver keeps plans and their texts, one for every action: as a literal, the ranks took megabytes in each."""
    docs = spark.createDataFrame([(1, "unbelievable circumstances")], "doc_id long, text string")
    encoded = bpe.encode(docs, vocabulary)
    assert len(plan_text(encoded)) < 100_000
    assert encoded._jdf.queryExecution().toString().count("rank_maps") > 0
    assert "rank_maps" not in plan_text(encoded)


def test_splits_agree_with_the_pattern(library):
    for text in ("plain text's end", "\x1c\x1d a\x85b᠎ c", "½² Ⅷ٣", "á ñ _x_", "  　x"):
        assert "".join(bpe.split_words(text, bpe.WORD_PATTERN)) == text
        parts = [library.decode(library.encode_ordinary(word)) for word in bpe.split_words(text, bpe.WORD_PATTERN)]
        assert sum((library.encode_ordinary(p) for p in parts), []) == library.encode_ordinary(text)


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("count", [0, 1, 9, 65_536, 70_001])
def test_planes_round_trip(bits, count):
    ids = np.random.default_rng(count).integers(0, 1 << 32, count, np.uint32)
    assert (token_files.unpack(token_files.pack(ids, bits)) == ids).all()
    assert (token_files.unpack(token_files.pack(ids, bits), 1) == ids[65_536:]).all()


@pytest.mark.parametrize("frame", ["odd_docs", "documents", "no_docs"])
def test_token_files(request, frame, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK_IDS", 5_000)
    docs = request.getfixturevalue(frame)
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    got = sorted((tuple(r) for r in token_files.token_files_round_trip(docs, JSON).collect()), key=lambda r: r[1])
    order = [-1 if r[0] is None else r[0] for r in got]
    assert order == sorted(order) and len(got) == docs.count()
    sizes = {}
    for row in docs.collect():
        ids = np.array([*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 2], "<u4")
        sizes[row.doc_id] = (len(ids), zlib.crc32(ids.tobytes()))
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1]][: len(got)]
    assert all(sizes[r[0]] == r[2:] for r in got)


def test_strings_of_added_tokens_are_encoded_as_the_library_does_by_default(spark):
    texts = ["a<|endoftext|>b", "<|endoftext|>", "it's  <|endoftext|><|endoftext|> x\n", "<|endoftext|", "plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in token_files.token_files_round_trip(docs, JSON).collect())
    tokenizer = Tokenizer.from_file(JSON)
    want = [np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4") for text in texts]
    assert [r[2:] for r in got] == [(len(ids), zlib.crc32(ids.tobytes())) for ids in want]
    assert want[0].tolist() == [64, 50256, 65, 2]


def plain_archive(pages):
    largest = {}
    for row in pages:
        payload = (row.html or "").encode()
        if len(payload) >= 1000 and row.page_id is not None:
            largest[payload] = max(row.page_id, largest.get(payload, row.page_id))
    out = []
    for row in pages:
        payload = (row.html or "").encode()
        to = largest.get(payload) if len(payload) >= 1000 else None
        kind = "response" if to is None or to == row.page_id else "revisit"
        out.append((row.page_id, len(payload), hashlib.sha1(payload).hexdigest(), kind, to if kind == "revisit" else None))
    return sorted(out, key=key)


def test_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    copy, tricky = "c" * 1500, "WARC/1.1\r\n\r\n" * 100 + "\r\n\r\n"
    more = [(5000 + i, f"http://Same.Host.example/{i % 3}", copy) for i in range(40)] + [
        (6000, None, None), (6001, "no scheme", ""), (6002, "http://a.b/\r\nX: y", tricky), (6003, "http://a.b/", tricky),
        (6003, "http://a.b/", tricky), (None, "http://n.o/", copy), (6004, "http://ü.example/ß?q#f", "ü" * 499),
    ]
    both = pages.union(spark.createDataFrame(more, pages.schema))
    rows = warc.archive_round_trip(both).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=key) == plain_archive(both.collect())
    assert len({r.file for r in rows}) > 3
    history = [(r.url_key.encode(), r.captured_at) for r in rows]
    assert history == sorted(history)
    assert warc.archive_round_trip(pages.where("false")).collect() == []


def test_loser_tree_merges_any_runs():
    rng = np.random.default_rng(3)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(("r", f"{v:03}", "t", 0) for v in rng.integers(0, 50, rng.integers(0, 9))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(c for run in runs for c in run)


def test_runs_that_arrive_out_of_order_are_cut():
    captures = [("f", "b", "t", 1), ("g", "a", "t", 2), ("f", "c", "t", 3), ("f", "a", "t", 4)]
    assert [len(run) for run in warc.sorted_runs(captures)] == [2, 1, 1]


def plain_levels(data):
    out = []
    for i in range(len(data) - fingerprints.WINDOW + 1):
        counts = np.bincount(data[i : i + fingerprints.WINDOW], minlength=256)
        bits = np.log2(fingerprints.WINDOW) - sum(c * np.log2(c) for c in counts if c) / fingerprints.WINDOW
        out.append(bits * fingerprints.LEVELS / np.log2(fingerprints.WINDOW))
    return np.array(out)


def test_entropies_equal_direct_counts():
    data = np.random.default_rng(4).integers(97, 105, 400).astype(np.uint8)
    data[100:230] = 97
    exact = plain_levels(data)
    got = fingerprints.entropy_levels(data)
    assert (np.abs(got - np.clip(np.floor(exact), 0, 255)) <= 1).all()


@pytest.mark.parametrize("frame", ["odd_docs", "documents", "no_docs"])
def test_fingerprints(request, frame, sha256, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 20_000)
    docs = request.getfixturevalue(frame)
    rows = fingerprints.fingerprint_documents(docs).collect()
    assert len(rows) == docs.count()
    of_text = {}
    for row in docs.collect():
        of_text.setdefault(row.doc_id, row.text or "")
    by_text = {}
    for r in rows:
        text = of_text[r.doc_id]
        assert r.n_chars == len(text) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
    if frame == "documents":
        order = sorted(of_text)
        following = dict(zip(order, [*order[1:], order[0]]))
        for r in rows:
            text, half = of_text[r.doc_id], len(of_text[r.doc_id]) // 2
            changed = text[: len(text) - half] + of_text[following[r.doc_id]][:half]
            assert r.edited_sha256 == sha256(changed)
            assert r.near_next == 1 or of_text[following[r.doc_id]] != text


def test_likeness_follows_the_shared_part():
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(4000)]
    ranks = fingerprints.rarity_ranks(np.arange(fingerprints.LEVELS))
    base = fingerprints.Fingerprint(" ".join(words[:1500]), ranks)
    near = fingerprints.Fingerprint(" ".join(words[:1400] + words[2000:2100]), ranks)
    half = fingerprints.Fingerprint(" ".join(words[:750] + words[2000:2750]), ranks)
    far = fingerprints.Fingerprint(" ".join(words[2500:]), ranks)
    a, b, c = (fingerprints.likeness(base, other) for other in (near, half, far))
    assert fingerprints.likeness(base, base) == 1 and a > b > c and c < 0.1
    assert fingerprints.likeness(near, base) == a


def test_large_pages_go_to_files_of_their_own(spark, monkeypatch):
    """No file beyond the bound but for a page that is larger itself; every page reads back."""
    monkeypatch.setattr(warc, "FILE_BYTES", 12_000)
    monkeypatch.setattr(warc, "RANGE_CAPTURES", 40)
    sizes = [100] * 1200 + [11_000] * 40 + [250_000] * 3 + [0]
    rows = [(i, f"http://example.org/{i % 50}", chr(97 + i % 26) * size) for i, size in enumerate(sizes)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    found = {r.page_id: r for r in warc.archive_round_trip(pages).collect()}
    assert {i: r.payload_bytes for i, r in found.items()} == dict(enumerate(sizes))
    ends = {}
    for r in found.values():
        ends[r.file] = max(ends.get(r.file, 0), r.offset + r.length)
    assert len(ends) >= 6 and all(end < 270_000 for end in ends.values())
    assert warc.size_classes(0, 0, 0)[0][1] >= 1
