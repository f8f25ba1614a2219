"""Archives, token files, near-duplicates and search against plain Python."""

import base64
import gzip
import hashlib
import json
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from lodgeworks.llm import tokens
from lodgeworks.llm.catalog import QUERIES
from lodgeworks.llm.components import connected_components
from lodgeworks.llm.knn_join import voronoi_topk
from lodgeworks.llm.simhash import agreement_masks, drop_near_duplicates, linked, near_duplicates, near_links, reference_fingerprints
from lodgeworks.llm.tokens import WordMemo, decode_ranks, encode_ranks, read_tokens, write_tokens
from lodgeworks.llm.warc import archive_round_trip, read_archives, write_archives
from tests.llm.helpers import awkward_docs, docs_frame, empty_frame, prose

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
MEMO = WordMemo(VOCABULARY)


def test_archives_round_trip(spark, tmp_path):
    rows = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, None, None), (4, "http://c/\r\nX: y", ""), (5, "u", "é\r\n\r\nWARC/1.1\r\n"),
            (6, "u", "z" * 500_000), (None, "n", "<p>x</p>"), (None, "n", "only"), (7, "v", "<p>x</p>"), (7, "v", "<p>x</p>"), (1, "http://a/", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for least in (0, 5):
        path = str(tmp_path / f"w{least}")
        write_archives(pages, path, min_bytes=least)
        back = read_archives(spark, path).collect()
        assert len(back) == len(rows)
        first = {}
        for i, _, h in rows:
            if i is not None and len((h or "").encode()) >= least:
                first[h or ""] = min(first.get(h or "", i), i)
        for r in back:
            payloads = {h or "" for i, _, h in rows if i == r.page_id and base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() == r.payload_digest}
            assert len(payloads) == 1
            payload = payloads.pop()
            again = payload in first and r.page_id != first[payload]
            assert (r.record_type, r.refers_to) == (("revisit", first[payload]) if again else ("response", None))
            assert r.payload_bytes == len(payload.encode()) and r.payload == (None if again else payload) and r.intact == (None if again else True)
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in Path(tmp_path / "w0").glob("*.gz"))
    assert raw.count(b"WARC-Type: revisit") == 5 and b"identical-payload-digest" in raw
    assert archive_round_trip(pages.limit(0)).collect() == []


@given(st.lists(st.integers(0, 2**32 - 1)))
@settings(max_examples=200, deadline=None)
def test_variable_length_coding(values):
    control, data = encode_ranks(np.array(values, dtype=np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert decode_ranks(control, data, len(values)).tolist() == values


@given(st.lists(st.lists(st.one_of(st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=9), max_size=8))
@settings(max_examples=200, deadline=None)
def test_parts_are_coded_together(parts):
    values, lengths = np.array(sum(parts, []), dtype=np.uint32), np.array([len(p) for p in parts], dtype=np.int64)
    coded = tokens.encode_parts(values, lengths)
    assert coded == [encode_ranks(np.array(p, dtype=np.uint32)) for p in parts]
    assert tokens.decode_parts([c for c, _ in coded], [d for _, d in coded], lengths).tolist() == values.tolist()


def test_blocks_of_ids_hold_every_part_once():
    assert list(tokens.together([3, 0, 5, 9, 1, 1], 5)) == [(0, 2), (2, 3), (3, 4), (4, 6)]
    assert list(tokens.together([], 5)) == [] and list(tokens.together([0, 0], 5)) == [(0, 2)]


@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), st.sampled_from(" \n\t'stredvm.,!12é\u0301Σ\u212a\u2003中\u0130\u00ad"), st.characters(exclude_categories=["Cs"]))))
@settings(max_examples=600, deadline=None)
def test_words_encode_like_whole_texts(text):
    memo = MEMO
    for t in (text, "<|endoftext|>" + text, text + " it's don't 3rd " + text):
        assert np.frombuffer(memo.ids(t), dtype=memo.dtype).tolist() == memo.tokenizer.encode(t, add_special_tokens=False).ids


def test_a_full_memory_keeps_the_ids(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_WORDS", 3)
    monkeypatch.setattr(tokens, "MEMO_PIECES", 4)
    monkeypatch.setattr(tokens, "MEMO_ODD", 1)
    memo = WordMemo(VOCABULARY)
    for _ in range(3):
        for text in ("one two three four five, six", "Σίγμα one 中文 x-y", "don't stop", "six five four ½ Straße"):
            assert np.frombuffer(memo.ids(text), dtype=memo.dtype).tolist() == memo.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(memo.words) + len(memo.words.older) < 20


@pytest.mark.parametrize("change", ["other file", "normalizer", "pieces", "added"])
def test_tokenizers_of_another_form(tmp_path, change):
    """Whole texts are encoded where the file's rules are not those that words follow."""
    path = VOCABULARY
    if change == "other file":
        path = public_tokenizers.path("byte_bpe_50k.json")
    else:
        form = json.load(open(path, encoding="utf-8"))
        if change == "normalizer":
            form["normalizer"] = {"type": "NFC"}
        elif change == "pieces":
            form["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\w+"
        else:
            form["added_tokens"][0].update(content="one two", special=False)
        path = str(tmp_path / "changed.json")
        json.dump(form, open(path, "w", encoding="utf-8"))
    memo = WordMemo(path)
    assert not memo.known and MEMO.known
    for text in ("One two, THREE don't 42 x_y", " two  spaces\n", "É中"):
        assert np.frombuffer(memo.ids(text), dtype=memo.dtype).tolist() == memo.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_files(spark, small, tmp_path, monkeypatch):
    docs = docs_frame(spark)
    write_tokens(docs, str(tmp_path / "t"), VOCABULARY)
    memo = WordMemo(VOCABULARY)
    want = Counter((r[0], tuple(memo.tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in awkward_docs())
    rows = read_tokens(spark, str(tmp_path / "t")).collect()
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, dtype="<u4").tolist())) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += len(r.ids) // 4
    write_tokens(empty_frame(spark), str(tmp_path / "e"), VOCABULARY)
    assert read_tokens(spark, str(tmp_path / "e")).collect() == []
    got = {r.doc_id: r for r in QUERIES["op8_token_ids"](spark, small).collect()}
    at = 0
    for d in sorted(spark.read.parquet(f"{small}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = np.array(memo.tokenizer.encode(d.text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        r = got[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def brute_print(text):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    shingles = [b" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest identifier per print over links of at most two bits; prints: {print: [ids]}."""
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    ordered = sorted(prints)
    values = np.array(ordered, dtype=np.uint64)
    for i, p in enumerate(ordered):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 2):
            a, b = root(p), root(ordered[i + 1 + j])
            parent[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for p, ids in prints.items():
        least[root(p)] += [i for i in ids if i is not None]
    return {p: min(least[root(p)], default=None) for p in prints}


def test_near_duplicate_query(spark):
    sf = "/root/testdata/sf0.01"
    prints = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        prints[brute_print(r.text)].append(r.doc_id)
    want = brute_components(prints)
    expected = {i: (f"{p:016x}", want[p]) for p, ids in prints.items() for i in ids}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash_near_dedup"](spark, sf).collect()}
    assert got == expected


def test_links_of_crowded_fingerprints(spark):
    """Thousands of fingerprints close to one another: groups are dealt again, level by level."""
    rng = random.Random(3)
    prints = {0, 2**64 - 1}
    for _ in range(3):
        base = rng.getrandbits(64)
        for _ in range(700):
            p = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                p ^= 1 << b
            prints.add(p)
    base = rng.getrandbits(64)
    prints |= {base ^ (i << 20) for i in range(1500)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    classes = spark.createDataFrame([(p,) for p in signed], "fingerprint long").selectExpr("fingerprint", "fingerprint AS node")
    roots = {r.node: r.root for r in connected_components(near_links(classes, group_rows=64)).collect()}
    want = brute_components({p: [s] for p, s in zip(prints, signed)})
    assert {s: roots.get(s, s) for s in signed} == {s: want[p] for p, s in zip(prints, signed)}


def test_masks_and_pivots_miss_no_pair():
    rng = random.Random(4)
    masks = agreement_masks(2, 5)
    values = np.array([rng.getrandbits(64) for _ in range(300)], dtype=np.uint64)
    values = np.concatenate([values, values ^ np.uint64(1 << 63 | 1), values ^ np.uint64(1 << 13)])
    for a, b in rng.sample([(i, i + 300) for i in range(300)], 50):
        assert any(not int(values[a] ^ values[b]) & m for m in masks)
    pairs = {tuple(sorted((int(a), int(b)))) for a, b in zip(*linked(values, 2, reference_fingerprints(), block=64))}
    assert pairs == {(i, j) for i in range(900) for j in range(i + 1, 900) if int(values[i] ^ values[j]).bit_count() <= 2}


def test_near_duplicates_of_awkward_rows(spark):
    docs = docs_frame(spark)
    prints = defaultdict(list)
    for r in awkward_docs():
        prints[brute_print(r[1])].append(r[0])
    want = brute_components(prints)
    got = near_duplicates(docs).collect()
    assert len(got) == len(awkward_docs())
    assert Counter((r.doc_id, r.fingerprint % 2**64) for r in got) == Counter((i, p) for p, ids in prints.items() for i in ids)
    assert all(r.component_id == want[r.fingerprint % 2**64] for r in got)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    components = {(want[p], p if want[p] is None else None) for p in prints}
    assert kept.count() == len(components)
    assert {r.doc_id for r in kept.collect()} == {c for c, _ in components}
    assert near_duplicates(empty_frame(spark)).collect() == [] and drop_near_duplicates(empty_frame(spark)).collect() == []


def brute_topk(rows, k):
    good = [(i, np.array(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if q % 3 == 0:
            scored = sorted((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("chunk,block", [(4096, 1024), (16, 4)])
def test_topk_equals_brute_force(spark, monkeypatch, chunk, block):
    monkeypatch.setattr("lodgeworks.llm.knn_join.CHUNK_ROWS", chunk)
    monkeypatch.setattr("lodgeworks.llm.knn_join.BLOCK_QUERIES", block)
    rng = np.random.default_rng(2)
    centres = rng.integers(-200, 200, size=(5, 8))
    rows = [(i, (centres[i % 5] + rng.integers(-20, 20, size=8)).astype(float).tolist()) for i in range(240)]
    rows += [(240 + i, rows[7][1]) for i in range(40)]  # one very common vector, ties by key
    rows += [(300, None), (303, [1.0, None] * 4), (306, [float("nan")] * 8), (309, [float("inf")] * 8), (None, [1.0] * 8),
             (312, [1.0, 2.0]), (315, [3.0, -4.0]), (318, []), (321, [5.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in voronoi_topk(frame, frame.vec_id % 3 == 0, 5, n_pivots=6).collect())
    assert got == brute_topk(rows, 5)
    assert voronoi_topk(frame.limit(0), frame.vec_id % 3 == 0).collect() == []
