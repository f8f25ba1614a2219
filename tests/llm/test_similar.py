"""The pipeline's near-duplicate stage against brute-force Jaccard pairs."""

import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from lodgeworks.llm import similar
from lodgeworks.llm.simhash import fingerprint_of
from lodgeworks.llm.similar import drop_similar
from tests.llm.helpers import awkward_docs, docs_frame, empty_frame


def shingle_set(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_kept(rows):
    """The smallest key of each component of pairs with Jaccard 0.8 or more."""
    sets, root = {k: shingle_set(t) for k, t in rows}, {k: k for k, _ in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and (sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {find(k) for k in sets}


def copies(rng, base, n, changes):
    """Copies of ``base`` with up to ``changes`` words replaced."""
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(changes + 1)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        yield " ".join(words)


def near_rows():
    """Copies around the threshold, one group larger than a bucket compares pair by pair, short and empty texts."""
    rng, texts = random.Random(5), []
    for _ in range(30):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([12, 40, 120, 400]))]
        texts += copies(rng, base, 5, max(2, len(base) // 30))
    common = [f"c{i}" for i in range(150)]
    texts += copies(rng, common, 90, 3)
    texts += copies(rng, common[:130] + [f"d{i}" for i in range(20)], 50, 4)
    texts += ["one two", "One  TWO", "one", "", " \n", None, "É a b c d e", "é a b c d e"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_stage_equals_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_kept(rows)


def test_similar_awkward_rows(spark):
    kept = drop_similar(docs_frame(spark))
    assert kept.columns == docs_frame(spark).columns
    sets = {shingle_set(r[1]) for r in awkward_docs()}
    assert Counter(shingle_set(r.text) for r in kept.collect()) == Counter(sets)
    assert drop_similar(empty_frame(spark)).collect() == []


def stage_rows(spark, texts):
    return spark.createDataFrame([(k, t, "en", "s", 1) for k, t in texts], "doc_id long, text string, lang string, source string, n_chars long")


def test_stage_runs_op7(spark, monkeypatch):
    """The fingerprints of all rows are compared; a pair that no bucket offers is found by them."""
    rng, seen = random.Random(8), []
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)] * 12
    texts = [(k, " ".join(base + [tail])) for k, tail in ((3, "one"), (1, "two"))] + [(2, "far away from these"), (2, "and not near the other"), (None, None), (7, "")]
    assert (fingerprint_of(texts[0][1]) ^ fingerprint_of(texts[1][1])).bit_count() <= 2
    real, sketched = similar.near_duplicates, similar._sketched
    monkeypatch.setattr(similar, "near_duplicates", lambda docs, *a, **b: seen.append(docs.count()) or real(docs, *a, **b))
    monkeypatch.setattr(similar, "_sketched", lambda *a: sketched(*a).withColumn("keys", F.array().cast("array<long>")))
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, stage_rows(spark, texts), "").collect()]
    assert seen == [len(texts)]
    assert Counter(got) == Counter([texts[1], texts[2], texts[3], texts[5]])


def test_offered_pairs_are_decided(spark):
    texts = ["a b c d e f g h i j", "a b c d e f g h i j j j", "x y z"]
    classes = spark.createDataFrame([(n, len(shingle_set(t)), [], n) for n, t in enumerate(texts)], "node long, m long, keys array<long>, __lw_row long")
    rows = spark.createDataFrame(list(enumerate(texts)), "__lw_row long, text string")
    offered = spark.createDataFrame([(0, 1), (0, 2)], "a long, b long")
    found = similar.similar_links(classes, rows, 0.7, offered=offered)
    assert [tuple(r) for r in found.distinct().collect()] == [(0, 1)]
