"""Mixing and sharding against plain Python."""

import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from lodgeworks.llm.mixing import in_mixed_order, mix_sources, schedule
from lodgeworks.llm.shards import assign_shards
from lodgeworks.llm.catalog import QUERIES
from tests.llm.helpers import awkward_docs, docs_frame, empty_frame


def brute_shards(rows, n):
    sizes = [len((r[1] or "").encode()) + 1 for r in rows]
    total, before, out = sum(sizes), 0, []
    for size in sizes:
        out.append(min(n - 1, (2 * before + size) * n // (2 * total)))
        before += size
    return out


@pytest.mark.parametrize("n", [1, 3, 16])
def test_shards_equal_prefix_sums(spark, n):
    rows = sorted(awkward_docs(), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(assign_shards(docs_frame(spark), n).collect(), key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    # Rows of equal keys keep some order of their own; the two null keys differ in size.
    assert Counter(r.shard for r in got if r.doc_id is not None) == Counter(
        s for s, r in zip(brute_shards(rows, n), rows) if r[0] is not None)
    for shard in {r.shard for r in got}:
        assert [r.slot for r in got if r.shard == shard] == list(range(sum(r.shard == shard for r in got)))
    assert got[0].asDict().keys() >= {"text", "_row"}


def test_shards_of_nothing(spark):
    assert assign_shards(empty_frame(spark)).collect() == []


def test_shard_query(spark, small):
    docs = sorted(spark.read.parquet(f"{small}/documents.parquet").collect(), key=lambda r: r.doc_id)
    got = {r.doc_id: r for r in QUERIES["op4_shard_documents"](spark, small).collect()}
    want = brute_shards([(d.doc_id, d.text) for d in docs], 16)
    slots = Counter()
    for d, shard in zip(docs, want):
        r = got[d.doc_id]
        data = (d.text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) == (
            len(data) + 1, zlib.crc32(data), "bytes", shard, slots[shard], None)
        slots[shard] += 1


def brute_schedule(weights, blocks):
    """The ideal followed from end to end of a source, then slot by slot the released block with the earliest deadline."""
    left, now, times = [Fraction(b) for b in blocks], Fraction(0), [{0: Fraction(0)} for _ in blocks]
    while any(left):
        active = [s for s, b in enumerate(left) if b]
        total = sum(Fraction(weights[s]) for s in active)
        ends = {s: left[s] * total / Fraction(weights[s]) for s in active}
        span = min(ends.values())
        for s in active:
            rate, done = Fraction(weights[s]) / total, blocks[s] - left[s]
            for n in range(int(done), blocks[s] + 1):
                if done < n <= done + rate * span:
                    times[s][n] = now + (n - done) / rate
            left[s] -= rate * span
        now += span
    window = lambda s, j: (int(times[s][j]), -int(-times[s][j + 1] // 1))
    done, out = [0] * len(blocks), []
    for t in range(sum(blocks)):
        ready = [(window(s, j)[1], s) for s, j in enumerate(done) if j < blocks[s] and window(s, j)[0] <= t]
        due, s = min(ready)
        out.append((s, done[s], window(s, done[s])[0], due))
        done[s] += 1
    return out


@pytest.mark.parametrize("weights, blocks", [
    ([1], [5]), ([3, 5], [3, 5]), ([1, 1, 98], [4, 1, 70]), ([7, 13, 80], [70, 1, 30]), ([1, 1, 1], [40, 41, 39]), ([0.1, 0.7, 2.5], [11, 30, 25]),
    ([1] * 20 + [70], [3] * 20 + [90]), ([5, 3], [0, 4])])
def test_schedule_equals_brute_force(weights, blocks):
    assert list(schedule(weights, blocks)) == brute_schedule(weights, blocks)


def test_weights_must_be_positive():
    with pytest.raises(ValueError):
        list(schedule([0.0], [10]))


def check_mix(rows, weights, block_rows, columns):
    """Every block in its window, slots without gaps, less than one block from the share while all sources last."""
    slots = {(r[columns["source"]], r.block): (r.release, r.slot, r.deadline) for r in rows}
    assert sorted(s for _, s, _ in slots.values()) == list(range(len(slots)))
    assert all(a <= s < d for a, s, d in slots.values())
    sizes = Counter((r[columns["source"]], r.block) for r in rows)
    last = {}
    for source, block in sizes:
        last[source] = max(last.get(source, 0), block)
    assert all(n == block_rows or b == last[s] for (s, b), n in sizes.items())
    total, weight = len(slots), sum(map(Fraction, weights.values()))
    full = min((last[s] + 1) * weight / Fraction(w) for s, w in weights.items())
    at = {slot: s for (s, _), (_, slot, _) in slots.items()}
    done = Counter()
    for t in range(min(total, int(full))):
        done[at[t]] += 1
        for s, w in weights.items():
            assert abs(done[s] - Fraction(w) / weight * (t + 1)) < 1


def test_mix_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for weights, block_rows, frame in (({f"src{i}": 1 + i for i in range(20)}, 1, 210), ({f"src{i}": 1 for i in range(20)}, 3, 20)):
        rows = mix_sources(docs, weights, block_rows=block_rows, frame=frame, bucket_rows=40).collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
        check_mix(rows, weights, block_rows, {"source": "source"})
    again = QUERIES["op1_mix_sources"](spark, small).collect()
    assert len(again) == docs.count()
    counts = Counter(r.source for r in again)
    check_mix(again, {s: n**0.5 for s, n in counts.items()}, 16, {"source": "source"})


def test_mix_keeps_awkward_rows(spark):
    docs = docs_frame(spark)
    rows = mix_sources(docs, block_rows=2, frame=10).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in awkward_docs())
    places = [(r.slot, r.rank) for r in rows]
    assert len(set(places)) == len(places)
    by_block = defaultdict(set)
    for r in rows:
        by_block[r.slot].add(r.source)
    assert all(len(s) == 1 for s in by_block.values())
    assert mix_sources(empty_frame(spark)).collect() == []
    with pytest.raises(ValueError):
        mix_sources(docs, {"s1": 1.0})


@pytest.mark.parametrize("name", ["s", "j", "released", "due", "at", "first", "i", "p", "id", "n", "h", "bucket"])
def test_mix_beside_clashing_columns(spark, name):
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", f"id + 7 AS `{name}`")
    rows = mix_sources(docs, block_rows=2).collect()
    assert sorted((r.doc_id, r[name]) for r in rows) == [(i, i + 7) for i in range(40)]
    assert sorted({r.slot for r in rows}) == list(range(21))


def test_mix_of_whole_number_sources(spark):
    docs = spark.range(60).selectExpr("id AS doc_id", "IF(id < 3, NULL, id % 4) AS source")
    rows = mix_sources(docs, block_rows=2).collect()
    assert sorted(r.doc_id for r in rows) == list(range(60)) and {r.source for r in rows} == {None, 0, 1, 2, 3}


def test_mixed_files_follow_the_sequence(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    mixed = mix_sources(docs)
    in_mixed_order(mixed, docs.columns).write.parquet(str(tmp_path / "mixed"))
    back = spark.read.parquet(str(tmp_path / "mixed")).select("doc_id", "_metadata.file_name", "_metadata.row_index").collect()
    want = [r.doc_id for r in sorted(mixed.collect(), key=lambda r: (r.slot, r.rank))]
    assert [r.doc_id for r in sorted(back, key=lambda r: (r.file_name, r.row_index))] == want


@pytest.mark.parametrize("hot", [1, 7])
def test_schedule_follows_unrounded_weights(hot):
    """Weights that no frame of 1,000 holds, over many frames: windows are kept, less than one block off at every slot."""
    counts = [hot * 9_000] + [1_000] * 19
    weights = [n**0.5 for n in counts]
    total, blocks = sum(map(Fraction, weights)), [int(60_000 * w / sum(weights)) + 1 for w in weights]
    done = Counter()
    for t, (s, j, release, due) in enumerate(schedule(weights, blocks)):
        assert release <= t < due and j == done[s]
        done[s] += 1
        if t < 58_000 and t % 97 == 0:
            assert all(abs(done[x] - Fraction(w) / total * (t + 1)) < 1 for x, w in enumerate(weights))
    assert [done[s] for s in range(20)] == blocks


def test_schedule_after_ends_and_small_shares():
    """Beyond the end of a source the others keep their proportion; a share below 1/1000 is not raised."""
    rows = [s for s, *_ in schedule([1, 1, 2], [100, 3000, 6000])]
    assert all(abs(rows[1000:t].count(2) - Fraction(2, 3) * (t - 1000)) < 2 for t in range(1000, 9000, 50))
    rows = [s for s, *_ in schedule([0.0001, 1.0], [2, 30_000])]
    assert rows[:9_000].count(0) <= 1 and len(rows) == 30_002


def test_mix_of_more_sources_than_a_frame(spark):
    """2,500 sources, one of them with a third of the rows: every row has a place in its window."""
    docs = spark.range(7_500).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', concat('site', id % 2499)) AS source")
    rows = mix_sources(docs, block_rows=2).collect()
    assert sorted(r.doc_id for r in rows) == list(range(7_500))
    slots = {(r.source, r.block): (r.release, r.slot, r.deadline) for r in rows}
    assert sorted(s for _, s, _ in slots.values()) == list(range(len(slots))) and len({s for s, _ in slots}) > 1_000
    assert all(a <= s < d for a, s, d in slots.values())
