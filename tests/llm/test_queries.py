"""Registered queries against their SQL, and the pipeline against a brute-force version."""

import re
from collections import Counter

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from lodgeworks.llm.catalog import ORACLES, QUERIES
from lodgeworks.llm.quality import fit_quality, score_quality
from tests.llm.helpers import docs_frame, empty_frame
from tests.llm.test_filters import brute_contamination
from tests.llm.test_similar import brute_kept
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    assert compare(spark, connect(small), QUERIES[name], ORACLES[name], small) is None


def test_all_are_registered():
    names = entry_module.queries()
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names


def brute_pipeline(spark, sf):
    """The documents that stay, stage by stage."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {r.doc_id: r.text for r in score_quality(docs, model).filter("predicted = 1").collect()}
    chosen = brute_kept(kept.items())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    return {i for i in chosen if brute_contamination(kept[i], items)[1] == 0}


def test_pipeline(spark, small):
    rows = corpus_pipeline.run(spark, small).collect()
    assert {r.doc_id for r in rows} == brute_pipeline(spark, small) and len({r.doc_id for r in rows}) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += len((r.text or "").encode()) + 1
    largest = max(len((r.text or "").encode()) + 1 for r in rows)
    assert all(abs(s - sum(sizes.values()) / 16) <= largest for s in sizes.values())
    for shard in sizes:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    # The order is that of the mix: a block of up to 16 documents of one source stands together.
    ordered = [r.source for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    changes = sum(a != b for a, b in zip(ordered, ordered[1:]))
    assert changes < sum(-(-n // 16) for n in Counter(ordered).values())


def test_stages_on_awkward_rows(spark, small):
    for docs in (docs_frame(spark), empty_frame(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, small)
            rows = out.collect()
            if name != "sharding":
                assert out.columns == corpus_pipeline.COLUMNS
            assert len(rows) <= docs.count()
