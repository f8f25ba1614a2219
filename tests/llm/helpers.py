"""Fixtures shared by the tests: one small table of documents with every awkward case."""

from __future__ import annotations

import random

WORDS = ["alpha", "Beta", "gamma", "delta", "ÉPSILON", "zeta", "eta", "theta", "iota", "kappa", "42", "don't", "x_y"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, score string, _row string"


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + ("," if rng.random() < 0.1 else "") for _ in range(n))


def awkward_docs() -> list[tuple]:
    """Nulls in every column, empty and long texts, copies, repeated rows, clashing extra columns."""
    texts = [prose(30, 1), prose(30, 1), prose(30, 2), "", None, " \t\n", "one", "one two", prose(20_000, 3), prose(12, 4)]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, 7, "old", None, "x") for i, t in enumerate(texts)]
    rows += [(None, prose(15, 5), None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    rows += [rows[2], rows[2], rows[8]]  # repeated rows
    return rows


def docs_frame(spark, rows=None):
    return spark.createDataFrame(awkward_docs() if rows is None else rows, SCHEMA)


def empty_frame(spark):
    return spark.createDataFrame([], SCHEMA)
