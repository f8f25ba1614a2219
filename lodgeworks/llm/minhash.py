"""Document fingerprints by MinHash, and the near-duplicates that their bands offer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeworks.llm.order import PART, dealt_in_order
from lodgeworks.session import staged

#: Values in a signature, each of 16 bits.
PERMUTATIONS = 128
#: A pair of similarity 0.8 shares no band with a chance of (1 - 0.8**4)**32, about one in fourteen million.
BANDS = 32
#: Shingles that meet all permutations at once, which bounds the memory for a long text.
BLOCK = 1024
#: Words whose hashes a worker remembers; beyond it the memory starts anew.
MEMO_WORDS = 500_000

_RNG = np.random.default_rng(12)
_FACTORS, _TERMS = _RNG.integers(0, 2**64, size=(2, PERMUTATIONS, 1), dtype=np.uint64)
_FACTORS |= np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)  # a fixed odd number
MOST = np.iinfo(np.uint64).max


class WordHashes(dict):
    """The 64-bit hash of each word, computed once."""

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def shingle_hashes(text: str | None, words: int, memo: WordHashes) -> np.ndarray:
    """A 64-bit hash per shingle of ``words`` words of the lower-cased text; fewer words are one shingle, none have none."""
    tokens = text.lower().split() if text else []
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    hashed = np.fromiter(map(memo.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    width, n = min(words, len(hashed)), max(1, len(hashed) - words + 1)
    total = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        total = (total ^ hashed[i : i + n]) * _MIX
        total ^= total >> np.uint64(29)
    return total


def signature(shingles: np.ndarray) -> np.ndarray:
    """Per permutation (a factor and a term modulo 2**64) the least value over all shingles, folded to 16 bits."""
    least = np.full(PERMUTATIONS, MOST, dtype=np.uint64)
    for at in range(0, len(shingles), BLOCK):
        np.minimum(least, (_FACTORS * shingles[at : at + BLOCK] + _TERMS).min(axis=1), out=least)
    return ((least ^ least >> np.uint64(16) ^ least >> np.uint64(32) ^ least >> np.uint64(48)) & np.uint64(0xFFFF)).astype("<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal values: an estimate of the Jaccard similarity of the shingle sets."""
    return float((a == b).mean())


def edited_text(text: str, following: str) -> str:
    """``text`` with its last quarter (rounded down) replaced by as many code points from the front of ``following``, or all it has."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


# Digests and fingerprints travel and are staged as bytes, which take half the room of hexadecimal text.
_ROW = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = [field.split()[0] for field in _ROW.split(", ")]


def _compared(text: str, mine: np.ndarray, following: str, theirs: np.ndarray, words: int, memo: WordHashes) -> list:
    """The values of ``_ROW`` for one document and the one after it."""
    edited = edited_text(text, following)
    after = mine if edited == text else signature(shingle_hashes(edited, words, memo))
    return [len(text), hashlib.sha256(edited.encode()).digest(), mine.tobytes(), after.tobytes(),
            likeness(mine, after), likeness(mine, theirs)]


def edited_fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next`` of every row.

    The edited text takes its last quarter from the next document in ascending order of ``key`` (after the last:
    the first; a single row follows itself). Fingerprints are hexadecimal; likeness is the share of equal values.
    The rows are dealt by range of the key, and each task reads them in order with one row of foresight; only the
    first and the last text of a partition meet those of its neighbours afterwards. A null text is empty; texts
    without words have equal fingerprints; null keys come first; equal keys and repeated rows are rows of
    their own, in the order of a hash of the text; other columns do not matter; an empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{key}`").alias("__lw_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__lw_text"))
    ordered = dealt_in_order(rows.withColumn("__lw_hash", F.xxhash64("__lw_text")), ["__lw_key", "__lw_hash"])
    # The key crosses as text, since pandas would turn whole numbers beside a null into floats.
    ordered = ordered.select(F.col("__lw_key").cast("string").alias("__lw_key"), PART, "__lw_text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, held, first = WordHashes(), None, True
        for part in batches:
            out = []
            for k, p, body in zip(part["__lw_key"], part[PART], part["__lw_text"]):
                mine = signature(shingle_hashes(body, words, memo))
                if held is not None:
                    out.append([*held[:2], *_compared(held[2], held[3], body, mine, words, memo), first, False, held[2] if first else None])
                    first = False
                held = k, p, body, mine
            yield pd.DataFrame(out, columns=columns)
        if held is not None:
            yield pd.DataFrame([[*held[:2], *[None] * len(_NAMES), first, True, held[2]]], columns=columns)

    columns = ["__lw_key", PART, *_NAMES, "first", "last", "edge"]
    done = staged(ordered.mapInPandas(run, f"__lw_key string, {PART} int, {_ROW}, first boolean, last boolean, edge string"), "fingerprints")
    # One row per range partition from here on.
    order = sorted(r[0] for r in done.filter("first").select(PART).collect())
    told = [F.lower(F.hex(c)).alias(c) if f"{c} binary" in _ROW else F.col(c) for c in _NAMES]
    told = [F.col("__lw_key").cast(docs.schema[key].dataType).alias(key), *told]
    if not order:
        return done.select(*told)
    turns = docs.sparkSession.createDataFrame(list(zip(order, order[1:] + order[:1])), f"{PART} int, __lw_after int")
    fronts = done.filter("first").select(F.col(PART).alias("__lw_after"), F.col("edge").alias("following"))
    lasts = done.filter("last").select("__lw_key", PART, "edge").join(turns, PART).join(fronts, "__lw_after").select("__lw_key", "edge", "following")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHashes()
        for part in batches:
            yield pd.DataFrame(
                [[k, *_compared(a, signature(shingle_hashes(a, words, memo)), b, signature(shingle_hashes(b, words, memo)), words, memo)]
                 for k, a, b in zip(part["__lw_key"], part["edge"], part["following"])], columns=["__lw_key", *_NAMES])

    closed = lasts.mapInPandas(close, f"__lw_key string, {_ROW}")
    return done.filter("NOT last").select("__lw_key", *_NAMES).unionAll(closed).select(*told)

