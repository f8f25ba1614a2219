"""Document quality from compressed sizes under dictionaries of good and of bad text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the weights that turn compressed sizes into a probability.

    ``weights`` has a constant, the weight of the normalised size difference
    ``(bad - good) / bytes`` and the weight of the ratio ``good / bytes``.
    """

    good: bytes
    bad: bytes
    weights: tuple[float, float, float]
    level: int = 3


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))


def _sizes(texts: list[bytes], good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> np.ndarray:
    """Per text: the normalised difference and the ratio; an empty text has a difference of 0 and a ratio of 1."""
    out = np.zeros((len(texts), 2))
    for i, text in enumerate(texts):
        if text:
            g, b = len(good.compress(text)), len(bad.compress(text))
            out[i] = (b - g) / len(text), g / len(text)
        else:
            out[i] = 0.0, 1.0
    return out


def _dictionary(texts: list[bytes], size: int, piece: int = 2048) -> bytes:
    """A zstandard dictionary of ``texts``; where there is too little to train on, the texts themselves."""
    pieces = [t[i : i + piece] for t in texts for i in range(0, len(t), piece)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[:size]


def _calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, on scaled columns, given back in plain ones."""
    if len(y) == 0:
        return 0.0, 0.0, 0.0
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(3)
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    slopes = w[1:] / spread
    return float(w[0] - slopes @ mean), float(slopes[0]), float(slopes[1])


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the identifier as text leaves 2 when divided by 4 (null: no)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, max_rows: int = 3000, max_text_bytes: int = 65_536,
    dictionary_bytes: int = 114_688, level: int = 3,
) -> QualityModel:
    """Fit on at most ``max_rows`` labelled documents of each class, chosen by a hash of their identifier.

    Only rows that are not held out are used, and of them only those with a text of at most
    ``max_text_bytes``; so the sample has a bound of 2 * max_rows * max_text_bytes. Half of the sample
    builds the dictionaries, the other half calibrates. Labels other than 0 and 1 and null
    identifiers or texts are passed over. Without labelled rows, every text scores 0.5.
    """
    order = F.xxhash64("doc_id", F.lit("sample"))
    chosen = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~held_out()).select("doc_id", "quality")
    # Twice the rows are drawn, as some documents may be absent or too long.
    drawn = chosen.filter("quality = 0").orderBy(order, "doc_id").limit(2 * max_rows).unionAll(
        chosen.filter("quality = 1").orderBy(order, "doc_id").limit(2 * max_rows))
    rows = (
        docs.select("doc_id", "text").filter(F.octet_length("text") <= max_text_bytes)
        .join(F.broadcast(drawn), "doc_id")  # at most 4 * max_rows rows
        .withColumn("_order", order)
    )
    sample = [
        r for q in (0, 1)
        for r in rows.filter(F.col("quality") == q).orderBy("_order", "doc_id", F.xxhash64("text")).limit(max_rows).collect()
    ]
    texts = {(q, h): [r.text.encode() for i, r in enumerate(x for x in sample if x.quality == q) if i % 2 == h]
             for q in (0, 1) for h in (0, 1)}
    good, bad = (_dictionary(texts[q, 0], dictionary_bytes) for q in (1, 0))
    x = _sizes(texts[0, 1] + texts[1, 1], _compressor(good, level), _compressor(bad, level))
    y = np.repeat([0.0, 1.0], [len(texts[0, 1]), len(texts[1, 1])])
    return QualityModel(good, bad, _calibrate(x, y), level)


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 where the score reaches ``threshold``).

    Every whole text is compressed under both dictionaries; nothing is shuffled. A null text counts
    as an empty one; an empty text scores by the constant and the ratio 1; repeated rows score
    alike; columns named ``score`` or ``predicted`` are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        good, bad = _compressor(m.good, m.level), _compressor(m.bad, m.level)
        constant, *slopes = m.weights
        for texts in parts:
            x = _sizes([t.encode() if t else b"" for t in texts], good, bad)
            yield pd.Series(1 / (1 + np.exp(-np.clip(constant + x @ np.array(slopes), -30, 30))))

    plain = docs.drop("score", "predicted")
    return plain.withColumn("score", score("text")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
