"""Contiguous shards of nearly equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeworks.llm.order import BEFORE, PART, ROW, SIZE, TOTAL, with_prefix_sums


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus one, so that every document has a size."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def assign_shards(
    docs: DataFrame, n_shards: int = 16, keys: tuple[str, ...] = ("doc_id",), size: Column | None = None
) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (from 0 without gaps in the shard).

    Documents are laid end to end in the order of ``keys``; a document belongs to the shard in which
    its middle byte lies, so each cut misses its target by at most half of the document on it. One
    shuffle by range, one staged copy, and totals of one row per partition and per shard.

    Null keys come first; equal keys and repeated rows keep the order of the input, each with a slot
    of its own; a null or empty text counts one byte; an empty table gives an empty result; columns
    named ``shard`` or ``slot`` are replaced. A shard can be empty when there are fewer documents
    than shards, or when one document is larger than a shard.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    plain = docs.drop("shard", "slot")
    rows = with_prefix_sums(plain, list(keys), text_bytes() if size is None else size)
    wide = "decimal(38,0)"
    middle = (F.col(BEFORE) * 2 + F.col(SIZE)).cast(wide) * F.lit(n_shards)
    shard = F.floor(middle / (F.col(TOTAL).cast(wide) * 2)).cast("int")
    placed = rows.withColumn("shard", F.least(shard, F.lit(n_shards - 1)))
    first = placed.groupBy("shard").agg(F.min(ROW).alias("__lw_first"))  # at most n_shards rows
    out = placed.join(F.broadcast(first), "shard").withColumn("slot", F.col(ROW) - F.col("__lw_first"))
    return out.select(*[F.col(f"`{c}`") for c in plain.columns], "shard", "slot")
