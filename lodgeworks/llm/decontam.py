"""Benchmark decontamination: training windows against a broadcast hash set of benchmark n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a text that are searched as one row, before the windows are spread.
CHUNK_WORDS = 4096
#: Above so many bytes of n-grams the set is not broadcast but joined by shuffle.
BROADCAST_BYTES = 256 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Everything that is neither a digit, nor a letter a-z once lower-cased, nor beyond ASCII.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """The words of a text in order; none for null."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, BETWEEN_WORDS), lambda w: w != "")


def _grams(words: str, n: int, count: str) -> Column:
    """The first ``count`` windows of ``n`` words, joined by blanks, in order of their start."""
    return F.expr(
        f"CASE WHEN {count} > 0 THEN transform(sequence(0, {count} - 1), "
        f"i -> array_join(slice({words}, i + 1, {n}), ' ')) ELSE cast(array() AS array<string>) END")


def benchmark_windows(benchmark: DataFrame, n: int = 10, *, item: str = "item_id", text: str = "text") -> DataFrame:
    """``gram``, its number of words ``n`` and the ``items`` (as text) that hold it.

    An item of fewer than ``n`` words, but not none, is one window. Items without a name or without
    words have no windows.
    """
    worded = benchmark.select(F.col(item).cast("string").alias("item"), words_of(text).alias("w")).filter("size(w) > 0 AND item IS NOT NULL")
    grams = F.when(F.size("w") >= n, _grams("w", n, f"(size(w) - {n} + 1)")).otherwise(F.array(F.array_join("w", " ")))
    rows = worded.select("item", F.least(F.size("w"), F.lit(n)).alias("n"), F.explode(grams).alias("gram"))
    return rows.groupBy("gram").agg(F.first("n").alias("n"), F.collect_set("item").alias("items"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, *, key: str = "doc_id", text: str = "text", item: str = "item_id"
) -> DataFrame:
    """Per document: ``n_words``, ``hits`` (start and length in words of every window found), ``n_hit`` (words
    inside any of them), ``items`` (those found, sorted as text) and ``contaminated``; also ``text_hash``.

    A document is cut into overlapping rows of bounded size and those into windows; a broadcast hash
    join looks each up in the set of benchmark windows and compares the whole strings, so a match is
    verified as it is found. Each row of a document also sends one mark that carries its word
    count; marks and hits meet in one aggregate with partial results, which is the only shuffle and
    moves next to nothing for clean documents. The set is broadcast when its measured size is below
    ``BROADCAST_BYTES`` and otherwise left to a shuffled join.

    Documents are told apart by key and a hash of the text; repeated rows come back as often as they
    were given. Null and empty texts have no words and no hits; without benchmark items nothing is
    contaminated. Only ``key`` of the given columns is returned.
    """
    windows = benchmark_windows(benchmark, n, item=item)
    facts = windows.agg(
        F.coalesce(F.sum(F.octet_length("gram") + 64 + F.size("items") * 24), F.lit(0)), F.collect_set("n")).first()
    lengths = sorted(facts[1])
    mark = F.lit("")  # no window is the empty string
    known = windows.unionAll(windows.sparkSession.sql("SELECT '' AS gram, 0 AS n, cast(array() AS array<string>) AS items"))
    small = facts[0] <= BROADCAST_BYTES

    worded = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("text_hash"), words_of(text).alias("_w"))
    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("_w") - 1, F.lit(0)), F.lit(CHUNK_WORDS)),
        lambda at: F.struct(
            at.alias("at"), F.least(F.size("_w") - at, F.lit(CHUNK_WORDS)).alias("own"),
            F.slice("_w", at + 1, CHUNK_WORDS + max(lengths, default=1) - 1).alias("w")))
    # Windows that begin after a row's own words belong to the next row. Their numbers are settled
    # here, below the generator, which then carries nothing but small columns.
    words = F.col("_c.w")
    rows = worded.select("_key", "text_hash", F.explode(cut).alias("_c")).select(
        "_key", "text_hash", "_c.at", "_c.own", words.alias("_w"),
        *[F.greatest(F.least(F.col("_c.own"), F.size(words) - m + 1), F.lit(0)).alias(f"_n{m}") for m in lengths])
    # The mark comes first, then the windows of every length that begin in this row.
    grams = F.concat(F.array(mark), *[_grams("_w", m, f"_n{m}") for m in lengths])
    spread = rows.select("_key", "text_hash", "at", "own", *[f"_n{m}" for m in lengths[:-1]], F.posexplode(grams).alias("_p", "gram"))
    # Position of a window in its own list: what stands before it is the mark and the shorter lengths.
    start = F.col("_p") - 1
    offset = F.lit(0)
    begin = F.lit(None).cast("int")
    for m in lengths:
        begin = F.when(F.col("n") == m, start - offset).otherwise(begin)
        offset = offset + F.col(f"_n{m}") if m != lengths[-1] else offset
    found = spread.join(F.broadcast(known) if small else known, "gram").select(
        "_key", "text_hash", F.when(F.col("_p") == 0, F.col("own")).alias("own"), F.when(F.col("_p") == 0, F.col("at")).alias("first"),
        F.when(F.col("_p") > 0, F.struct((F.col("at") + begin).alias("start"), F.col("n"))).alias("hit"),
        F.when(F.col("_p") > 0, F.col("items")).alias("items"))
    summed = found.groupBy("_key", "text_hash").agg(
        F.sum(F.when(F.col("first") == 0, F.lit(1))).alias("_rows"),
        F.coalesce(F.sum("own"), F.lit(0)).cast("long").alias("_words"),
        F.array_sort(F.collect_set("hit")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1))))
    return summed.select(
        F.col("_key").alias(key), "text_hash",
        (F.col("_words") / F.col("_rows")).cast("long").alias("n_words"), "hits",
        F.size(covered).cast("long").alias("n_hit"), "items",
        (F.size("hits") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("_rows"))).alias("_copy"),
    ).drop("_copy")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, *, key: str = "doc_id", text: str = "text", spans: bool = False
) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window or, with ``spans``, without those words.

    With ``spans`` a document with hits comes back as its remaining words (lower-cased, one blank
    between them); all others are returned as they are. Adaptive execution decides how the
    documents with hits meet the table.
    """
    hit = contamination(docs, benchmark, n, key=key, text=text).filter("contaminated")
    hit = hit.select(F.col(key).alias("__lw_hit_key"), F.col("text_hash").alias("__lw_hit_hash"), F.col("hits").alias("__lw_hits")).dropDuplicates(["__lw_hit_key", "__lw_hit_hash"])
    same = F.col(f"`{key}`").eqNullSafe(F.col("__lw_hit_key")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("__lw_hit_hash"))
    if not spans:
        return docs.join(hit, same, "left_anti")
    joined = docs.join(hit, same, "left").withColumn("__lw_w", words_of(text))
    covered = F.array_distinct(F.flatten(F.transform("__lw_hits", lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1))))
    kept = F.expr("filter(transform(__lw_w, (w, i) -> CASE WHEN NOT array_contains(__lw_c, i) THEN w END), w -> w IS NOT NULL)")
    cleaned = joined.withColumn("__lw_c", covered).withColumn(
        text, F.when(F.col("__lw_hits").isNotNull(), F.array_join(kept, " ")).otherwise(F.col(text)))
    return cleaned.select(*[F.col(f"`{c}`") for c in docs.columns])
