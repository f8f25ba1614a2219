"""SimHash near-duplicates: pivot distance tables discard pairs, exact distances verify the rest."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lodgeworks.llm.components import connected_components
from lodgeworks.session import staged

BITS = 64


def fingerprint_of(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The fingerprint of one text: bit ``b`` is set where over half of the shingles' hashes have it set."""
    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(tokens) - words + 1)
    last = ends[words - 1 :] if len(tokens) >= words else ends[-1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    # Blocks of shingles keep the unpacked bits of a very long text small.
    for at in range(0, n, 65_536):
        pairs = zip(starts[at : at + 65_536].tolist(), last[at : at + 65_536].tolist())
        hashes = np.array([digest(joined[a:z], seed) for a, z in pairs], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The fingerprint as a signed 64-bit number."""
    for part in texts:
        yield pd.Series(np.array([fingerprint_of(t) for t in part], dtype=np.uint64).view(np.int64))


def as_hex(fingerprint: str = "fingerprint"):
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def reference_fingerprints(n: int = 32, seed: int = 7) -> np.ndarray:
    """The pivots: fixed pseudo-random fingerprints."""
    return np.random.default_rng(seed).integers(0, 2**64, size=n, dtype=np.uint64)


def distance_table(fingerprints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distance of every fingerprint to every pivot."""
    return np.bitwise_count(fingerprints[:, None] ^ pivots[None, :]).astype(np.int8)


def linked(fingerprints: np.ndarray, distance: int, pivots: np.ndarray, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs within ``distance``.

    Rows are sorted by their first coordinate, so a row meets only those whose first coordinate is at
    most ``distance`` larger. By the triangle inequality no coordinate of a linked pair differs by more;
    pairs whose maximum coordinate difference is larger are discarded, survivors are verified.
    """
    table = distance_table(fingerprints, pivots)
    order = np.argsort(table[:, 0], kind="stable")
    table, prints = table[order], fingerprints[order]
    left, right = [], []
    for at in range(0, len(prints), block):
        stop = min(len(prints), at + block)
        reach = np.searchsorted(table[:, 0], table[stop - 1, 0] + distance, side="right")
        for other in range(at, reach, block):
            end = min(reach, other + block)
            near = np.ones((stop - at, end - other), dtype=bool)
            for column in range(table.shape[1]):
                near &= np.abs(table[at:stop, None, column] - table[None, other:end, column]) <= distance
                if not near.any():
                    break
            i, j = np.nonzero(near)
            i, j = i + at, j + other
            kept = (i < j) & (np.bitwise_count(prints[i] ^ prints[j]) <= distance)
            left.append(order[i[kept]])
            right.append(order[j[kept]])
    return np.concatenate(left), np.concatenate(right)


def spanning(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A forest with the components of the links: at most n - 1 of them."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept.append((a, b))
    return kept


def agreement_masks(distance: int, parts: int, within: int = (1 << BITS) - 1) -> list[int]:
    """Bit masks of which any two fingerprints within ``distance`` agree on at least one.

    The bits of ``within`` are cut into ``parts``; ``distance`` differing bits leave ``parts - distance`` of
    them untouched, and every choice of that many parts is a mask.
    """
    bits = [b for b in range(BITS) if within >> b & 1]
    pieces = [sum(1 << b for b in bits[i::parts]) for i in range(parts)]
    return [sum(c) for c in combinations(pieces, parts - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> 63 else mask


def near_links(classes: DataFrame, distance: int = 2, group_rows: int = 256, n_pivots: int = 32) -> DataFrame:
    """Links (``a``, ``b``) between fingerprints such that their components are those of all pairs within ``distance``.

    ``classes`` has one ``fingerprint`` and one ``node`` per row. Which fingerprints meet: those that agree
    on three of five parts of their bits, for every choice of three (two differing bits touch at most
    two parts); no pair is missed. Such a group is verified in one task with the pivot tables and
    gives a spanning forest instead of its pairs. A group of more than ``group_rows`` is not verified
    but dealt again on masks that also fix a third of its free bits, and so on; a group that fixes all
    but twelve bits has at most 4096 members, so this ends.
    """
    pivots = reference_fingerprints(n_pivots)
    # Level by level: masks, and the bits still free under each.
    full = (1 << BITS) - 1
    level, current, found = agreement_masks(distance, distance + 3), None, []
    members = classes.select("fingerprint", "node")
    parents: list[int] | None = None
    while True:
        rows = members.select(
            "fingerprint", "node",
            F.explode(F.array(*[
                F.struct(F.lit(i).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("bits"))
                for i, m in enumerate(level)
            ])).alias("_k"),
        ) if parents is None else members.select(
            "fingerprint", "node",
            F.explode(F.filter(F.array(*[
                F.when(F.col("mask") == p, F.struct(
                    F.lit(i).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("bits")))
                for i, (m, p) in enumerate(zip(level, parents))
            ]), lambda k: k.isNotNull())).alias("_k"),
        )
        keyed = staged(rows.select("fingerprint", "node", "_k.mask", "_k.bits"), "simhash-keys")
        sizes = staged(keyed.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-groups")
        last = max(BITS - m.bit_count() for m in level) <= 12
        small = keyed.join(sizes if last else sizes.filter(F.col("n") <= group_rows), ["mask", "bits"]).drop("n")
        found.append(_verified(small, distance, pivots))
        if last or sizes.filter(F.col("n") > group_rows).isEmpty():
            break
        members = keyed.join(sizes.filter(F.col("n") > group_rows), ["mask", "bits"]).select("fingerprint", "node", "mask")
        finer = [(m | extra, i) for i, m in enumerate(level) for extra in agreement_masks(distance, distance + 1, full & ~m)]
        level, parents = [m for m, _ in finer], [p for _, p in finer]
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out.distinct()


def _verified(keyed: DataFrame, distance: int, pivots: np.ndarray) -> DataFrame:
    """A forest of verified links for every group of ``keyed``, read group by group from sorted partitions."""

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def forest(group: pd.DataFrame) -> list[tuple[int, int]]:
            nodes = group["node"].to_numpy()
            pairs = linked(group["fingerprint"].to_numpy().view(np.uint64), distance, pivots)
            return [(int(nodes[a]), int(nodes[b])) for a, b in spanning(len(nodes), *pairs)]

        rest = None
        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            key = frame[["mask", "bits"]].to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            starts = np.concatenate([[0], cuts])
            out = []
            for start, stop in zip(starts[:-1], starts[1:]):
                out += forest(frame.iloc[start:stop])
            rest = frame.iloc[starts[-1] :] if len(frame) else None
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        if rest is not None and len(rest):
            yield pd.DataFrame(forest(rest), columns=["a", "b"], dtype="int64")

    grouped = keyed.repartition("mask", "bits").sortWithinPartitions("mask", "bits")
    return grouped.mapInPandas(links, "a long, b long")


def near_duplicates(
    docs: DataFrame, distance: int = 2, *, key: str = "doc_id", text: str = "text", root: str | None = None,
) -> DataFrame:
    """``docs`` (without the text) with ``fingerprint`` and ``component_id``, the smallest key reachable over links.

    Copies collapse to one class per fingerprint before anything is compared. A null or empty text
    has fingerprint zero and is linked like any other; a null key takes no part in the minimum (a
    component of only null keys has a null id); repeated rows stay, with the same id; columns named
    ``fingerprint`` or ``component_id`` are replaced. ``root`` names a column for one fingerprint of the component, which
    tells components apart where keys are null or stand in several of them.
    """
    plain = docs.drop("fingerprint", "component_id")
    kept = [F.col(f"`{c}`") for c in plain.columns if c != text]
    prints = staged(plain.select(*kept, simhash(text).alias("fingerprint")), "fingerprints")
    classes = staged(prints.groupBy("fingerprint").agg(F.min(key).alias("_least")), "classes")
    # The fingerprint itself is the node: it exists for every class, also where all keys are null.
    links = staged(near_links(classes.withColumn("node", F.col("fingerprint")), distance), "links")
    roots = connected_components(links)
    named = classes.join(roots, classes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("_root"))
    least = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    roots_too = [F.col("_root").alias(root)] if root else []
    labels = staged(named.join(least, "_root").select(F.col("fingerprint").alias("__lw_print"), "component_id", *roots_too), "labels")
    return prints.join(labels, F.col("fingerprint") == F.col("__lw_print")).drop("__lw_print")


def drop_near_duplicates(docs: DataFrame, distance: int = 2, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component of ``near_duplicates``: that with the smallest key.

    Rows are told apart by the key and a hash of the row; of rows equal in both, one stays. A
    component of null keys keeps one of its documents.
    """
    columns = docs.columns
    hashable = [f"`{c}`" for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    marked = docs.withColumn("__lw_row", F.xxhash64(*hashable))
    ids = near_duplicates(marked.select(key, text, "__lw_row"), distance, key=key, text=text)
    # A component without keys is told by a fingerprint of its own; all others by their id.
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fingerprint"))]
    chosen = staged(
        ids.groupBy(*[g.alias(f"_g{i}") for i, g in enumerate(group)])
        .agg(F.min(F.struct(F.col(key).isNull().alias("no"), F.col(key).alias("id"), F.col("__lw_row").alias("row"))).alias("__lw_first"))
        .select(F.col("__lw_first.id").alias("__lw_keep_id"), F.col("__lw_first.row").alias("__lw_keep_row")),
        "chosen",
    )
    out = marked.join(chosen, (F.col("__lw_row") == F.col("__lw_keep_row")) & F.col(key).eqNullSafe(F.col("__lw_keep_id")))
    return out.dropDuplicates(["__lw_row", key]).select(*[F.col(f"`{c}`") for c in columns])
