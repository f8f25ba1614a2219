"""Repair of the structure of conversations: cheapest edits by a checkpointed dynamic program."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeworks.session import staged

# A row is one byte: its role's initial (s, u, a or other) and its first fault.
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER, BLANK, DUPLICATE, TRUNCATED = 3, 4, 8, 16
#: White space: blank, tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"

# States: nothing yet, after the system's turn, after the user's, after the assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a turn of the next speaker leads, and who that is.
NEXT = (USER, USER, ASSISTANT, USER)
SPEAKER = ("user", "user", "assistant", "user")
#: Where a kept turn leads, by state and initial; -1: it may not stand here.
KEEPS = ((SYSTEM, USER, -1, -1), (-1, USER, -1, -1), (-1, -1, ASSISTANT, -1), (-1, USER, -1, -1))
DELETE, INSERT, REROLE, UNFINISHED = 2, 5, 1, 5
FAR = 1 << 40
#: What remains to be paid behind the last row: missing turns are inserted.
AT_END = (0, 2 * INSERT, INSERT, 0)


@lru_cache(1 << 18)
def _before(symbol: int, after: tuple) -> tuple:
    after_row = []
    cost = UNFINISHED if symbol & TRUNCATED else 0
    for state in range(4):
        best = DELETE + after[state]
        if not symbol & (BLANK | DUPLICATE):
            kept = KEEPS[state][symbol & 3]
            if kept >= 0:
                best = min(best, cost + after[kept])
            best = min(best, cost + REROLE + after[NEXT[state]])
        after_row.append(best)
    one = [min(after_row[s], INSERT + after_row[NEXT[s]]) for s in range(4)]
    return tuple(min(one[s], 2 * INSERT + after_row[NEXT[NEXT[s]]]) for s in range(4))


def before(symbol: int, after: tuple) -> tuple:
    """The cheapest cost from each state before a row, given those behind it; turns may be inserted before the row.

    Only differences matter, so few vectors are ever computed.
    """
    low = min(after)
    return tuple([low + c for c in _before(symbol, tuple([min(c - low, FAR) for c in after]))])


def walk(symbols: bytes, entry: int, end: tuple, last: bool) -> tuple[str, list[int], int, int]:
    """The edits' initials, the state before each edit, the cost and the state behind it, for the ASCII-least of the cheapest edits.

    Cost vectors are kept at every ``isqrt(n)``-th row only; those between are computed again, block by block, on
    the way forward. An edit is taken if it is tight: its cost and what remains behind it are what remains here.
    """
    n, step = len(symbols), max(1, isqrt(len(symbols)))
    marks, vector = {n: end}, end
    for i in range(n - 1, -1, -1):
        vector = before(symbols[i], vector)
        if i % step == 0:
            marks[i] = vector
    edits, states, cost, state = [], [], 0, entry
    for start in range(0, n, step):
        stop = min(start + step, n)
        block = [marks[stop]]
        for i in range(stop - 1, start, -1):
            block.append(before(symbols[i], block[-1]))
        block.append(marks[start])
        for i in range(start, stop):
            symbol, here, behind = symbols[i], block.pop(), block[-1]
            unfinished = UNFINISHED if symbol & TRUNCATED else 0
            while True:
                states.append(state)
                if here[state] == DELETE + behind[state]:
                    edits.append("D")
                    cost += DELETE
                    break
                if here[state] == INSERT + here[NEXT[state]]:
                    edits.append("I")
                    cost += INSERT
                    state = NEXT[state]
                    continue
                kept = KEEPS[state][symbol & 3]
                if kept >= 0 and here[state] == unfinished + behind[kept]:
                    edits.append("K")
                    cost, state = cost + unfinished, kept
                else:
                    edits.append("R")
                    cost, state = cost + unfinished + REROLE, NEXT[state]
                break
    while last and state not in (START, ASSISTANT):
        edits.append("I")
        states.append(state)
        cost, state = cost + INSERT, NEXT[state]
    return "".join(edits), states, cost, state


def transfer(symbols: bytes) -> list[int]:
    """The cheapest cost from each state before the rows to each state behind them, row by row of a 4 x 4 matrix."""
    columns = []
    for to in range(4):
        vector = tuple(0 if s == to else FAR for s in range(4))
        for symbol in reversed(symbols):
            vector = before(symbol, vector)
        columns.append(vector)
    return [min(columns[to][state], FAR) for state in range(4) for to in range(4)]


def repaired(audit: str, states: list[int], roles, texts) -> list[tuple[str, str]]:
    """The turns that the edits leave."""
    out, at = [], 0
    for edit, state in zip(audit, states):
        if edit == "I":
            out.append((SPEAKER[state], ""))
            continue
        if edit != "D":
            out.append((roles[at] if edit == "K" else SPEAKER[state], texts[at]))
        at += 1
    return out


def _same(names: list[str], left: str, right: str) -> Column:
    tests = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in names]
    return tests[0] if len(tests) == 1 else _and(tests)


def _and(tests: list[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def marked_rows(rows: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` with the row's number ``id``, two hashes of role and text, and the row's ``symbol``.

    A row is a duplicate if its role and text stand earlier in the conversation; only texts that stand there
    twice are joined back, and the first of them is found by an aggregate, so a text may repeat any number of times.
    """
    spaces = F.lit(SPACES)
    body = F.rtrim("text", spaces)
    fault = F.when(body == "", BLANK).when(~F.substring(body, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    initial = F.coalesce(*[F.when(F.substring("role", 1, 1) == c, n) for c, n in INITIALS.items()], F.lit(OTHER))
    plain = staged(rows.select(
        "*", F.xxhash64("role", "text").alias("h"), F.xxhash64(F.lit(7), "text", "role").alias("g"), fault.alias("fault"), initial.alias("initial"),
        F.monotonically_increasing_id().alias("id")), "turns")
    place = F.struct(F.col("turn").isNotNull(), "turn", "id")
    firsts = plain.groupBy("conv", "h", "g").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = plain.alias("l").join(firsts.alias("r"), _same(["conv", "h", "g"], "l", "r"), "left")
    earlier = F.coalesce(F.col("r.first") < F.struct(F.col("l.turn").isNotNull(), F.col("l.turn"), F.col("l.id")), F.lit(False))
    first_fault = F.when(F.col("fault") == BLANK, BLANK).when(earlier, DUPLICATE).otherwise(F.col("fault"))
    return again.select("l.conv", "l.turn", "l.role", "l.text", "l.h", "l.id", (F.col("initial") + first_fault).cast("byte").alias("symbol"))


def segments(marked: DataFrame) -> DataFrame:
    """Each conversation in order, in pieces of at most one Arrow batch: ``conv``, ``part``, ``at``, ``symbols``, ``roles``, ``texts``.

    The rows are dealt by range of conversation and turn, so a conversation of any length spans as many tasks
    as it needs; ``part`` and ``at`` order its pieces.
    """
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("h").asc(), F.col("id").asc()]
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column("conv"))
            ends = runs.run_ends.to_numpy().astype(np.int32)
            offsets = np.concatenate([np.zeros(1, dtype=np.int32), ends])
            lists = pa.array(offsets)
            symbols = batch.column("symbol").to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()
            packed = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(symbols)])
            yield pa.RecordBatch.from_arrays(
                [runs.values, batch.column("part").take(pa.array(ends - 1)), pa.array(np.arange(done, done + len(ends), dtype=np.int64)), packed,
                 pa.ListArray.from_arrays(lists, batch.column("role")), pa.ListArray.from_arrays(lists, batch.column("text"))],
                names=["conv", "part", "at", "symbols", "roles", "texts"])
            done += len(ends)

    kind = dealt.select("conv")._jdf.schema().toDDL()
    return staged(dealt.select("conv", F.spark_partition_id().alias("part"), "symbol", "role", "text").mapInArrow(
        cut, f"{kind}, part int, at long, symbols binary, roles array<string>, texts array<string>"), "segments")


def planned(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pieces`` of conversations in one piece, and those of the others, with ``entry``, ``end``, ``first``, ``last`` and ``seam``.

    A conversation in several pieces is solved piece by piece: the pieces' cost matrices, multiplied from the
    back, give the cost vector behind each (a checkpoint); with it each piece maps the state before it to the
    state behind it, and the chain of these maps gives the state in which it is entered. Only a matrix and
    a map per piece, never rows, meet in one task. ``seam`` is 1 if the turns on both sides of the front are not a legal pair.
    """
    counts = pieces.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("conv")
    alone = pieces.alias("l").join(counts.alias("r"), _same(["conv"], "l", "r"), "left_anti").select(
        "l.*", F.lit(START).alias("entry"), F.array(*map(F.lit, AT_END)).cast("array<long>").alias("end"),
        F.lit(True).alias("first"), F.lit(True).alias("last"), F.lit(0).alias("seam"))
    several = staged(pieces.alias("l").join(counts.alias("r"), _same(["conv"], "l", "r"), "left_semi").select("l.*"), "several")

    @F.pandas_udf("array<long>")
    def matrices(symbols: pd.Series) -> pd.Series:
        return symbols.map(transfer)

    @F.pandas_udf("array<int>")
    def exits(symbols: pd.Series, ends: pd.Series, lasts: pd.Series) -> pd.Series:
        return pd.Series([[walk(s, e, tuple(int(c) for c in v), bool(z))[3] for e in range(4)] for s, v, z in zip(symbols, ends, lasts)], dtype=object)

    def backward(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "at"])
        vector, ends, seams = np.array(AT_END, dtype=np.int64), [], []
        for matrix in reversed(group["matrix"].tolist()):
            ends.append(vector.tolist())
            vector = np.minimum((np.asarray(matrix, dtype=np.int64).reshape(4, 4) + vector).min(axis=1), FAR)
        tails = group["tail"].tolist()
        for before_, front in zip([None, *tails], group["front"]):
            seams.append(0 if before_ is None else int(not legal(before_, front)))
        n = len(group)
        return pd.DataFrame({"part": group["part"], "at": group["at"], "end": ends[::-1], "first": [i == 0 for i in range(n)],
                             "last": [i == n - 1 for i in range(n)], "seam": seams})

    def forward(group: pd.DataFrame) -> pd.DataFrame:
        group, state, entries = group.sort_values(["part", "at"]), START, []
        for leads in group["exits"]:
            entries.append(state)
            state = int(leads[state])
        return pd.DataFrame({"part": group["part"], "at": group["at"], "entry": entries})

    code = lambda at: F.conv(F.hex(F.substring("symbols", at, 1)), 16, 10).cast("int").bitwiseAND(F.lit(3))
    known = several.select("conv", "part", "at", matrices("symbols").alias("matrix"), code(1).alias("front"), code(-1).alias("tail"))
    behind = staged(known.groupBy("conv").applyInPandas(
        backward, "part int, at long, end array<long>, first boolean, last boolean, seam int"), "checkpoints")
    joined = staged(several.join(behind, ["part", "at"]), "several-planned")
    steps = joined.select("conv", "part", "at", exits("symbols", "end", "last").alias("exits"))
    entries = steps.groupBy("conv").applyInPandas(forward, "part int, at long, entry int")
    several = joined.join(entries, ["part", "at"]).select(*alone.columns)
    return alone, several


def legal(a: int, b: int) -> bool:
    return (a & 3, b & 3) in ((0, 1), (1, 2), (2, 1))


def _solved(part: pd.DataFrame) -> Iterator[tuple]:
    for row in part.itertuples(index=False):
        yield row, *walk(row.symbols, int(row.entry), tuple(int(c) for c in row.end), bool(row.last))


def _in_order(several: DataFrame) -> DataFrame:
    return several.repartition("conv").sortWithinPartitions("conv", "part", "at")


class Plan:
    """The repair of a table of conversations: ``report()`` per conversation, ``turns()`` that are left.

    ``rows`` has a conversation id, a turn, a role and a text, in columns named by ``conv``, ``turn``, ``role`` and
    ``text``; other columns do not matter. A null role or text is one space; a null turn comes first;
    a null id is a conversation of its own. Rows of one turn are ordered by role and a hash of the text; repeated
    rows are duplicates of their first. Empty tables give empty results. Memory is bounded by one Arrow batch.

    The first fault of a row counts: blank (no character beside white space), duplicate (role and text stand earlier),
    truncated (the last character that is no white space is not ``.``, ``!`` or ``?``). A row may be kept (cost 0),
    given the role user or assistant (1) or deleted (2, required for blank and duplicate rows); an empty turn of
    user or assistant may be inserted anywhere (5); a truncated row that stays costs 5 more. The turns left
    follow the pattern ``(s?(ua)+)?`` of role initials. Of the cheapest edits, those with the ASCII-least initials are taken.
    """

    def __init__(self, rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        self.name = conv
        self.marked = marked_rows(rows.select(
            F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text")))
        self.alone, self.several = planned(segments(self.marked))

    def report(self) -> DataFrame:
        """Per conversation ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``.

        ``gaps`` counts the whole numbers between the least and the largest turn that no row has; ``illegal`` counts
        neighbours whose initials are not su, ua or au, before the repair.
        """

        def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            digest = empty = counts = audits = None
            for part in batches:
                out = []
                for row, audit, states, cost, _ in _solved(part):
                    if row.first:
                        digest, empty, counts, audits = hashlib.sha256(), True, [0] * 5, []
                    codes = np.frombuffer(row.symbols, dtype=np.uint8)
                    pairs = (codes[:-1] & 3) * 4 + (codes[1:] & 3)
                    illegal = row.seam + len(pairs) - int(np.isin(pairs, (1, 6, 9)).sum())
                    found = [int((codes & bit > 0).sum()) for bit in (BLANK, DUPLICATE, TRUNCATED)]
                    counts = [a + b for a, b in zip(counts, [*found, illegal, cost])]
                    audits.append(audit)
                    for speaker, said in repaired(audit, states, row.roles, row.texts):
                        digest.update(f"{'' if empty else chr(10)}{speaker}:{said}".encode())
                        empty = False
                    if row.last:
                        out.append([row.conv, *counts, "".join(audits), digest.hexdigest()])
                yield pd.DataFrame(out, columns=["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])

        fields = "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
        parts = self._texted(self.alone).mapInPandas(told, fields).unionAll(
            self._texted(_in_order(self.several)).mapInPandas(told, fields))
        parts = parts.withColumn("conv", F.col("conv").cast(self.marked.schema["conv"].dataType))
        known = self.marked.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
        return parts.alias("l").join(known.alias("r"), _same(["conv"], "l", "r")).select(
            F.col("l.conv").alias(self.name), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")

    def turns(self) -> DataFrame:
        """The turns left: the conversation's id, ``part``, ``at`` and ``i`` (their order), ``role``, ``text`` and the ``edit`` (K, R or I)."""

        def left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in batches:
                out = []
                for row, audit, states, _, _ in _solved(part):
                    stays = [e for e in audit if e != "D"]
                    out += [(row.conv, row.part, row.at, i, e, *t) for i, (e, t) in enumerate(zip(stays, repaired(audit, states, row.roles, row.texts)))]
                yield pd.DataFrame(out, columns=["conv", "part", "at", "i", "edit", "role", "text"])

        both = self._texted(self.alone.unionAll(self.several))
        rows = both.mapInPandas(left, "conv string, part int, at long, i int, edit string, role string, text string")
        return rows.withColumn("conv", F.col("conv").cast(self.marked.schema["conv"].dataType)).withColumnRenamed("conv", self.name)

    @staticmethod
    def _texted(pieces: DataFrame) -> DataFrame:
        """The id as text, since pandas would turn whole numbers beside a null into floats."""
        return pieces.withColumn("conv", F.col("conv").cast("string"))


def repair(rows: DataFrame, **names: str) -> Plan:
    """The repair of ``rows``; see ``Plan``."""
    return Plan(rows, **names)
