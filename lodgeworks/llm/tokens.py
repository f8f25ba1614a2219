"""Token ids ranked by frequency, in byte-aligned variable-length coding with separate control bytes."""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodgeworks.llm.order import BEFORE, PART, ROW, SIZE, dealt_in_order, with_offsets
from lodgeworks.session import fresh_path

#: A document's ids are stored in parts of at most so many.
PART_IDS = 1 << 20
#: Ids that are counted, packed or unpacked at once; a longer document or part on its own.
BLOCK_IDS = 1 << 17
#: Plain words, their pieces, and words beyond the plain range, in either generation of a worker's memory.
MEMO_WORDS, MEMO_PIECES, MEMO_ODD = 400_000, 400_000, 25_000

# Lengths in bytes of the four values of each control byte, from its four pairs of bits.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes: each value takes 1 to 4 little-endian bytes, two bits say how many."""
    values = ranks.astype("<u4")
    size = 1 + (values >= 1 << 8) + (values >= 1 << 16) + (values >= 1 << 24)
    codes = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    codes[: len(values)] = size - 1
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4)[None, :] < size[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The values back: control bytes index the table of lengths, one gather fetches all bytes."""
    size = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n].astype(np.int64)
    start = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", dtype=np.uint8)
    out = np.zeros(n, dtype=np.uint32)
    for k in range(4):
        part = raw[start + k].astype(np.uint32) << np.uint32(8 * k) if n else out
        out |= np.where(size > k, part, np.uint32(0))
    return out


def encode_parts(values: np.ndarray, lengths: np.ndarray) -> list[tuple[bytes, bytes]]:
    """``encode_ranks`` of the neighbouring parts of ``values`` that have these lengths, all at once."""
    most = int(values.max(initial=0))
    longer = [(values >= limit).view(np.uint8) for limit in (1 << 8, 1 << 16, 1 << 24) if most >= limit]
    code = sum(longer, np.zeros(len(values), dtype=np.uint8))
    # The last control byte of a part has values to spare, so a part begins at a byte of its own.
    codes = np.zeros(4 * int((-(-lengths // 4)).sum()), dtype=np.uint8)
    spans, start, first, upto = [], 0, 0, 0
    for n in lengths.tolist():
        mine, quads = code[start : start + n], -(-n // 4)
        codes[4 * first : 4 * first + n] = mine
        size = n + int(mine.sum())
        spans.append((first, first + quads, upto, upto + size))
        start, first, upto = start + n, first + quads, upto + size
    four = codes.reshape(-1, 4)
    control = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).tobytes()
    data = _cells(values, len(longer) + 1)[_used(code, len(longer) + 1)].tobytes()
    return [(control[a:b], data[c:d]) for a, b, c, d in spans]


def decode_parts(control: Sequence[bytes], data: Sequence[bytes], lengths: np.ndarray) -> np.ndarray:
    """The values of all parts, one after the other."""
    sizes = LENGTHS[np.frombuffer(b"".join(control), dtype=np.uint8)].reshape(-1)
    parts, first = [], 0
    for n in lengths.tolist():
        parts.append(sizes[first : first + n])
        first += -(-n // 4) * 4
    code = np.concatenate([*parts, np.zeros(0, dtype=np.uint8)]) - np.uint8(1)
    most = int(code.max(initial=0)) + 1
    cells = np.zeros(_width(most) * len(code), dtype=np.uint8)
    cells[_used(code, most)] = np.frombuffer(b"".join(data), dtype=np.uint8)
    return cells.view(f"<u{_width(most)}").astype(np.uint32)


def _width(most: int) -> int:
    return 4 if most > 2 else most


def _cells(values: np.ndarray, most: int) -> np.ndarray:
    """The bytes of ``values`` of up to ``most`` bytes, 1, 2 or 4 each."""
    return values.astype(f"<u{_width(most)}").view(np.uint8)


def _used(code: np.ndarray, most: int) -> np.ndarray:
    """Which of those bytes are stored; ``code`` is a value's number of bytes less one."""
    width = _width(most)
    used = np.ones(width * len(code), dtype=bool)
    for k in range(1, width):
        used[k::width] = code >= k
    return used


def together(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Spans of neighbours that have at most ``most`` in all, or are one."""
    start = held = end = 0
    for end, size in enumerate(sizes, 1):
        if held and held + size > most:
            yield start, end - 1
            start, held = end - 1, 0
        held += size
    if end > start:
        yield start, end


def width_of(tokenizer: Tokenizer) -> str:
    """Two bytes per id where the vocabulary allows it."""
    return "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


class Remembered(dict):
    """Values computed on first use. Of two generations, the older one goes when the younger is full, so what is used often stays."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, name: str) -> bytes:
        found = self.older.get(name)
        self[name] = found = self.make(name) if found is None else found
        return found

    def trim(self, most: int) -> None:
        if len(self) > most:
            self.older = dict(self)
            self.clear()


class WordMemo:
    """Ids of whole texts by way of their words, equal to encoding each text at once.

    A tokenizer of the known form lower-cases a text, drops its white space, cuts it into pieces by a rule and
    encodes each piece on its own, so it never joins what white space parts. A word of plain Latin
    letters, digits and signs is cut here by the same rule, and the tokenizer's model encodes each piece; any other
    word goes through the whole tokenizer. Words are remembered. A file of another form (``known`` is
    false) has its whole texts encoded by the tokenizer. ``tests/llm`` compares both ways.
    """

    # The plain range, the piece rule and the letters and numbers of that range.
    PLAIN = re.compile(r"[\t-\r !-~¡-įı-ſ]*")
    PIECES = re.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºÀ-ÖØ-öø-ſ]+|[0-9²³¹¼-¾]|[^\sa-z0-9ªµºÀ-ÖØ-öø-ſ²³¹¼-¾]+"
    )
    # The form of tokenizer for which words may be encoded one by one.
    NORMALIZER = {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
    PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = width_of(self.tokenizer)
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        self.known = (
            form.get("normalizer") == self.NORMALIZER and form.get("pre_tokenizer") == self.PRE_TOKENIZER
            and form["model"].get("type", "BPE") == "BPE" and not form["model"].get("dropout")
            and all(re.fullmatch(r"<\|\S*", t["content"]) and not (t["normalized"] or t["lstrip"] or t["rstrip"]) for t in form["added_tokens"]))
        self.model = self.tokenizer.model
        # The bytes of every id.
        self.packed = [self._pack([i]) for i in range(self.tokenizer.get_vocab_size())]
        self.words = Remembered(self._word)
        self.pieces = Remembered(self._piece)
        self.odd = Remembered(self._whole)
        # The byte alphabet of the model: printable Latin-1 stands for itself, the rest follows from 256 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in plain]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.dtype == '<u2' else 'I'}", *ids)

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(spelled)])

    def _word(self, word: str) -> bytes:
        """A plain, lower-cased word; letters alone are one piece. A word beside other signs finds its piece again."""
        if word.isalpha():
            return self.pieces[word]
        if word[-1] in ".,;:!?" and word[:-1].isalpha():
            return self.pieces[word[:-1]] + self.pieces[word[-1]]
        return b"".join(map(self.pieces.__getitem__, self.PIECES.findall(word)))

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _mixed(self, word: str) -> bytes:
        return self.words[word.lower()] if "<|" not in word and self.PLAIN.fullmatch(word) else self.odd[word]

    def ids(self, text: str | None) -> bytes:
        """Ids of the whole text as little-endian numbers of the width ``dtype``."""
        if not text:
            return b""
        if not self.known:
            return self._whole(text)
        for memory, most in ((self.words, MEMO_WORDS), (self.pieces, MEMO_PIECES), (self.odd, MEMO_ODD)):
            memory.trim(most)
        if "<|" not in text and self.PLAIN.fullmatch(text):
            return b"".join(map(self.words.__getitem__, text.lower().split()))
        # bytes.split cuts at ASCII white space, all of which the tokenizer drops.
        return b"".join([self._mixed(w.decode()) for w in text.encode().split()])


_MEMO: dict[str, WordMemo] = {}


def tokenize(docs: DataFrame, vocabulary: str, *, end_id: int = 2, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``ids`` (``end_id`` last, in the width of the vocabulary)."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

    @F.pandas_udf("binary")
    def encoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if vocabulary not in _MEMO:
            _MEMO[vocabulary] = WordMemo(vocabulary)
        memo = _MEMO[vocabulary]
        end = np.array([end_id], dtype=memo.dtype).tobytes()
        for texts in parts:
            yield pd.Series([memo.ids(t) + end for t in texts], dtype=object)

    return docs.withColumn("ids", encoded(text)).drop(text)


def rank_table(tokens: DataFrame, dtype: str) -> np.ndarray:
    """Ids by falling frequency (ties: smaller id first). The vocabulary bounds its length."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            held = batch["ids"].tolist()
            for a, b in together(map(len, held), BLOCK_IDS * np.dtype(dtype).itemsize):
                ids = np.frombuffer(b"".join(held[a:b]), dtype=dtype)
                for i in range(0, len(ids), PART_IDS):
                    n = np.bincount(ids[i : i + PART_IDS])
                    if len(n) > len(total):
                        total = np.pad(total, (0, len(n) - len(total)))
                    total[: len(n)] += n
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "n": total[used]})

    counted = tokens.select("ids").mapInPandas(count, "id long, n long")
    rows = counted.groupBy("id").agg(F.sum("n").alias("n")).collect()
    return np.array([r.id for r in sorted(rows, key=lambda r: (-r.n, r.id))], dtype=np.uint32)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, *, end_id: int = 2, key: str = "doc_id") -> None:
    """Encode ``docs`` and write their ids below ``path`` in ascending order of ``key``.

    ``path/ids``: per document (long ones in parts of ``PART_IDS``) the control bytes, the data bytes and
    the number of ids, in files that follow the order, with the ids before it in its file;
    ``path/ranks``: the ids by frequency. Each document is encoded once: its ids are staged, counted,
    and dealt by range of the key. Null keys come first; equal keys and repeated
    rows are written each; null and empty texts hold the end id alone.
    """
    spark = docs.sparkSession
    dtype = width_of(Tokenizer.from_file(vocabulary))
    encoded_at = fresh_path(spark, "token-ids")
    tokenize(docs.select(key, "text"), vocabulary, end_id=end_id).write.option("compression", "zstd").parquet(encoded_at)
    ids = spark.read.parquet(encoded_at)
    order = rank_table(ids, dtype)
    ranks = np.zeros(int(order.max(initial=0)) + 1, dtype=np.uint32)
    ranks[order] = np.arange(len(order), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf("parts array<struct<n: int, control: binary, data: binary>>, upto long")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        upto = 0
        for series in batches:
            width, held = np.dtype(dtype).itemsize, series.tolist()
            pieces = [(row, raw[i : i + PART_IDS * width]) for row, raw in enumerate(held) for i in range(0, len(raw), PART_IDS * width)]
            out: list[list[dict]] = [[] for _ in held]
            for a, b in together((len(raw) for _, raw in pieces), BLOCK_IDS * width):
                values = shared.value[np.frombuffer(b"".join([raw for _, raw in pieces[a:b]]), dtype=dtype)]
                lengths = [len(raw) // width for _, raw in pieces[a:b]]
                for (row, _), n, (control, data) in zip(pieces[a:b], lengths, encode_parts(values, np.array(lengths))):
                    out[row].append({"n": n, "control": control, "data": data})
            sums = upto + np.cumsum([len(raw) // width for raw in held], dtype=np.int64)
            upto = int(sums[-1]) if len(sums) else upto
            yield pd.DataFrame({"parts": pd.Series(out, dtype=object), "upto": pd.Series(sums, dtype="int64")})

    # Every file holds one range of keys in order; where its ids begin follows from the files before
    # it. The ids are packed after the shuffle, so that sampling the range bounds packs nothing, and
    # one pass of Python packs and adds up.
    n_tokens = (F.octet_length("ids") / np.dtype(dtype).itemsize).cast("long")
    rows = dealt_in_order(ids.select(key, "ids").withColumn(SIZE, n_tokens), [key])
    rows = rows.withColumn("_p", packed.asNondeterministic()("ids"))
    rows.select(key, SIZE, PART, ROW, (F.col("_p.upto") - F.col(SIZE)).alias(BEFORE), "_p.parts").write.parquet(f"{path}/ids")
    table = ", ".join(map(str, order.tolist()))
    spark.sql(f"SELECT posexplode(array({table})) AS (rank, id)" if len(order) else "SELECT 0 AS rank, 0 AS id WHERE false") \
        .coalesce(1).write.parquet(f"{path}/ranks")


def read_tokens(spark: SparkSession, path: str, *, key: str = "doc_id") -> DataFrame:
    """``key``, ``start`` and ``ids`` (little-endian unsigned 32-bit) of every document below ``path``."""
    rows = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()  # at most the vocabulary
    shared = spark.sparkContext.broadcast(np.array([r.id for r in rows], dtype="<u4"))

    @F.pandas_udf("binary")
    def unpacked(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in parts:
            pieces = [(row, p["n"], p["control"], p["data"]) for row, stored in enumerate(series) for p in stored]
            out: list[list[bytes]] = [[] for _ in range(len(series))]
            for a, b in together((p[1] for p in pieces), BLOCK_IDS):
                row, lengths, control, data = zip(*pieces[a:b])
                ids = shared.value[decode_parts(control, data, np.array(lengths))].tobytes()
                ends = [0, *(4 * np.cumsum(lengths, dtype=np.int64)).tolist()]
                for at, i, j in zip(row, ends, ends[1:]):
                    out[at].append(ids[i:j])
            yield pd.Series([b"".join(parts) for parts in out], dtype=object)

    rows = with_offsets(spark.read.parquet(f"{path}/ids"))
    return rows.select(key, F.col(BEFORE).alias("start"), unpacked("parts").alias("ids"))


def ids_round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the ids of ``docs`` to a fresh folder and read them back."""
    path = fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary)
    return read_tokens(docs.sparkSession, path)
