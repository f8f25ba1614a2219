"""URL filter: a sorted array of 64-bit digests, probed by binary search and confirmed by full strings."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeworks.session import shared_dir

MAGIC = b"URLDIG01"
#: A list of more bytes than this is refused: every executor keeps a copy of the file.
MAX_LIST_BYTES = 1 << 30


def pack_rules(rules: Iterable[tuple[str, str]]) -> bytes:
    """The list as one block of bytes: sorted digests, then verdicts, offsets and the full strings.

    A rule is ``(verdict, "host/path")``. Of equal strings the first counts. Rules whose digests
    collide stand side by side and are told apart by their strings.
    """
    unique: dict[str, str] = {}
    for verdict, rule in rules:
        if verdict not in ("allow", "block") or "/" not in rule:
            raise ValueError(f"not a rule: {verdict} {rule}")
        unique.setdefault(rule, verdict)
    keys = [r.encode() for r in unique]
    digests = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype=np.uint64)
    order = np.argsort(digests, kind="stable")
    keys = [keys[i] for i in order]
    verdicts = np.array([v == "block" for v in unique.values()], dtype=np.uint8)[order]
    ends = np.cumsum([len(k) for k in keys], dtype=np.int64)
    # Two facts keep the probes few: the lengths of paths, and the labels of hosts, that occur.
    lengths = sorted({len(k) - k.index(b"/") for k in keys})
    labels = max((k[: k.index(b"/")].count(b".") + 1 for k in keys), default=0)
    head = MAGIC + struct.pack("<qqq", len(keys), len(lengths), labels) + np.array(lengths, dtype=np.int64).tobytes()
    body = digests[order].tobytes() + ends.tobytes() + verdicts.tobytes() + b"".join(keys)
    if len(head) + len(body) > MAX_LIST_BYTES:
        raise ValueError("the list is larger than MAX_LIST_BYTES; join it as a table instead")
    return head + body


class RuleFile:
    """The packed list, memory-mapped: pages of it are read as probes touch them."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        if raw[:8].tobytes() != MAGIC:
            raise ValueError(f"{path} is not a packed list")
        n, n_lengths, self.labels = struct.unpack("<qqq", raw[8:32].tobytes())
        at = 32 + 8 * n_lengths
        self.lengths = raw[32:at].view(np.int64).tolist()
        self.digests, self.ends = raw[at : at + 8 * n].view(np.uint64), raw[at + 8 * n : at + 16 * n].view(np.int64)
        self.verdicts, self.strings = raw[at + 16 * n : at + 17 * n], raw[at + 17 * n :]

    def lookup(self, keys: list[bytes]) -> np.ndarray:
        """Position of every key in the list, or -1; equal digests are confirmed by the strings."""
        wanted = np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=len(keys))
        low = np.searchsorted(self.digests, wanted, side="left")
        high = np.searchsorted(self.digests, wanted, side="right")
        found = np.full(len(keys), -1, dtype=np.int64)
        for i in np.flatnonzero(high > low):
            for at in range(low[i], high[i]):
                start = self.ends[at - 1] if at else 0
                if self.strings[start : self.ends[at]].tobytes() == keys[i]:
                    found[i] = at
        return found

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list, list]:
        """Rule and verdict of each url, None where no rule fits; the longest rule wins."""
        keys, owner = [], []
        for i, (host, path) in enumerate(zip(hosts, paths)):
            labels = host.split(".")
            for k in range(1, min(len(labels), self.labels) + 1):
                suffix = ".".join(labels[-k:]).encode()
                for n in self.lengths:
                    # Lengths are in bytes; a path of fewer bytes cannot start with the rule's.
                    prefix = path.encode()[:n]
                    if len(prefix) == n:
                        keys.append(suffix + prefix)
                        owner.append(i)
        rules, verdicts, longest = [None] * len(hosts), [None] * len(hosts), [0] * len(hosts)
        if keys:
            found = self.lookup(keys)
            for j in np.flatnonzero(found >= 0):
                i = owner[j]
                if len(keys[j]) > longest[i]:
                    longest[i], rules[i] = len(keys[j]), keys[j].decode()
                    verdicts[i] = "block" if self.verdicts[found[j]] else "allow"
        return rules, verdicts


def publish_rules(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> str:
    """Write the packed list to the shared folder and hand it to every executor; returns the file's name."""
    name = f"urls-{uuid.uuid4().hex}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(pack_rules(rules))
    finally:
        out.close()
    spark.sparkContext.addFile(path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return name


_OPEN: dict[str, RuleFile] = {}


def _rule_file(name: str) -> RuleFile:
    path = SparkFiles.get(name)
    if path not in _OPEN:
        _OPEN.clear()
        _OPEN[path] = RuleFile(path)
    return _OPEN[path]


def split_url(url: str = "url"):
    """Host (between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lower-cased) and path
    (from there up to ``?``, ``#`` or the end); both empty for null and for urls without ``://``."""
    inner = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)([^?#]*)", 1)
    host = F.translate(inner, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)([^?#]*)", 2)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def filter_urls(
    pages: DataFrame, rules: Iterable[tuple[str, str]], *, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, the longest ``rule`` that fits (else null) and its ``verdict`` (else ``default``).

    A rule ``host/path`` fits its host and all subdomains where the path starts with the rule's.
    Each url probes the list with its host suffixes joined to its path prefixes of the lengths that
    occur in the list; nothing is shuffled and the list is read through a memory map.

    Null urls and urls without ``://`` have an empty host and path and fit no rule; an empty list
    leaves every url to ``default``; repeated rows are judged alike; columns of these names are
    replaced.
    """
    name = publish_rules(pages.sparkSession, rules)

    @F.pandas_udf("rule string, verdict string")
    def judged(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        listed = _rule_file(name)
        for hosts, paths in parts:
            rule, verdict = listed.judge(list(hosts), list(paths))
            yield pd.DataFrame({"rule": pd.Series(rule, dtype=object), "verdict": pd.Series(verdict, dtype=object)})

    plain = pages.drop("host", "path", "rule", "verdict")
    host, path = split_url(url)
    out = plain.withColumns({"host": host, "path": path}).withColumn("__lw_judged", judged("host", "path"))
    return out.withColumns({
        "rule": F.col("__lw_judged.rule"), "verdict": F.coalesce("__lw_judged.verdict", F.lit(default)),
    }).drop("__lw_judged")
