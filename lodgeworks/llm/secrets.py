"""Secrets in texts: keyword hits first, expressions anchored at the hits, checksums last."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Kinds in their order, keywords, token prefixes and the expressions of each kind.
BASE_KINDS = ("assign", "access", "hex")
KINDS = ("assign", "access", "hex", "github", "npm")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign",
    "apikey": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github",
    "ghr_": "github", "npm_": "npm",
}
EXPRESSIONS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "github": r"gh[pousr]_[0-9A-Za-z]{36}(?![0-9A-Za-z])",
    "npm": r"npm_[0-9A-Za-z]{36}(?![0-9A-Za-z])",
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_RUN = 16

_PATTERNS = {kind: re.compile(e, re.ASCII) for kind, e in EXPRESSIONS.items()}
#: Lower-case hexadecimal digits become h, all other code points a blank.
_HEX_MAP = bytes(0x68 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))


def base62_checksum(body: str) -> str:
    """CRC-32 of the random part of a token in six digits of base 62."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out


def _counts(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[1]) >= 12
    if kind == "access":
        return len(match[0]) >= 18
    return base62_checksum(match[0][4:-6]) == match[0][-6:]


def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        automaton.add_word(word, (len(word), kind))
    automaton.make_automaton()
    return automaton


def spans_of(text: str | None, automaton: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then by the order of the kinds.

    Per kind the result is that of a scan for leftmost matches that do not overlap: a match can only
    begin at a keyword, hits are tried from left to right, and one inside the last match of its kind
    (kept or dropped) is passed over. Runs of hexadecimal digits have no keyword; sixteen of them in
    a row play that part.
    """
    if not text:
        return []
    # One byte per code point, so that positions stay those of the text.
    narrow = text.encode("latin-1", "replace")
    hits: dict[str, list[int]] = {}
    for end, (length, kind) in automaton.iter(narrow.lower().decode("latin-1")):
        hits.setdefault(kind, []).append(end - length + 1)
    found = []
    for kind, starts in hits.items():
        last = 0
        for start in sorted(starts):
            if start >= last and (match := _PATTERNS[kind].match(text, start)):
                last = match.end()
                if _counts(kind, match):
                    found.append((start, last, kind))
    marks, at = narrow.translate(_HEX_MAP), 0
    while (start := marks.find(b"h" * HEX_RUN, at)) >= 0:
        end = marks.find(b" ", start)
        at = len(marks) if end < 0 else end
        found.append((start, at, "hex"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


@F.pandas_udf(ArrayType(StringType()))
def _scan(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    automaton = _automaton()
    for texts in parts:
        yield pd.Series([[f"{k}:{s}:{e}" for s, e, k in spans_of(t, automaton)] for t in texts], dtype=object)


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: an array of ``kind:start:end`` (code points, end exclusive).

    Kinds: ``assign``, ``access`` and ``hex`` as written; ``github`` and ``npm`` tokens where the
    checksum inside them holds. Whole texts are read once and nothing is shuffled. Null and empty
    texts have an empty array; a column named ``secrets`` is replaced.
    """
    return docs.drop("secrets").withColumn("secrets", _scan(text))


def of_kinds(kinds: tuple[str, ...], secrets: str = "secrets") -> Column:
    return F.filter(secrets, lambda s: F.substring_index(s, ":", 1).isin(*kinds))


def redact(docs: DataFrame, mark: str = "[secret]", text: str = "text") -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mark``; overlapping spans become one mark."""

    @F.pandas_udf("string")
    def cut(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _automaton()
        for texts in parts:
            out = []
            for t in texts:
                if t is None:
                    out.append(None)
                    continue
                pieces, at = [], 0
                for start, end, _ in spans_of(t, automaton):
                    if start >= at:
                        pieces += [t[at:start], mark]
                    at = max(at, end)
                out.append("".join([*pieces, t[at:]]))
            yield pd.Series(out, dtype=object)

    return docs.withColumn(text, cut(text))
