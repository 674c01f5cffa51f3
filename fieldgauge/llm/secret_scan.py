"""Secret scan: keyword automaton, anchored expressions near its hits, then checksums.

The base kinds are those of the contract.  The method adds keys that carry their own checksum,
so a string of the right shape alone is no finding:

* ``github`` and ``npm``: six base-62 digits hold the CRC-32 of the 30 characters before them
* ``age``: a bech32 checksum over the whole key
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.text import as_bytes, per_batch

#: in the order in which spans with one start are listed
KINDS = ("assign", "access", "hex", "github", "npm", "age")
BASE = 3

_ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{32,}")
_GITHUB = re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_NPM = re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
# fixed values of the bech32 format
_BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
_BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
_AGE = re.compile(b"AGE-SECRET-KEY-1[%s]{58}(?![A-Z0-9])" % _BECH32.upper().encode())
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_IS_HEX = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))
_HEX_PROBE = re.compile(rb"\x01{4,}")

_SCHEMA = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def crc_holds(token: bytes) -> bool:
    """The last six characters are the base-62 CRC-32 of those between the prefix and them."""
    body, tail = token[4:-6], token[-6:]
    value = 0
    for digit in tail:
        value = value * 62 + _BASE62.index(digit)
    return value == zlib.crc32(body)


def bech32_holds(key: bytes) -> bool:
    name, _, data = key.decode("ascii").lower().rpartition("1")
    values = [ord(c) >> 5 for c in name] + [0] + [ord(c) & 31 for c in name] + [_BECH32.index(c) for c in data]
    state = 1
    for v in values:
        top, state = state >> 25, (state & 0x1FFFFFF) << 5 ^ v
        for i, step in enumerate(_BECH32_STEPS):
            if top >> i & 1:
                state ^= step
    return state == 1


# keyword, kind, expression anchored at the keyword, what a match must also hold
_RULES = (
    *((k, "assign", _ASSIGN, lambda m: len(m[2]) >= 8)
      for k in ("password", "passwd", "secret", "token", "apikey", "api_key")),
    ("akia", "access", _ACCESS, lambda m: len(m[0]) >= 16),
    *((f"gh{c}_", "github", _GITHUB, lambda m: crc_holds(m[0])) for c in "pousr"),
    ("npm_", "npm", _NPM, lambda m: crc_holds(m[0])),
    ("age-secret-key-1", "age", _AGE, lambda m: bech32_holds(m[0])),
)


@lru_cache(maxsize=1)
def _keywords() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for rule in _RULES:
        automaton.add_word(rule[0], rule)
    automaton.make_automaton()
    return automaton


def find(text: bytes | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in bytes, sorted; per kind leftmost and non-overlapping.

    A match that fails its test still uses up its characters, as a scan by the expression would.
    """
    if not text:
        return []
    found = []
    used = dict.fromkeys(KINDS, 0)
    for end, (word, kind, pattern, holds) in _keywords().iter(text.lower().decode("latin-1")):
        start = end + 1 - len(word)
        if start < used[kind]:
            continue
        if match := pattern.match(text, start):
            used[kind] = match.end()
            if holds(match):
                found.append((start, KINDS.index(kind), match.end()))
    # 32 hex digits cover four multiples of 8: only there is the expression tried
    for probe in _HEX_PROBE.finditer(text.translate(_IS_HEX)[::8]):
        for match in _HEX.finditer(text, max(0, 8 * probe.start() - 7), 8 * probe.end()):
            found.append((match.start(), KINDS.index("hex"), match.end()))
    return sorted(found)


def _in_code_points(text: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not found or text.isascii():
        return found
    heads = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [(int(heads[a]), k, int(heads[b])) for a, k, b in found]


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end in code points, end exclusive) of every row.

    Spans are ordered by start, then kind as in ``KINDS``.  Null and empty texts have none;
    repeated rows are scanned alike.
    """

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [
            [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in _in_code_points(t or b"", find(t))]
            for t in batch.column("text").to_pylist()
        ]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _SPANS)], ["doc_id", "spans"])

    return per_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes()), build, _SCHEMA)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as one string."""
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:BASE]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:BASE]],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )
