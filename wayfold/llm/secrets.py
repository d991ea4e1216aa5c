"""Secret scans with multipart credential linking.

Base patterns stand on their own. Beside them a text holds weak parts: access identifiers (client ids, user names, short or foreign key ids), secrets (short
or unnamed values, mixed random strings) and endpoints (URLs, hosts with a port, bucket names). A weak part is reported only if
complementary parts lie in its scope: apart from it by at most `REACH` characters and no paragraph break. The interval join of the parts is a search in sorted
positions, so a text with many parts costs n log n and no pair is written out.

    a weak secret       needs an identifier (weak, or a base access key) in its scope
    a weak identifier   needs a secret (weak, or a base assignment or hex string) and an endpoint or an assignment sign of its own name
    an endpoint         is only evidence and is not reported

Cost: one pass without a shuffle.

Defined cases: null text counts as empty: no spans, the hash of the empty string; offsets are code points; the rows of a
repeated doc_id are searched each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm import arrowtext as at
from wayfold.llm.common import in_arrow

KINDS = ("assign", "access", "hex", "ident", "secret")
BASE = KINDS[:3]
REACH = 400

_FLAGS = re.A | re.I
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _FLAGS)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")

_WEAK_IDENT = re.compile(r"""(?:client_?id|user(?:name)?|login|account|access_?key(?:_?id)?|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}|(?<![A-Za-z0-9])A(?:KIA|SIA|ROA|IDA)[A-Z0-9]{8,}""", _FLAGS)
_WEAK_VALUE = re.compile(r"""(?:pass(?:word|wd|phrase)?|pwd|secret|client_?secret|token|auth|api_?key|credential)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=!$%&*-]{6,})""", _FLAGS)
_RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(r"[a-z][a-z0-9+]{1,9}://[^\s\"'<>]+|(?:host|endpoint|server|region|bucket|url)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9./:_-]{3,}", _FLAGS)
_HINT = re.compile(r"[:=]|AKIA|ASIA|AROA|AIDA")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, by start, then kind."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def _random_looking(s: str) -> bool:
    kinds = sum(any(f(c) for c in s) for f in (str.isdigit, str.islower, str.isupper))
    return kinds == 3 and entropy(s) >= 3.5


def weak_parts(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]], list[tuple[int, int]]]:
    """Weak identifiers, weak secrets and endpoints."""
    idents = [m.span() for m in _WEAK_IDENT.finditer(text)]
    secrets = [m.span() for m in _WEAK_VALUE.finditer(text)]
    secrets += [m.span() for m in _RANDOM.finditer(text) if _random_looking(m.group())]
    return idents, secrets, [m.span() for m in _ENDPOINT.finditer(text)]


def joined(left: list[tuple[int, int]], right: list[tuple[int, int]], breaks: np.ndarray) -> np.ndarray:
    """Which of the `left` intervals have a `right` one in their scope: before or after them, within REACH, and no break between. The nearest on either side decides,
    since a break or a distance that parts it parts all beyond it."""
    ls, le = np.array(left, np.int64).reshape(-1, 2).T
    starts, ends = np.sort(np.array(right, np.int64).reshape(-1, 2), axis=0).T
    near = np.zeros(len(ls), bool)

    def close(which: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        near[which] |= (high - low <= REACH) & (np.searchsorted(breaks, low) == np.searchsorted(breaks, high))

    after = np.searchsorted(starts, le)
    some = np.flatnonzero(after < len(starts))
    close(some, le[some], starts[after[some]])
    before = np.searchsorted(ends, ls, "right") - 1
    some = np.flatnonzero(before >= 0)
    close(some, ends[before[some]], ls[some])
    return near


def clear(spans: list[tuple[int, int]], of: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The distinct spans, sorted, that overlap none of `of`."""
    mine = np.unique(np.array(spans, np.int64).reshape(-1, 2), axis=0)
    others = np.array(sorted(of), np.int64).reshape(-1, 2)
    if len(mine) and len(others):
        reach = np.maximum.accumulate(others[:, 1])  # of those that start before a span ends, the furthest end
        at_ = np.searchsorted(others[:, 0], mine[:, 1]) - 1
        mine = mine[(at_ < 0) | (reach[np.maximum(at_, 0)] <= mine[:, 0])]
    return list(map(tuple, mine.tolist()))


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and added spans, (start, kind, end) each."""
    base = base_spans(text)
    if not _HINT.search(text):
        return base, []
    idents, secrets, ends = weak_parts(text)
    strong = [(a, b) for a, _, b in base]
    weak_secrets = clear(secrets, strong)
    weak_idents = clear(idents, strong + weak_secrets)
    if not weak_idents and not weak_secrets:
        return base, []
    breaks = np.array([m.start() for m in re.finditer(r"\n\s*\n", text)], np.int64)
    all_idents = weak_idents + [(a, b) for a, k, b in base if k == 1]
    all_secrets = weak_secrets + [(a, b) for a, k, b in base if k != 1]
    added = [(a, 4, b) for (a, b), near in zip(weak_secrets, joined(weak_secrets, all_idents, breaks), strict=True) if near]
    with_secret, with_end = joined(weak_idents, all_secrets, breaks), joined(weak_idents, ends, breaks)
    for (a, b), s, e in zip(weak_idents, with_secret, with_end, strict=True):
        if s and (e or any(c in text[a:b] for c in ":=")):
            added.append((a, 3, b))
    out: list[tuple[int, int, int]] = []
    for a, k, b in sorted(added, key=lambda x: (x[0], -x[2])):
        if not out or out[-1][2] <= a:
            out.append((a, k, b))
    return base, out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())])


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, spans: array of (kind, start, end, added) by start, then kind as listed; added marks spans beyond the base."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in at.chunks(batches, limit=2 << 20):
            rows = []
            for i in range(chunk.rows.num_rows):
                base, added = find(chunk.text(i).decode(errors="replace"))
                both = sorted([(a, k, b, False) for a, k, b in base] + [(a, k, b, True) for a, k, b in added])
                rows.append([{"kind": KINDS[k], "start": a, "end": b, "added": new} for a, k, b, new in both])
            yield pa.RecordBatch.from_arrays([chunk.rows.column(0), pa.array(rows, pa.list_(_SPAN))], names=["doc_id", "spans"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_arrow(texts, make, "doc_id long, spans array<struct<kind string, start long, end long, added boolean>>")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents, every reported span of their text replaced by `mark`; overlapping spans are one. Other columns stay."""
    names, place = docs.columns, docs.columns.index("text")

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in at.chunks(batches, limit=2 << 20):
            texts = []
            for i, known in enumerate(chunk.rows.column(place).is_valid().to_pylist()):
                text, out, end = chunk.text(i).decode(errors="replace"), [], 0
                base, added = find(text) if known else ([], [])
                for a, _, b in sorted(base + added):
                    if a >= end:
                        out += [text[end:a], mark]
                    end = max(end, b)
                texts.append("".join([*out, text[end:]]) if known else None)
            columns = [pa.array(texts, pa.string()) if k == place else chunk.rows.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, schema=chunk.rows.schema)

    return in_arrow(docs, make, docs.schema)


def secrets(docs: DataFrame) -> DataFrame:
    from wayfold.llm.pii import digest

    return digest(find_secrets(docs), BASE)
