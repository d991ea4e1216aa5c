"""Personal data: fixed base patterns, and spans that a character-level BiLSTM-CRF adds.

The tagger is trained on the driver from labelled spans: base matches in a bounded sample of documents, and written variants of the four
kinds (numbers without a country code, masked at-signs and dots, spaced or dotted digits) put into the sample's contexts, beside look-alikes that are no
personal data. The BiLSTM runs in windows of 96 characters that overlap by half. Where two windows meet, a character's emissions are the mean of both, weighted by
how deep it lies in each, and one Viterbi pass with the CRF's transitions decodes the whole run of windows, however long: no tag sequence ends at a window's edge.

A tagged span is reported only if it holds up: digits in number and check sum as its kind demands, an at-sign or a masked one for an email.
All of these need a digit, an at-sign, a bracketed `at` or the word `dot`; runs are the windows around these, and a run whose first or last character
is tagged grows until it is not, so that a span ends where the tagger ends it. Spans that overlap a base span go; base spans always stay.

Cost: one pass without a shuffle; weights of some 20 kB go with the closure. A fitted tagger can be kept and passed to `find_pii`.

Defined cases: null text counts as empty: no spans, the hash of the empty string; offsets are code points; the rows of a
repeated doc_id are searched each; extra columns are ignored; an empty table trains on written variants alone and gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm import arrowtext as at
from wayfold.llm.common import in_arrow, sample_texts
from wayfold.llm.tagger import FORBIDDEN, Tagger

KINDS = ("email", "ip", "card", "phone")
WIDTH, STRIDE = 96, 48

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY_DIGIT = re.compile("[0-9]")

_SYMBOLS = "abcdefghijklmnopqrstuvwxyz@.-_+()[]{}<>:/,#%*\"'=;"
_OTHER_LETTER, _DIGIT, _SPACE, _BREAK, _OTHER = (len(_SYMBOLS) + k for k in range(5))
SYMBOLS = len(_SYMBOLS) + 5
_CLASS = np.full(0x3000, _OTHER, np.int16)
_CLASS[[c for c in range(0x3000) if chr(c).isalpha()]] = _OTHER_LETTER
for _k, _c in enumerate(_SYMBOLS):
    _CLASS[[ord(_c), ord(_c.upper())]] = _k
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[[0x20, 0x09]], _CLASS[[0x0A, 0x0D]] = _SPACE, _BREAK


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from the at-signs: a match holds one, and starts as far left as the last match lets it."""
    end, sign = 0, text.find("@")
    while sign >= 0:
        host = _HOST.match(text, sign + 1)
        if host:
            start = sign
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < sign:
                end = host.end()
                yield start, end
        sign = text.find("@", max(sign + 1, end))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if _ANY_DIGIT.search(text):  # all that the three patterns have in common
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            d = _digits(m.group())
            if 13 <= len(d) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


_MASKED_AT = re.compile(r"@|[\[({<]\x20?at\x20?[\])}>]|\x20at\x20", re.I)
_MASKED_DOT = re.compile(r"\.|[\[({<]\x20?(?:dot|\.)\x20?[\])}>]|\x20dot\x20", re.I)


def holds_up(kind: int, span: str) -> bool:
    """Whether a tagged span is what its kind demands. Every span that passes holds a trigger of `triggers`."""
    d = _digits(span)
    if kind == 0:
        parts = _MASKED_AT.split(span)
        if len(parts) != 2 or not parts[0].strip() or not _MASKED_DOT.search(parts[1].strip()):
            return False
        return "@" in span or bool(re.search(r"[\[({<]\x20?at|\x20dot\x20", span, re.I))
    if kind == 1:
        numbers = re.findall("[0-9]+", span)
        return len(numbers) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in numbers)
    if kind == 2:
        return 13 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15 and not re.search("[A-Za-z]", span) and len(re.findall("[0-9]+", span)) >= 2


def symbols(points: np.ndarray) -> np.ndarray:
    out = np.full(len(points), _OTHER_LETTER, np.int16)
    low = points < len(_CLASS)
    out[low] = _CLASS[points[low]]
    return out


def triggers(points: np.ndarray) -> np.ndarray:
    """Positions of digits, at-signs, bracketed `at` and the word `dot`, without which no span holds up."""
    fold = points | np.uint32(0x20)
    hit = ((points >= 0x30) & (points <= 0x39)) | (points == 0x40)
    n = len(points)
    if n > 4:
        word = (fold[:-2] == 0x64) & (fold[1:-1] == 0x6F) & (fold[2:] == 0x74)
        hit[:-2] |= word
        bracket = np.isin(points, [ord(c) for c in "[({<"])
        pair = np.zeros(n, bool)
        pair[:-1] = (fold[:-1] == 0x61) & (fold[1:] == 0x74)
        near = np.zeros(n, bool)
        near[1:] |= bracket[:-1]
        near[2:] |= bracket[:-2]
        hit |= pair & near
    return np.flatnonzero(hit)


_DEPTH = np.minimum(np.arange(WIDTH), np.arange(WIDTH)[::-1]).astype(np.float32) + 1
_PARTS = WIDTH // STRIDE


def _emissions(model: Tagger, padded: np.ndarray, cuts: np.ndarray, windows: np.ndarray, blocks: np.ndarray, batch: int = 1024) -> np.ndarray:
    """Emissions (block, STRIDE, tag) of blocks of STRIDE characters, each the weighted mean over the windows that cover it. Windows and blocks are (text << 32) | slot."""
    total = np.zeros((len(blocks), STRIDE, model.tags), np.float32)
    weight = np.zeros((len(blocks), STRIDE, 1), np.float32)
    for i in range(0, len(windows), batch):
        mine = windows[i : i + batch]
        start, stop = cuts[mine >> 32] + (mine & 0xFFFFFFFF) * STRIDE, cuts[(mine >> 32) + 1]
        grid = start[:, None] + np.arange(WIDTH)[None]
        inside = grid < stop[:, None]
        found = model.emissions(np.where(inside, padded[np.minimum(grid, len(padded) - 1)], _BREAK)).transpose(1, 0, 2)
        for part in range(_PARTS):
            to = np.searchsorted(blocks, mine + part)
            good = (to < len(blocks)) & (blocks[np.minimum(to, len(blocks) - 1)] == mine + part)
            cells = slice(part * STRIDE, (part + 1) * STRIDE)
            total[to[good]] += found[good, cells] * _DEPTH[cells][None, :, None]
            weight[to[good]] += _DEPTH[cells][None, :, None]
    return total / weight


def _runs(model: Tagger, padded: np.ndarray, cuts: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks that the windows cover, their tags (block, STRIDE), and which blocks start a run."""
    blocks = np.unique(np.concatenate([windows + part for part in range(_PARTS)]))
    start, stop = cuts[blocks >> 32] + (blocks & 0xFFFFFFFF) * STRIDE, cuts[(blocks >> 32) + 1]
    blocks, start, stop = (x[start < stop] for x in (blocks, start, stop))
    inside = start[:, None] + np.arange(STRIDE)[None] < stop[:, None]
    emissions = _emissions(model, padded, cuts, windows, blocks)
    emissions[~inside] = 0
    emissions[~inside, 1:] = FORBIDDEN
    begins = np.concatenate(([True], np.diff(blocks) != 1))
    return blocks, model.decode_runs(emissions, begins) * inside, begins


def tag(model: Tagger, points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Tags of all characters of the texts at cuts (offsets in code points): windows with triggers, decoded run by run."""
    tags = np.zeros(len(points), np.int8)
    found = triggers(points)
    padded = np.concatenate((symbols(points), np.full(WIDTH, _BREAK, np.int16)))
    doc = np.searchsorted(cuts, found, "right") - 1
    slot = (found - cuts[doc]) // STRIDE
    windows, grow = np.unique(np.concatenate([(doc << 32) | np.maximum(slot - k, 0) for k in range(_PARTS)])), 1
    while len(windows):
        blocks, decoded, begins = _runs(model, padded, cuts, windows)
        places = cuts[blocks >> 32][:, None] + (blocks & 0xFFFFFFFF)[:, None] * STRIDE + np.arange(STRIDE)[None]
        real = places < cuts[(blocks >> 32) + 1][:, None]
        tags[places[real]] = decoded[real]
        # runs that a span enters or leaves at an inner edge grow, more each time
        low, high = blocks & 0xFFFFFFFF, (cuts[(blocks >> 32) + 1] - cuts[blocks >> 32] + STRIDE - 1) // STRIDE
        ends = np.append(begins[1:], True)
        left, right = begins & (decoded[:, 0] > 0) & (low > 0), ends & (decoded[:, -1] > 0) & (low + 1 < high)
        if not (left.any() or right.any()):
            break
        more = [windows]
        for k in range(1, grow + 1):
            more += [blocks[left] - np.minimum(k, low[left]), blocks[right] + np.minimum(k, high[right] - 1 - low[right]) - 1]
        texts = np.unique(blocks[left | right] >> 32)
        windows, grow = np.unique(np.concatenate(more)), 2 * grow
        windows = windows[np.isin(windows >> 32, texts)]
    return tags


def spans_of(tags: np.ndarray, low: int, high: int) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the runs of one kind in tags[low:high], relative to low; a begin tag starts a new span."""
    mine = tags[low:high]
    places = np.flatnonzero(mine)
    out: list[list[int]] = []
    for p in places.tolist():
        t = int(mine[p])
        kind = (t - 1) // 2
        if out and out[-1][2] == p and out[-1][0] == kind and t % 2 == 0:
            out[-1][2] = p + 1
        else:
            out.append([kind, p, p + 1])
    return [tuple(x) for x in out]


def _written(rng: np.random.Generator) -> tuple[str, int]:
    """A written example and its kind, -1 for a look-alike."""
    digit = lambda n: "".join(str(x) for x in rng.integers(0, 10, n))
    pick = lambda *options: options[int(rng.integers(len(options)))]
    word = lambda: "".join(pick(*"abcdefghijklmnopqrstuvwxyz") for _ in range(int(rng.integers(3, 9))))
    kind = int(rng.integers(0, 6))
    if kind == 0:
        sign, dot = pick("@", " [at] ", " (at) ", "[at]", "(at)", " at ", "@"), pick(".", ".", " [dot] ", " dot ", "(dot)")
        sign, dot = (sign, " dot ") if sign == " at " else (sign, dot)
        sign = " at " if sign == "@" and dot == " dot " else sign
        return f"{word()}{pick('', '.', '_', '-')}{pick(word(), digit(2))}{sign}{pick('', 'mail7' + dot)}{word()}{dot}{pick('com', 'org', 'net', 'de', 'example')}", 0
    if kind == 1:
        return pick(".", ".", "[.]", " . ").join(str(x) for x in rng.integers(1, 256, 4)), 1
    if kind == 2:
        body = pick("4", "5", "3", "6", "9") + digit(14)
        body += next(c for c in "0123456789" if luhn(body + c))
        gap = pick("", " ", "-", ".", " - ")
        return gap.join(body[i : i + 4] for i in range(0, 16, 4)), 2
    if kind == 3:
        a, b, c = digit(3), digit(3), digit(4)
        return pick(f"+{digit(1)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"0{digit(2)}/{digit(7)}", f"00{digit(2)} {digit(3)} {digit(6)}", f"+{digit(2)} {a} {b} {c}"), 3
    return pick(f"{digit(4)}-{digit(2)}-{digit(2)}", digit(int(rng.integers(1, 9))), f"{digit(1)}.{digit(1)}", f"v{digit(1)}.{digit(2)}.{digit(1)}", f"#{digit(6)}", f"{digit(2)}:{digit(2)}", f"{digit(3)},{digit(2)}", digit(20),
                "".join(pick(*"0123456789abcdef") for _ in range(40)), f"AKIA{digit(6)}{word().upper()}", f"at {word()} of", f"({word()}) {word()} dot", f"{digit(2)} x {digit(3)} x {digit(3)}", f"{word()}[{digit(1)}]"), -1


def training_set(texts: list[str], examples: int = 2400, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows of symbols with gold tags: base matches in their contexts, and written variants put into contexts."""
    rng = np.random.default_rng(seed)
    windows, gold = [], []

    def add(text: str, spans: list[tuple[int, int, int]], at_: int) -> None:
        tags = np.zeros(len(text) + 1, np.int8)
        for kind, a, b in spans:
            tags[a:b] = 2 + 2 * kind
            tags[a] = 1 + 2 * kind
        low = max(0, at_ - int(rng.integers(10, WIDTH - 20)))
        piece = text[low : low + WIDTH]
        ids = np.full(WIDTH, _BREAK, np.int16)
        ids[: len(piece)] = symbols(np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32))
        mine = np.zeros(WIDTH, np.int8)
        mine[: len(piece)] = tags[low : low + len(piece)]
        if mine[0] and mine[0] % 2 == 0:
            mine[0] -= 1
        windows.append(ids)
        gold.append(mine)

    for text in texts:
        found = base_spans(text)
        for _, a, _ in found[:3]:
            if len(windows) < examples // 2:
                add(text, found, a)
    contexts = [t for t in texts if len(t) > 2 * WIDTH] or ["the of and to in that is was for on with as it be by this " * 6]
    while len(windows) < examples:
        base = contexts[int(rng.integers(len(contexts)))]
        low = int(rng.integers(0, len(base) - WIDTH))
        left, right = base[low : low + WIDTH // 2], base[low + WIDTH // 2 : low + WIDTH]
        if base_spans(left + right) or re.search("[0-9@]", left + right):
            left, right = "the and that ", " of the in"
        shown, kind = _written(rng)
        left = (left.rsplit(" ", 1)[0] if " " in left else left) + ("tel: ", "call ", " ", " ", "\n", ": ")[int(rng.integers(6))]
        right = (" ", ". ", ", ", "\n", " ")[int(rng.integers(5))] + (right.split(" ", 1)[-1])
        add(left + shown + right, [(kind, len(left), len(left) + len(shown))] if kind >= 0 else [], len(left))
    return np.stack(windows), np.stack(gold)


def fit(docs: DataFrame, sample: int = 1500, steps: int = 320) -> Tagger:
    """A tagger trained from at most `sample` documents' labelled spans."""
    model = Tagger(SYMBOLS, 1 + 2 * len(KINDS))
    model.train(*training_set(sample_texts(docs, sample)), steps=steps)
    return model


def found_in(text: str, tags: np.ndarray, low: int, high: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and the spans that the tags add."""
    base, added = base_spans(text), []
    if not tags[low:high].any():
        return base, added
    taken = np.zeros(high - low + 1, bool)
    for _, a, b in base:
        taken[a:b] = True
    for kind, a, b in spans_of(tags, low, high):
        while a < b and text[a] in " \n\t.,;:":
            a += 1
        while b > a and text[b - 1] in " \n\t.,;:":
            b -= 1
        if a < b and not taken[a:b].any() and holds_up(kind, text[a:b]):
            added.append((kind, a, b))
    return base, added


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())])


def find_pii(docs: DataFrame, model: Tagger) -> DataFrame:
    """doc_id, spans: array of (kind, start, end, added) by kind as listed, then start; added marks spans beyond the base."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in at.chunks(batches, limit=1 << 20):
            texts = [chunk.text(i).decode(errors="replace") for i in range(chunk.rows.num_rows)]
            cuts = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
            points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
            tags = tag(model, points, cuts)
            rows = []
            for i, text in enumerate(texts):
                base, added = found_in(text, tags, int(cuts[i]), int(cuts[i + 1]))
                both = sorted({(k, a, b, False) for k, a, b in base} | {(k, a, b, True) for k, a, b in added})
                rows.append([{"kind": KINDS[k], "start": a, "end": b, "added": new} for k, a, b, new in both])
            yield pa.RecordBatch.from_arrays([chunk.rows.column(0), pa.array(rows, pa.list_(_SPAN))], names=["doc_id", "spans"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_arrow(texts, make, "doc_id long, spans array<struct<kind string, start long, end long, added boolean>>")


def digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Base counts by kind, the hash of the base spans and all spans as text."""
    line = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: ~s["added"])
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [count(k) for k in kinds]
    return found.select("doc_id", *counts, F.sha2(line(base), 256).alias("base_sha256"), line("spans").alias("spans"))


def pii(docs: DataFrame, sample: int = 1500) -> DataFrame:
    return digest(find_pii(docs, fit(docs, sample)), KINDS)
