"""Toxicity scores by Levenshtein automata over a learned lexicon, with context windows.

Learning (driver, at most `sample` labelled documents, the smallest xxhash64 of their doc_id): words and word beginnings that occur
almost only in documents labelled toxic make the lexicon, all of them (a word has 3 to 40 letters). Its trie is intersected with Levenshtein automata (one error from five letters
on, two from nine on) and made deterministic, in parts of `PART` terms, since states multiply with the terms of a part: a part is one table over
(state, letter class) that runs over the distinct words of a chunk in step, a letter at a time, and drops words whose state is dead. A hit is exact, misspelled, or a word that begins with a learned beginning.

Each hit looks at a window of words around it: between an opening and a closing quotation mark, or near a verb of reporting, it counts as quotation, else
as abuse; other hits near it strengthen it. Counts of each sort are the features of a logistic regression
fitted on the same sample. Texts are scored whole, in one pass without a shuffle; tables and weights are bounded by the sample.

Defined cases: null and empty texts get the score of a text without hits; a null doc_id is scored, never held out, and not learned from;
documents with several labels are learned from once for each; without labels of both kinds every score is 0. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm import arrowtext as at
from wayfold.llm.common import in_arrow, within
from wayfold.llm.langid import held_out

PART, WINDOW = 16, 8
EXACT, MISSPELLED, BEGINNING = 1, 2, 3
_QUOTES = "\"“”„«»‹›"
_REPORTING = ("said", "says", "wrote", "writes", "called", "quoted", "quote", "dijo", "escribió", "sagte", "schrieb", "écrit")

_LETTER = np.array([chr(c).isalnum() for c in range(0x3000)])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def word_spans(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of letters and digits."""
    inside = np.ones(len(points), bool)
    low = points < len(_LETTER)
    inside[low] = _LETTER[points[low]]
    edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class Automaton(NamedTuple):
    letters: np.ndarray  # code points of classes 1, 2, ..., ascending; 0 is any other letter
    table: np.ndarray  # state x class -> state; state 0 is dead, 1 the start
    kind: np.ndarray  # of a word that ends in the state: 0, EXACT, MISSPELLED or BEGINNING
    weight: np.ndarray  # learned weight of the best term of the state
    direct: np.ndarray | None  # class by code point, the last one for all beyond; None if a letter lies beyond

    def classes(self, points: np.ndarray) -> np.ndarray:
        if self.direct is not None:
            return self.direct[np.minimum(points, len(self.direct) - 1)]
        slot = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[slot] == points, slot + 1, 0)


def errors_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


def automaton(words: dict[str, float], beginnings: dict[str, float]) -> Automaton:
    """The deterministic product of the lexicon's trie and the Levenshtein automata of its terms."""
    children: list[dict[str, int]] = [{}]
    ends: list[dict[str, tuple[str, float]]] = [{}]
    reach: list[int] = [0]  # most errors that a term below the node allows
    for sort, terms in (("word", words), ("beginning", beginnings)):
        for term, weight in sorted(terms.items()):
            node, allowed = 0, errors_allowed(term) if sort == "word" else 0
            reach[0] = max(reach[0], allowed)
            for letter in term:
                if letter not in children[node]:
                    children[node][letter] = len(children)
                    children.append({})
                    ends.append({})
                    reach.append(0)
                node = children[node][letter]
                reach[node] = max(reach[node], allowed)
            ends[node][sort] = (term, weight)
    letters = sorted({c for kids in children for c in kids})

    def close(states: dict[int, int]) -> frozenset[tuple[int, int]]:
        """Fewest errors by node, after leaving out letters of terms."""
        todo = list(states.items())
        while todo:
            node, e = todo.pop()
            for kid in children[node].values():
                if e + 1 <= reach[kid] and states.get(kid, 99) > e + 1:
                    states[kid] = e + 1
                    todo.append((kid, e + 1))
        return frozenset(states.items())

    def begun(states: frozenset[tuple[int, int]]) -> float:
        return max((ends[n]["beginning"][1] for n, e in states if e == 0 and "beginning" in ends[n]), default=0.0)

    def verdict(states: frozenset[tuple[int, int]], head: float) -> tuple[int, float]:
        whole = [(e, ends[n]["word"][1]) for n, e in states if "word" in ends[n] and e <= errors_allowed(ends[n]["word"][0])]
        exact, near = [w for e, w in whole if e == 0], [w for e, w in whole if e]
        return (EXACT, max(exact)) if exact else (BEGINNING, head) if head else (MISSPELLED, max(near)) if near else (0, 0.0)

    start = (close({0: 0}), 0.0)
    known, table, kinds, weights, i = {start: 1}, [[0] * (len(letters) + 1)], [0], [0.0], 0
    queue = [start]
    while i < len(queue):
        states, head = queue[i]
        i += 1
        row = []
        for c in (None, *letters):
            after: dict[int, int] = {}
            for node, e in states:
                for letter, kid in children[node].items():
                    cost = e + (letter != c)
                    if cost <= reach[kid] and after.get(kid, 99) > cost:
                        after[kid] = cost
                if e + 1 <= reach[node] and after.get(node, 99) > e + 1:
                    after[node] = e + 1
            closed = close(after)
            target = (closed, max(head, begun(closed)))
            if not closed and not target[1]:
                row.append(0)
                continue
            if target not in known:
                known[target] = len(known) + 1
                queue.append(target)
            row.append(known[target])
        table.append(row)
        kind, weight = verdict(states, head)
        kinds.append(kind)
        weights.append(weight)
    points, direct = np.array([ord(c) for c in letters], np.uint32), None
    if not len(points) or points[-1] < len(_LETTER):
        direct = np.zeros(len(_LETTER) + 1, np.int32)
        direct[points] = np.arange(1, len(points) + 1)
    return Automaton(points, np.array(table, np.int32), np.array(kinds, np.int8), np.array(weights), direct)


def run(automaton_: Automaton, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The state after each word, 0 if dead."""
    state = np.ones(len(starts), np.int32)
    if not len(automaton_.letters):
        return np.zeros(len(starts), np.int32)
    moves, width = automaton_.table.ravel(), automaton_.table.shape[1]
    live, now, at_ = np.arange(len(starts)), state.copy(), starts
    while len(live):
        over = at_ >= ends[live]
        if over.any():
            state[live[over]] = now[over]
            live, now, at_ = live[~over], now[~over], at_[~over]
        now = moves[now * width + automaton_.classes(points[at_])]
        alive = now > 0
        state[live[~alive]] = 0
        live, now, at_ = live[alive], now[alive], at_[alive] + 1
    return state


def automata(words: dict[str, float], beginnings: dict[str, float], part: int = PART) -> list[Automaton]:
    """The lexicon's automata, of at most `part` terms each; neighbours in the alphabet share a part and so their tries' nodes."""
    names, heads = sorted(words), sorted(beginnings)
    out = [automaton({w: words[w] for w in names[i : i + part]}, {}) for i in range(0, len(names), part)]
    return out + [automaton({}, {h: beginnings[h] for h in heads[i : i + part]}) for i in range(0, len(heads), part)]


def distinct_words(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct word one place, and of each word its distinct word, by 64-bit hashes: sums of mixed letters times powers of an odd number."""
    powers = np.full(len(points), 0x9E3779B97F4A7C15, np.uint64).cumprod(dtype=np.uint64)
    inverse = np.full(len(points), pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64).cumprod(dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(at.mix(points.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)))
    hashes = at.mix((sums[ends] - sums[starts]) * inverse[starts]) + (ends - starts).astype(np.uint64)
    _, place, which = np.unique(hashes, return_index=True, return_inverse=True)
    return place, which


def hits_of(parts: Automaton | list[Automaton], points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kind and weight of each word: exact before beginning before misspelled, as in one automaton of all terms, and the largest weight of the kind."""
    place, which = distinct_words(points, starts, ends)
    starts, ends = starts[place], ends[place]
    kind, weight, rank = np.zeros(len(place), np.int8), np.zeros(len(place)), np.array([0, 3, 1, 2])
    for part in [parts] if isinstance(parts, Automaton) else parts:
        state = run(part, points, starts, ends)
        k, w = part.kind[state], part.weight[state]
        better = (rank[k] > rank[kind]) | (k == kind) & (w > weight)
        kind[better], weight[better] = k[better], w[better]
    return kind[which], weight[which]


FEATURES = ("abuse exact", "abuse misspelled", "abuse beginning", "quotation", "weight", "share of words", "together")


def quote_marks(points: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of quotation marks, and which of them can open and which can close: the ones whose shape says so, and straight ones by what stands beside them."""
    marks = np.flatnonzero(np.isin(points, [ord(q) for q in _QUOTES]))
    shape = points[marks]
    beside = np.concatenate(([0x20], points, [0x20]))
    edge = np.isin(marks, cuts)  # the first character of a text
    inner = ~np.isin(marks + 1, cuts)
    letter = lambda c: np.where(c < len(_LETTER), _LETTER[np.minimum(c, len(_LETTER) - 1)], True)
    before, after = letter(beside[marks]) & ~edge, letter(beside[marks + 2]) & inner
    closed_text = (beside[marks] > 0x20) & ~edge
    straight = shape == 0x22
    opens = np.where(straight, after & ~before, ~np.isin(shape, [ord(q) for q in "”»›"]))
    closes = np.where(straight, closed_text & ~after, ~np.isin(shape, [ord(q) for q in "„«‹"]))
    return marks, opens, closes


class Model(NamedTuple):
    automata: list[Automaton]
    scale: np.ndarray
    weights: np.ndarray
    bias: float


def features(parts: Automaton | list[Automaton], points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text; cuts are the texts' offsets in code points. Texts are separated by their cuts only."""
    out = np.zeros((len(cuts) - 1, len(FEATURES)))
    starts, ends = word_spans(points)
    inner = cuts[1:-1][(cuts[1:-1] > 0) & (cuts[1:-1] < len(points))]
    whole = np.searchsorted(starts, inner, "left")
    split = inner[(whole > 0) & (ends[np.maximum(whole - 1, 0)] > inner) & (starts[np.maximum(whole - 1, 0)] < inner)] if len(starts) else inner[:0]
    if len(split):  # a word that runs over the end of a text is two
        starts, ends = np.sort(np.append(starts, split)), np.sort(np.append(ends, split))
    if not len(starts):
        return out
    kind, weight = hits_of(parts, points, starts, ends)
    hits = np.flatnonzero(kind)
    if not len(hits):
        return out
    first = np.searchsorted(starts, cuts)
    doc = np.searchsorted(first, hits, "right") - 1
    words = np.maximum(np.diff(first), 1)
    # the marks nearest to the hit inside its window decide: one that opens before it, one that closes after it
    left, right = starts[np.maximum(hits - WINDOW, first[doc])], ends[np.minimum(hits + WINDOW, first[doc + 1] - 1)]
    marks, opens, closes = quote_marks(points, cuts)
    quoted = np.zeros(len(hits), bool)
    if len(marks):
        after = np.searchsorted(marks, ends[hits])
        before = np.maximum(np.searchsorted(marks, starts[hits]) - 1, 0)
        behind = np.minimum(after, len(marks) - 1)
        quoted = opens[before] & (marks[before] < starts[hits]) & (marks[before] >= np.maximum(left - 1, cuts[doc]))
        quoted &= closes[behind] & (marks[behind] >= ends[hits]) & (marks[behind] <= right + 1) & (marks[behind] < cuts[doc + 1])
    for i in np.flatnonzero(~quoted).tolist():
        h, low, high = hits[i], max(first[doc[i]], hits[i] - WINDOW), min(first[doc[i] + 1], hits[i] + WINDOW + 1)
        if high - low > 1:
            near = "".join(map(chr, points[starts[low] : ends[h]].tolist())).split()
            quoted[i] = any(w.strip(",.:;!?") in _REPORTING for w in near)
    together = np.zeros(len(hits))
    beside = (np.diff(hits) <= 3 * WINDOW) & (np.diff(doc) == 0)  # of neighbouring hits, whether they are near each other in one text
    together[1:] += beside
    together[:-1] += beside
    for column, mask in enumerate((~quoted & (kind[hits] == EXACT), ~quoted & (kind[hits] == MISSPELLED), ~quoted & (kind[hits] == BEGINNING), quoted)):
        out[:, column] = np.log1p(np.bincount(doc[mask], minlength=len(out)))
    weight = weight[hits]
    out[:, 4] = np.log1p(np.bincount(doc, weight, minlength=len(out)))
    out[:, 5] = np.sqrt(np.bincount(doc, minlength=len(out)) / words)
    out[:, 6] = np.log1p(np.bincount(doc, together, minlength=len(out)))
    return out


def lexicon(texts: list[tuple[str, int]], least: int = 3, purity: float = 0.8) -> tuple[dict[str, float], dict[str, float]]:
    """Words and word beginnings (4 to 8 letters) of toxic texts, with log-odds weights.

    Every term is taken that occurs in `least` toxic texts and of whose texts at least four fifths are toxic, however many there are. A beginning must
    have several continuations and stands for all words below it. Only terms of toxic texts are counted in the others."""

    def words_of(text: str) -> set[str]:
        starts, ends = word_spans(code_points(text))
        return {text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if b - a <= 40}

    heads_of = lambda w: (w[:k] for k in range(4, min(len(w), 8) + 1))
    bad, heads_bad, kinds, n_bad = Counter(), Counter(), Counter(), 0
    for text, label in texts:
        if label:
            mine = words_of(text)
            n_bad += 1
            bad.update(mine)
            heads_bad.update({h for w in mine for h in heads_of(w)})
    for w in bad:
        kinds.update(heads_of(w))
    words = {w: n for w, n in bad.items() if n >= least and len(w) > 2}
    heads = {h: n for h, n in heads_bad.items() if n >= 2 * least and kinds[h] >= 6}
    good, heads_good = Counter(), Counter()
    for text, label in texts:
        if not label:
            mine = words_of(text)
            good.update(w for w in mine if w in words)
            heads_good.update({h for w in mine for h in heads_of(w) if h in heads})
    n_good = len(texts) - n_bad
    rate = lambda b, g: float(np.log((b + 0.5) / (n_bad + 1)) - np.log((g + 0.5) / (n_good + 1)))
    pure = lambda mine, others: {t: rate(n, others[t]) for t, n in sorted(mine.items()) if n >= purity * (n + others[t])}
    return pure(words, good), pure(heads, heads_good)


def regress(x: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression by Newton steps with a ridge."""
    scale = np.maximum(x.std(axis=0), 1e-6)
    z = np.column_stack((x / scale, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    ridge = np.eye(len(w)) * 1.0
    ridge[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return scale, w[:-1], float(w[-1])


def learn(texts: list[tuple[str, int]]) -> Model | None:
    """From (text, label) pairs: the lexicon first, then the weights of the features that it gives."""
    texts = [(t.lower(), label) for t, label in texts]
    if len({label for _, label in texts}) < 2:
        return None
    parts, rows = automata(*lexicon(texts)), []
    for i in range(0, len(texts), 256):
        some = [t for t, _ in texts[i : i + 256]]
        rows.append(features(parts, code_points("".join(some)), np.concatenate(([0], np.cumsum([len(t) for t in some]))).astype(np.int64)))
    rows = np.concatenate(rows)
    return Model(parts, *regress(rows, np.array([label for _, label in texts], float)))


def _scores(chunk: at.Chunk, model: Model | None) -> np.ndarray:
    n = chunk.rows.num_rows
    if model is None:
        return np.zeros(n)
    texts = [chunk.text(i).decode(errors="replace").lower() for i in range(n)]
    x = features(model.automata, code_points("".join(texts)), np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64))
    return 1 / (1 + np.exp(-np.clip((x / model.scale) @ model.weights + model.bias, -30, 30)))


def score_texts(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in at.chunks(batches, limit=1 << 20):
            yield pa.RecordBatch.from_arrays([chunk.rows.column(0), pa.array(_scores(chunk, model))], names=["doc_id", "score"])

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), make, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """The documents that score under `least`, all columns unchanged."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in at.chunks(batches, limit=1 << 20):
            yield chunk.rows.filter(pa.array(_scores(chunk, model) < least))

    return in_arrow(docs, make, docs.schema)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 6000, divisor: int = 5, remainder: int = 0) -> Model | None:
    """Learns from at most `sample` labelled documents outside the held-out part, SAMPLE_BYTES of text at most."""
    usable = labels.where(~held_out(divisor, remainder)).where("doc_id IS NOT NULL AND toxic IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = [(r.doc_id, r.toxic) for r in usable.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample).collect()]
    if not rows:
        return None
    chosen = docs.sparkSession.createDataFrame(rows, "doc_id long, toxic int")
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).where("text IS NOT NULL").withColumn("text_hash", F.xxhash64("text"))
    sizes = texts.select("doc_id", "text_hash", F.octet_length("text").alias("bytes")).join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic", "text_hash").limit(sample).collect()
    fitting = [(r.doc_id, r.toxic, r.text_hash) for r, fits in zip(sizes, within([r.bytes for r in sizes]), strict=True) if fits]
    if not fitting:
        return None
    chosen = docs.sparkSession.createDataFrame(fitting, "doc_id long, toxic int, text_hash long").distinct()
    found = texts.join(F.broadcast(chosen), ["doc_id", "text_hash"]).collect()
    return learn([(r.text, r.toxic) for r in sorted(found, key=lambda r: (r.doc_id, r.toxic, r.text))][:sample])


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 6000) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score_texts(docs, fit(docs, labels, sample))
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
