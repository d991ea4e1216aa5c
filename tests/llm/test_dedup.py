"""Near-duplicates, substrings, decontamination: against brute force on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from plain import contamination_rows, near_duplicate_rows
from pyspark.sql import functions as F

from wayfold.llm import arrowtext as at
from wayfold.llm import decontaminate, minhash, substring
from wayfold.llm.graph import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, band long, size int"


def corpus(seed=0, n=60):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdeé"), rng.integers(1, 4)))
    bases = [[word() for _ in range(int(rng.integers(1, 120)))] for _ in range(8)]
    out = [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "one two"), (1004, "One  TWO"), (None, " ".join(bases[0])), (1005, "x" * 5000), (1006, " ".join(bases[1])), (1006, " ".join(bases[1]))]
    for i in range(n):
        w = list(bases[i % 8])
        for _ in range(int(rng.integers(0, 4))):
            w[int(rng.integers(len(w)))] = word()
        out.append((i, " ".join(w)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None, 7, 1) for i, t in rows], SCHEMA).repartition(3)


def test_words_and_hashes():
    text = "Ab ab é\x0bZ9-b  end".encode()
    data = np.frombuffer(text * 2, np.uint8)
    found = at.words(data, np.array([0, len(text), 2 * len(text)]), at.FOLDED)
    pieces = [text[a:b] for a, b in zip(found.starts[: len(found.starts) // 2], found.ends, strict=False)]
    assert pieces == text.split() and found.counts().tolist() == [len(pieces)] * 2
    assert found.hashes[0] != found.hashes[1] and (found.hashes[: len(pieces)] == found.hashes[len(pieces) :]).all()
    alnum = at.words(data[: len(text)], np.array([0, len(text)]), at.ALNUM)
    assert [text[a:b].decode() for a, b in zip(alnum.starts, alnum.ends, strict=True)] == re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.decode())


def test_long_word_has_the_same_hash_in_pieces():
    long_ = b"q" * (at._PIECE + 77)
    data = np.frombuffer(b"a " + long_ + b" " + long_, np.uint8)
    h = at.words(data, np.array([0, len(data)]), at.EXACT).hashes
    assert len(h) == 3 and h[1] == h[2] != h[0]


@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates(spark, n):
    rows = corpus(n)
    assert Counter(map(tuple, minhash.near_duplicates(frame(spark, rows), shingle=n).collect())) == near_duplicate_rows(rows, n)


def test_repeated_ids_are_judged_by_their_own_text(spark):
    a, b = ([f"{c}{i}" for i in range(60)] for c in "ab")
    near = lambda w: " ".join([*w[:-1], "x"])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (8, near(a)), (9, near(b)), (9, "alone with words of its own")]
    got = Counter(map(tuple, minhash.near_duplicates(frame(spark, rows), shingle=5).collect()))
    assert got == near_duplicate_rows(rows, 5) and {r[0] for r in got if r[3]} == {5, 9}


@pytest.mark.parametrize("block", [4, 512])
def test_hot_groups(spark, monkeypatch, block):
    """Large groups whose members share buckets but are not all close to one another: a chain, two sets of copies with words replaced, and texts that share
    most of a form without being near. Cut into many cells or in one, they give what brute force gives."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 100])) for i in range(60)]
    for k, edits in ((0, 4), (1, 9)):
        base = [f"b{k}-{i}" for i in range(120)]
        for i in range(60):
            w = list(base)
            for at_ in rng.integers(0, len(w), int(rng.integers(0, edits))):
                w[at_] = f"e{rng.integers(3)}"
            rows.append((1000 * (k + 1) + i, " ".join(w)))
    got = Counter(map(tuple, minhash.near_duplicates(frame(spark, rows), shingle=5).collect()))
    want = near_duplicate_rows(rows, 5)
    assert got == want and len({r[2] for r in want if r[0] < 60}) == 1 and len({r[2] for r in want if r[0] >= 2000}) > 3


def test_very_long_text(spark):
    long_ = " ".join(f"v{i % 70001}" for i in range(300_000))
    rows = [(1, long_), (2, long_ + " end"), (3, "w" * 2_000_000), (4, "w" * 2_000_000)]
    assert [r.component_id for r in minhash.near_duplicates(frame(spark, rows)).orderBy("doc_id").collect()] == [1, 1, 3, 3]


def test_estimate_counts_equal_low_bits(spark):
    plan = minhash.Plan(5)
    x, y = np.arange(1000, dtype=np.uint64), np.arange(100, 1100, dtype=np.uint64)
    pack = lambda s: ((minhash.minima(at.mix(s), plan) & np.uint64(15)).reshape(-1, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))[None]).sum(axis=1, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(pack(x), pack(y), pack(x))], "a array<long>, b array<long>, c array<long>")
    near, same = df.select(minhash.estimate(F.col("a"), F.col("b"), 128), minhash.estimate(F.col("a"), F.col("c"), 128)).first()
    assert same == 1.0 and abs(near - 900 / 1100) < 0.15


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (None, 3), (7, 7)], "a long, b long")
    labels = {r.node: r.label for r in components(edges).collect()}
    assert labels == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def removed(rows, n=13):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - n + 1):
            key = tuple(w[k : k + n])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if i is not None and first[tuple(w[k : k + n])] < i:
                gone[k : k + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_substring_dedup(spark):
    rows = corpus(3)
    assert Counter(map(tuple, substring.dedup(frame(spark, rows)).collect())) == removed(rows)
    kept = substring.kept_texts(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert Counter(hashlib.sha256(r.text.encode()).hexdigest() for r in kept.collect() if r.text) == Counter(x[3] for x in removed(rows).elements() if x[3] != hashlib.sha256(b"").hexdigest())


def test_hot_window_sends_one_entry_a_chunk(spark):
    """A line of 4000 documents: its bucket gets one entry a chunk, the copies travel as flags by block, and the result is whole."""
    line = " ".join(f"line{k}" for k in range(13))
    rows = [(i, f"own{i} {line} end{i}") for i in range(4000)]
    layout = substring.Layout(8)
    runs = substring.batch_runs(frame(spark, rows).repartition(4), 13, layout, blocks=256).collect()
    codes = Counter(r.bucket for r in runs if r.kind == substring.FIRST for _ in range(len(r.keys) // 4))
    flags = Counter(r.block for r in runs if r.kind == substring.FLAG for _ in range(len(r.keys) // 8))
    assert sum(codes.values()) == 2 * 4000 + 4 and sum(flags.values()) == 4000 - 4 and max(flags.values()) < 100
    got = Counter(map(tuple, substring.dedup(frame(spark, rows)).collect()))
    assert got == removed(rows)


def test_substring_in_long_and_clashing(spark):
    long_ = " ".join(f"v{i % 50021}" for i in range(200_000))
    rows = [(2, long_), (1, "z" * 2_000_000), (3, " ".join(long_.split()[777:900])), (3, "a  b\tc " * 30)]
    clash = frame(spark, rows).selectExpr("*", "1 AS bucket", "2 AS block", "3 AS kind", "4 AS n_words")
    assert Counter(map(tuple, substring.dedup(clash).collect())) == removed(rows)


def test_incremental_equals_whole(spark, tmp_path):
    rows = [r for r in corpus(5) if r[0] is not None]
    rows.sort(key=lambda r: r[0])
    batches = [[r for r in rows if k <= r[0] < k + 15] for k in range(0, 60, 15)] + [[r for r in rows if r[0] >= 60]]
    got = Counter()
    for k, batch in enumerate(batches):
        index = substring.FingerprintIndex(spark, f"{tmp_path}/index", expected_bytes=1 << 20, fanout=2)
        got += Counter(map(tuple, index.add(frame(spark, batch), f"{tmp_path}/out{k}").collect()))
    assert got == removed(rows)
    assert len(index.runs) <= 2


def test_decontamination(spark):
    rows = corpus(8)
    items = [(1, " ".join(rows[20][1].split()[:25]).upper()), (2, "one two"), (3, None), (4, " - "), (5, rows[30][1]), (5, rows[30][1]), (None, rows[31][1]), (10, rows[20][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = contamination_rows(rows, items)
    assert Counter(map(tuple, decontaminate.decontaminate(frame(spark, rows), bench).collect())) == want
    assert Counter(map(tuple, decontaminate.digest(decontaminate.matches(frame(spark, rows), bench, block=200)).collect())) == want
    assert not decontaminate.decontaminate(frame(spark, rows), bench.limit(0)).where("contaminated").count()


def test_decontamination_of_long_and_no_documents(spark):
    words = [f"v{i % 30011}" for i in range(400_000)]
    bench = spark.createDataFrame([(1, " ".join(words[200_000:200_020]))], "item_id long, text string")
    rows = [(1, " ".join(words)), (2, "z" * 3_000_000), (3, "a-b " * 10)]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.decontaminate(frame(spark, rows), bench).collect()}
    found = [k for k in range(len(words) - 12) if words[k : k + 13] in [words[200_000 + j : 200_013 + j] for j in range(8)]]
    assert got == {1: (400_000, len({k + j for k in found for j in range(13)}), 1), 2: (1, 0, 0), 3: (20, 0, 0)}
    assert decontaminate.decontaminate(frame(spark, rows).limit(0), bench).count() == 0


def test_proximity(spark):
    words = [f"t{i}" for i in range(30)]
    bench = decontaminate.Windows([(1, " ".join(words[:13]))], 13)
    near = [w for k, w in enumerate(words[:13]) if k not in (3, 7)]
    docs = spark.createDataFrame([(1, "pad " + " ".join(words[:13])), (2, " ".join(near)), (3, " ".join(reversed(words[:13])))], "doc_id long, text string")
    index = decontaminate.build_index(docs)
    found = {(r.doc_id, r.item_id) for r in decontaminate.proximity(index, bench, terms=13, slack=5).collect()}
    assert found == {(1, 1)}
    assert {r.doc_id for r in decontaminate.proximity(index, bench, terms=3, slack=5).collect()} == {1, 2}


def test_proximity_with_replaced_words(spark):
    """A passage with replaced words is found, however the rows are dealt to segments."""
    words = [f"t{i}" for i in range(30)]
    bench = spark.createDataFrame([(1, " ".join(words[:13])), (2, "u v w")], "item_id long, text string")
    windows = next(decontaminate.item_blocks(bench, 13))
    near = [w if k not in (3, 7) else "other" for k, w in enumerate(words[:13])]
    rows = [(1, "pad " + " ".join(words[:13])), (2, " ".join(near)), (3, " ".join(reversed(words[:13]))), (4, None), (None, "u v x w"), (5, " ".join(words[:6])), (6, " ".join(words[6:13]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [{(r.doc_id, r.item_id) for r in decontaminate.proximity(decontaminate.build_index(docs.repartition(k)), windows, terms=3, slack=5).collect()} for k in (1, 7)]
    assert found[0] == found[1] and {d for d, i in found[0] if i == 1} >= {1, 2} and 3 not in {d for d, _ in found[0]} and (None, 2) in found[0]
    assert {(1, 1), (2, 1), (None, 2)} <= {(r.doc_id, r.item_id) for r in decontaminate.near_matches(docs, bench).collect()}
    blocks = decontaminate.near_matches(docs, bench, block=20).collect()
    assert {tuple(r) for r in blocks} == {tuple(r) for r in decontaminate.near_matches(docs, bench).collect()}
    assert decontaminate.near_matches(docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("f", [minhash.near_duplicates, substring.dedup])
def test_empty(spark, f):
    assert f(frame(spark, corpus()).limit(0)).count() == 0
