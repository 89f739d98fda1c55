"""Periodic runs against a quadratic version, the range successor against a scan, odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from refmart.llm import op12_runs as op12

CLASHES = ("id", "start", "length", "period", "runs", "n_runs", "words")
DDL = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHES)


def plain_runs(words):
    """All runs by trying every period at every place."""
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


@pytest.mark.parametrize("kind", range(4))
def test_runs_match_all_periods(kind):
    rng = random.Random(kind)
    for _ in range(400):
        n = rng.randint(1, 130)
        if kind == 0:
            s = [rng.randint(0, 1) for _ in range(n)]
        elif kind == 1:
            s = [x for _ in range(5) for x in [rng.randint(0, 2) for _ in range(rng.randint(1, 20))] * rng.randint(1, 6)]
        elif kind == 2:
            s, b = [0], [0, 1]
            for _ in range(rng.randint(3, 9)):
                s, b = b, b + s
        else:
            s = ([0] * rng.randint(1, 40) + [1]) * rng.randint(1, 6) + [0] * rng.randint(0, 30)
        ids = np.unique(np.array(s), return_inverse=True)[1]
        assert [tuple(r) for r in op12.runs(ids).tolist()] == plain_runs(s), s


def test_batches_keep_documents_apart():
    texts = [["a"] * 8, ["a"] * 8, [], ["b", "a"] * 7, ["b"], ["b", "a"] * 7]
    got = op12.batch_runs(texts, [None] * len(texts))
    assert [g.tolist() for g in got] == [[], [], [], [[0, 14, 2]], [], [[0, 14, 2]]]


def test_range_successor():
    rng = np.random.default_rng(2)
    values = rng.permutation(500)
    tree = op12.WaveletTree(values, 9)
    low = rng.integers(0, 500, 2000)
    high = np.minimum(500, low + rng.integers(0, 60, 2000))
    value = rng.integers(0, 520, 2000)
    want = [min((v for v in values[a:b] if v >= x), default=-1) for a, b, x in zip(low, high, value)]
    assert tree.successor(low, high, value).tolist() == want


def test_names_tell_how_far_places_agree():
    s = [0, 1, 0, 1, 0, 0, 1, 0, 1, 0, 0, 1]
    names = op12.Names(np.array(s))
    assert names.suffix.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
    pairs = [(i, j) for j in range(len(s)) for i in range(j)]
    a, b = (np.array(x) for x in zip(*pairs))
    fore = [next((k for k in range(len(s) - j) if s[i + k] != s[j + k]), len(s) - j) for i, j in pairs]
    back = [next((k for k in range(i) if s[i - 1 - k] != s[j - 1 - k]), i) for i, j in pairs]
    assert names.ahead(a, b).tolist() == fore and names.behind(a, b).tolist() == back


def test_work_stays_small_on_one_repeated_word():
    assert op12.runs(np.zeros(100_000, np.int64)).tolist() == [[0, 100_000, 1]]


def test_query(spark, monkeypatch):
    rng = random.Random(11)
    vocab = ["w", "é中", "x y", "😀", "a", "b"]
    rows = [(None, "z " * 20), (None, None), (1, None), (2, ""), (3, " \n\t\x0b\x0c\r "), (4, "one"), (5, "a b " * 9),
            (5, "a b " * 9), (5, "c d e " * 4 + "c"), (-7, "no run here at all"), (2**63 - 1, "q " * 30),
            (6, " ".join(f"v{i % 251}" for i in range(3000))), (7, "A a " * 5 + "A a a")]
    rows += [(100 + i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 200)))) for i in range(120)]
    rows += [(400 + i, "\n".join(f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 300)))) for i in range(60)]
    df = spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in rows], DDL).repartition(3)
    got = Counter(map(tuple, op12.runs_query(df).collect()))
    assert got == Counter(plain_row(*r) for r in rows)
    monkeypatch.setattr(op12, "BATCH_WORDS", 50)     # documents longer than a batch
    assert Counter(map(tuple, op12.runs_query(df).collect())) == got
    assert sum(r[1] for r in got) >= 15
    assert op12.runs_query(spark.createDataFrame([], DDL)).collect() == []


def test_detect_without_planted_repeats(spark):
    df = spark.createDataFrame([(20, "x y z " * 6), (21, "x y z")], "doc_id long, text string")
    got = {r.doc_id: r for r in op12.detect(df).collect()}
    assert [tuple(x) for x in got[20].runs] == [(0, 18, 3)] and got[20].n_kept == 3
    assert got[21].runs == [] and got[21].n_kept == 3
