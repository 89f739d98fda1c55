"""Source divergence against a plain version and its SQL; the transducer against a sorted list."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from refmart.llm import op11_divergence as op11
from refmart.llm.oracle import ORACLE
from refmart.llm.transducer import Transducer, _minimal

from .brute import lower_az

CLASHES = ("term", "n", "ord", "total", "v", "block", "item", "value", "rank", "part", "piece")
DDL = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASHES)


def plain(rows, min_docs=10, top=10):
    docs = [(la or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower_az(t))) for _, t, la, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [(s, w) for la, s, w in docs if la == lang]
        df = Counter(t for _, w in mine for t in set(w))
        kept = sorted((t for t, n in df.items() if n >= min_docs), key=str.encode)
        keep = set(kept)
        count = defaultdict(Counter)
        for s, w in mine:
            count[s].update(t for t in w if t in keep)
        every = sum(count.values(), Counter())

        def share(c):
            return [1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept]
        p, q = {s: share(c) for s, c in count.items()}, share(every)
        for s in count:
            pairs = [(sum((a - b) ** 2 // (a + b) for a, b in zip(p[s], p[o])), o) for o in count if o != s]
            terms = [((a - b) ** 2 // (a + b), t) for a, b, t in zip(p[s], q, kept) if count[s][t] and a > b]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(items, 1) if part == "pair" or r <= top]
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    vocab = ["".join(rng.choice("abcéß中") for _ in range(rng.randint(1, 7))) for _ in range(150)] + ["Ab", "aB", "ﬀ", "😀x"]
    out = [(i, rng.choice([" ", "1", "\n", "-"]).join(rng.choices(vocab, k=rng.randint(0, 80))), rng.choice(["en", "de"]),
            rng.choice(["s1", "s2", "S3", "é", ""])) for i in range(160)]
    out += [(300 + i, f"alone{i} same same", "xx", f"z{i % 3}") for i in range(6)]          # no kept terms
    out += [(None, "tie ties tied " * 3, None, None)] * 12 + [(400, None, None, "other"), (401, "", "yy", None)]
    out += [(402, "L" * 200_000 + " a", "en", "s1"), (402, "a b c", "en", "s1")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in rows], DDL).repartition(3)


def test_audit(docs, rows):
    got = op11.divergence_query(docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, got.collect())) == plain(rows)


def test_audit_in_many_small_pieces(docs, rows):
    got = op11.audit(docs, piece=7, block_bytes=1500, cells=35)
    assert Counter(map(tuple, got.collect())) == plain(rows)


def test_tasks_pass_counts_on_when_they_hold_many(rows, monkeypatch):
    batch = pa.RecordBatch.from_pylist([{"lang": la or "", "source": s or "", "text": t or ""} for _, t, la, s in rows])
    words = sorted({w for t in batch["text"] for w in op11.terms_of(t.as_buffer().to_pybytes())})[::2]
    tables = SimpleNamespace(value=[("en", n, Transducer(words[n * 50:n * 50 + 50]).dump())
                                    for n in range(-(-len(words) // 50))])

    def added(batches, *key):
        out, sizes = Counter(), []
        for b in batches:
            sizes.append(b.num_rows)
            for r in b.to_pylist():
                out[tuple(r[k] for k in key)] += r["n"]
        return out, len(sizes)

    def both():
        cut = [batch.select(["lang", "text"]).slice(i, 20) for i in range(0, len(batch), 20)]
        return (added(op11._document_frequencies(iter(cut)), "lang", "term"),
                added(op11._recount(iter([batch]), tables, 50), "lang", "source", "ord"))

    (df, one), (count, two) = both()
    for name in ("HELD_TERMS", "HELD_COUNTS", "SLICE_BYTES"):
        monkeypatch.setattr(op11, name, 100)
    (df2, many), (count2, more) = both()
    assert df2 == df and count2 == count and many > one and more > two
    assert sum(count.values()) == sum(w in set(words) for r in batch.to_pylist() if r["lang"] == "en"
                                      for w in op11.terms_of(r["text"].encode()))


def test_matches_sql(rows):
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"])
    with duckdb.connect() as db:
        db.register("documents", frame)
        assert Counter(db.execute(ORACLE["op11_source_divergence"]).fetchall()) == plain(rows)


def test_empty(spark):
    assert op11.divergence_query(spark.createDataFrame([], DDL)).collect() == []


def test_shares_do_not_overflow():
    total = np.array([9 * 10**15, 10**13 + 7, 5])
    count = np.array([9 * 10**15 - 2, 7 * 10**12, 1])
    want = [1 + 10**9 * (c + 2) // t for c, t in zip(count.tolist(), total.tolist())]
    assert op11.shares(count, total).tolist() == want


def test_transducer_orders_terms_and_is_minimal():
    rng = random.Random(4)
    for _ in range(100):
        terms = sorted({bytes(rng.choice(b"abc\xc3\xa9") for _ in range(rng.randint(1, 8)))
                        for _ in range(rng.randint(0, 80))})
        words = terms + [bytes(rng.choice(b"abc\xc3\xa9z") for _ in range(rng.randint(1, 9))) for _ in range(80)]
        text = np.frombuffer(b" ".join(words), np.uint8)
        length = np.array([len(w) for w in words])
        hit, ordinal = Transducer.load(Transducer(terms).dump()).walk(text, np.cumsum(length + 1) - length - 1, length)
        got = dict(zip(hit.tolist(), ordinal.tolist()))
        assert got == {i: terms.index(w) for i, w in enumerate(words) if w in terms}
        # minimal: as many nodes as there are different sets of endings
        endings = {frozenset(t[len(p):] for t in terms if t.startswith(p)) for t in [*terms, b""]
                   for p in [t[:k] for k in range(len(t) + 1)]}
        assert len(_minimal(terms)[0]) == len(endings)


def test_blocks_hold_no_more_than_the_bound():
    sizes = [("a", i, 30) for i in range(5)] + [("b", 0, 500), ("c", 0, 1)]
    blocks = op11.blocks_of(sizes, 100)
    assert [x for b in blocks for x in b] == [s[:2] for s in sizes]
    assert [len(b) for b in blocks] == [3, 2, 1, 1]
