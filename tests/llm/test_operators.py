"""Each operator against a plain version, and over awkward tables: nulls in any column, empty
and very long texts, ties and repeated rows, empty tables, extra columns with clashing names."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from refmart.llm.oracle import ORACLE
from refmart.llm import (common, op1_training_order, op2_quality, op3_sentencepiece, op4_suffix_dedup, op5_pii,
                         op6_warc, op7_decontaminate, op8_simhash, op9_licenses, op10_lm_score)

from . import brute

# Names that the operators use inside; as columns of the input they must not matter.
CLASHES = ("k_id", "k_hash", "k_text", "q", "q_words", "fail_bits", "n_words", "w", "at", "spans", "ids", "chunk",
           "blob", "fp", "component", "n", "shard", "record", "range", "window", "items", "score")
DDL = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHES)
LONG = " ".join(f"word{i % 977}" for i in range(20_000))
NOTE = "the quick brown fox jumps over the lazy dog and then runs far away from the noisy crowd again"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(5)
    rows = [(1, ""), (2, None), (3, "  \n\t "), (4, LONG), (5, LONG), (6, NOTE), (6, NOTE), (7, NOTE + " " + NOTE),
            (None, NOTE), (None, None), (8, "a"), (9, "X" * 5000), (10, "no▁such blank 中文 😀\r\n end ")]
    rows += [(20 + i, words(rng, 40) + "\n" + NOTE[: 10 + 5 * i] + "\n" + words(rng, 30)) for i in range(16)]
    return rows


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame([(i, t, *["x"] * len(CLASHES)) for i, t in odd_rows], DDL).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def got(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


# --- 1: training order

def test_training_order_round_trip(spark, odd, odd_rows):
    path = common.shared_path(spark, "t1")
    op1_training_order.write(odd, path, key=9, shard_text=200_000)
    rows = sorted(op1_training_order.read(spark, path, True).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert all(r.byte_offset == r.row * op1_training_order.STRIDE for r in rows)
    plan, _ = op1_training_order.order(odd, 9)
    at = plan.permute(np.array([plan.number(r.doc_id, r.place) for r in rows]))
    assert (np.diff(at) >= 0).all() and len({r.shard for r in rows}) > 1
    bpe = op1_training_order.Encoder().bpe
    parts = Counter((r.doc_id, r.place, tuple(r.ids)) for r in rows)
    want = Counter()
    for i, t in odd_rows:
        ids = [*bpe.encode_ordinary(t or ""), op1_training_order.END]
        for p, a in enumerate(range(0, len(ids), op1_training_order.LENGTH)):
            want[i, p, tuple(ids[a:a + op1_training_order.LENGTH])] += 1
    assert parts == want


def test_training_order_empty(spark, empty):
    assert op1_training_order.training_order_query(empty).count() == 0


@pytest.mark.parametrize("text", ["a b", " a  b\n c ", "x\n\n  y", "it's  we'll\t go", "a  b", " ", "12 345  6"])
def test_words_encode_like_whole_texts(text):
    e = op1_training_order.Encoder()
    assert np.frombuffer(e.encode(text), "<u2").tolist() == e.bpe.encode_ordinary(text)


@pytest.mark.parametrize("ids,most", [(0, 1), (1, 1), (7, 3), (100, 13)])
def test_permutation(ids, most):
    plan = op1_training_order.Order(0, ids, most, 4)
    out = plan.permute(np.arange(plan.size))
    assert sorted(out) == list(range(plan.size))
    if plan.size > 50:
        assert (out != op1_training_order.Order(0, ids, most, 5).permute(np.arange(plan.size))).any()


@pytest.mark.parametrize("lowest,ids,most,copies", [(0, 100, 13, 5), (-2**62, 2**63, 4, 1), (-2**63, 2**64, 4000, 1 << 20)])
def test_permutation_of_wide_ids(lowest, ids, most, copies):
    """Ids spread over all 64 bits: numbers beyond a long stay whole, distinct and inside the domain."""
    plan = op1_training_order.Order(lowest, ids, most, 4, copies)
    rng = random.Random(3)
    numbers = sorted({plan.number(rng.choice([None, rng.randrange(lowest, lowest + ids)]), rng.randrange(most),
                                  rng.randrange(copies)) for _ in range(3000)} | {0, plan.size - 1})
    out = [int(x) for x in plan.permute(numbers)]
    assert len(set(out)) == len(numbers) and 0 <= min(out) and max(out) < plan.size
    assert abs(sum(x * 2 > plan.size for x in out) / len(out) - 0.5) < 0.1        # spread over the domain
    top, low = plan.split(numbers)
    assert [(int(t) << plan.shift) | int(x) for t, x in zip(top, low)] == out and top.min() >= 0


def test_training_order_of_hashed_null_and_repeated_ids(spark):
    """Hashed ids; a third of the rows without an id, a third with one id and text: whole, and in no one shard."""
    ids = spark.range(0, 3000, 1, 4)
    docs = ids.select(
        F.when(F.col("id") % 3 == 0, F.xxhash64("id")).when(F.col("id") % 3 == 1, F.lit(7)).alias("doc_id"),
        F.when(F.col("id") % 3 == 1, F.lit(NOTE)).otherwise(F.concat(F.lit("row "), F.col("id").cast("string"))).alias("text"))
    path = common.shared_path(spark, "t1")
    op1_training_order.write(docs, path, key=3, shard_text=6000, copies=1 << 12)
    out = op1_training_order.read(spark, path, True)
    rows = sorted(out.collect(), key=lambda r: r.slot)
    bpe = op1_training_order.Encoder().bpe
    want = Counter((r.doc_id, *bpe.encode_ordinary(r.text), op1_training_order.END) for r in docs.collect())
    assert Counter((r.doc_id, *r.ids) for r in rows) == want
    assert [r.slot for r in rows] == list(range(3000))
    shards = Counter(r.shard for r in rows)
    assert len(shards) > 10 and max(shards.values()) < 2 * 3000 / len(shards)
    for kind in (None, 7):      # neither the rows without an id nor the repeats lie together
        assert 0.25 < sum(r.doc_id == kind for r in rows[:1000]) / 1000 < 0.42
    # a run resumes at any slot
    for slot in (0, 1, 1234, 2999, 3000, 9999):
        rest = op1_training_order.read(spark, path, True, from_slot=slot).collect()
        assert sorted(rest, key=lambda r: r.slot) == rows[slot:]


# --- 2: quality rules

def test_quality_rules(odd, odd_rows, empty):
    import re
    want = Counter()
    for i, t in odd_rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        again = {k + d for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want[i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again),
             len(w) < 50 or 100 * len(again) > 50 * len(w)] += 1
    out = op2_quality.quality_query(odd)
    assert got(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
               "base_failed") == want
    assert out.where("base_failed and kept").count() == 0
    assert op2_quality.quality_query(empty).count() == 0


def test_policy_keeps_rows_and_ablations_add_up(odd, empty):
    kept = op2_quality.apply_policy(odd, "base")
    assert kept.columns == odd.columns
    assert kept.count() == op2_quality.quality_query(odd).where("not base_failed").count()
    assert op2_quality.apply_policy(empty).count() == 0
    book = op2_quality.ledger(odd).cache()
    rows = {(r.policy, r.rule): r for r in op2_quality.ablations(book).collect()}
    assert rows["v2", "few_words"].rejected == book.where("fail_bits <> 0").count()
    assert rows["base", "few_words"].rejected_by_rule_alone == book.where("fail_bits & 3 = 1").count()


# --- 3: SentencePiece

def test_sampled_pieces_are_lossless_and_reproducible(odd, odd_rows, empty):
    out = op3_sentencepiece.summary(odd).cache()
    assert out.where("not lossless").count() == 0 and out.count() == len(odd_rows)
    again = op3_sentencepiece.summary(odd.repartition(7, "text"))
    assert got(out, "doc_id", "ids_sha256") == got(again, "doc_id", "ids_sha256")
    other = op3_sentencepiece.summary(odd, seed=2)
    assert got(out, "doc_id", "ids_sha256") != got(other, "doc_id", "ids_sha256")
    assert op3_sentencepiece.summary(empty).count() == 0
    two = op3_sentencepiece.decode(op3_sentencepiece.encode(odd.select("doc_id", "text")))
    assert two.where("not (text <=> decoded)").count() == 0
    assert Counter(hashlib.sha256(r.ids).hexdigest() for r in two.where("text is not null").collect()) == Counter(
        r.ids_sha256 for r in out.where("ids_sha256 is not null").collect())


def test_draws_follow_the_path_probabilities():
    v = op3_sentencepiece.Vocabulary()
    s = op3_sentencepiece.Sampler(v)

    def paths(text):
        return [((), 1.0)] if not text else [
            ((v.p[text[:e]][1], *rest), v.p[text[:e]][0] * q) for e in range(1, len(text) + 1) if text[:e] in v.p
            for rest, q in paths(text[e:])]
    every = dict(paths(" thing"))
    total, n = sum(every.values()), 6000
    drawn = Counter(tuple(s.draw([" thing"], k).tolist()) for k in range(n))
    assert set(drawn) <= set(every)
    for ids, q in every.items():
        p = q / total
        assert abs(drawn[ids] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3


def test_long_units_and_blocks(monkeypatch):
    s = op3_sentencepiece.Sampler(op3_sentencepiece.Vocabulary())
    texts = ["x" * 3000, "é中" * 200, "many words " * 300, ""]
    whole = s.encode(texts, [1, 2, 3, 4])
    monkeypatch.setattr(op3_sentencepiece, "BLOCK", 17)
    assert s.encode(texts, [1, 2, 3, 4]) == whole
    assert [s.v.decode(np.frombuffer(x, "<u2")) for x in whole] == texts


# --- 4: suffix-array dedup

@pytest.mark.parametrize("chunk,ranges,hot", [(1 << 24, 1 << 24, 1 << 12), (2000, 3000, 1 << 12), (2000, 1 << 24, 6)])
def test_repeated_bytes(spark, odd_rows, chunk, ranges, hot):
    rng = random.Random(3)
    passage = [words(rng, 12) for _ in range(4)]
    rows = [(i, t) for n, (i, t) in enumerate(odd_rows) if i is not None and (i, t) not in odd_rows[:n] and i != 4 and i != 5]
    rows += [(100 + k, words(rng, 20) + rng.choice(passage) + "|" * rng.randint(0, 80) + rng.choice(passage) +
              words(rng, 5)) for k in range(40)]
    rows += [(200 + k, "ab" * (20 + k)) for k in range(20)] + [(300, "z" * 200), (301, "z" * 49), (302, "z" * 51)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = op4_suffix_dedup.repeats(df, chunk_bytes=chunk, range_bytes=ranges, hot=hot)
    have = {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans),
                       hashlib.sha256(r.kept).hexdigest()) for r in out.collect()}
    assert have == brute.repeated_bytes(rows)


def test_repeated_bytes_odd_rows(spark, empty):
    rows = [(1, NOTE), (1, NOTE), (None, NOTE), (None, NOTE), (2, None), (3, ""), (4, LONG), (5, LONG)]
    out = op4_suffix_dedup.dedup_query(spark.createDataFrame(rows, "doc_id long, text string"))
    n, m = len(NOTE), len(LONG)
    assert Counter(tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans").collect()) == Counter(
        [(1, n, 0, 0), (1, n, 0, 0), (None, n, n, 1), (None, n, n, 1), (2, 0, 0, 0), (3, 0, 0, 0),
         (4, m, 0, 0), (5, m, m, 1)])
    assert op4_suffix_dedup.dedup_query(empty).count() == 0


def test_stored_regions_and_bucket_parts():
    rng = random.Random(9)
    texts = [words(rng, rng.randint(0, 60)).encode() for _ in range(30)] + [b"", b"x" * 300, NOTE.encode() * 3]
    size, gram = op4_suffix_dedup.SIZE, op4_suffix_dedup.GRAM
    c = op4_suffix_dedup.Chunk(texts, range(33), op4_suffix_dedup.marks(texts, size, gram), size, gram)
    want = [(d, *map(int, r)) for d, t in enumerate(texts) for r in zip(*op4_suffix_dedup.regions(t))]
    assert list(zip(c.doc.tolist(), c.start.tolist(), c.n.tolist(), c.place.tolist(), c.hash.tolist())) == want
    for kind in (np.ones(len(c.n), int), np.full(len(c.n), 2), np.arange(len(c.n)) % 3):
        pieces, far, key, low, row, start, which = c.shared(kind)
        assert all(pieces[j] == texts[d][s:s + len(pieces[j])] for d, s, j in zip(row, start, which))
        assert (key[1:] >= key[:-1]).all()
        whole = op4_suffix_dedup.smallest_ids(pieces, np.where(far >= 128, far - 128, far).astype(int), low) if pieces else []
        parts = op4_suffix_dedup.smallest_ids_by_bucket(pieces, far, low, bucket_bytes=200) if pieces else []
        assert list(whole) == list(parts) or kind[0] != 1


def test_cover_reaches_every_distance():
    have = {(a - b) % op4_suffix_dedup.PERIOD for a in op4_suffix_dedup.COVER for b in op4_suffix_dedup.COVER}
    assert have == set(range(op4_suffix_dedup.PERIOD))


# --- 5: PII

PII = ["mail a.b@c.de and x@y", "a@b@c.com d@e.f.g@h.i", "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 or 1.2.3.4", "00001.2.3.4",
       "card 4111 1111 1111 1111 or 4111-1111-1111-1112", "+1 (555) 010-2233 +12 34 +()1", "+1 2 +3 4444444", "1" * 3000,
       "@" * 500, "a@" * 300 + "b.c", "1." * 900, "١٢٣.١.١.١ é@ü.de"]


def test_base_scanners_match_the_patterns():
    rng = random.Random(1)
    texts = PII + ["".join(rng.choice("ab@.+-1234 ()%\n") for _ in range(120)) for _ in range(1500)]
    for t in texts:
        assert sorted(op5_pii.base_spans(t)) == sorted(brute.pii(t)), t


def test_pii_query(spark, odd, odd_rows, empty):
    rows = list(enumerate(PII)) + [(None, PII[0]), (50, None), (51, ""), (0, PII[0])]
    out = op5_pii.pii_query(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = Counter()
    for i, t in rows:
        spans = brute.pii(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want[i, *(sum(s[0] == k for s in spans) for k in op5_pii.KINDS), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:6] for r in out) == want
    for r in out:       # base spans stay among all spans, in order
        base = [f"{k}:{a}:{b}" for k, a, b in brute.pii(dict(rows).get(r.doc_id) or "")]
        assert set(base) <= set(r.spans.split(",")) | {""}
    assert op5_pii.pii_query(odd).count() == len(odd_rows)
    assert op5_pii.pii_query(empty).count() == 0


def test_model_adds_loose_forms_and_leaves_numbers_alone():
    w = op5_pii.fit([])

    def added(t):
        return [(k, t[a:b]) for k, a, b in op5_pii.added_spans(t, w, op5_pii.base_spans(t))]
    assert added("please call (743) 555-3824 today") == [("phone", "(743) 555-3824")]
    assert added("card 4012.8888.8888.1881 was used") == [("card", "4012.8888.8888.1881")]
    assert added("version 2.0.1 of 2024-01-05, 12 34 56 and 1,000") == []


def test_model_proposes_spans_of_no_fixed_shape(spark):
    w = op5_pii.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))

    def added(t):
        return [(k, t[a:b]) for k, a, b in op5_pii.added_spans(t, w, op5_pii.base_spans(t))]
    for text, kind, span in (
            ("please call 555 123 4567 today", "phone", "555 123 4567"),
            ("the office is 020 7946 0958, ask there", "phone", "020 7946 0958"),
            ("from abroad 0044 20 7946 0958 works", "phone", "0044 20 7946 0958"),
            ("paid by 3782 822463 10005 on Monday", "card", "3782 822463 10005"),
            ("mail ann at example dot com please", "email", "ann at example dot com")):
        assert added(text) == [(kind, span)], text
    for text in ("version 2.0.1 of 2024-01-05, 12 34 56 and 1,000", "part 3782 822463 10006 of it",
                 "the number 5731080387325255 ndhaou", "meet at five, the dot is red"):
        assert added(text) == [], text


def test_sample_reaches_the_whole_text_in_bounded_pieces(spark):
    gap = " nothing to see here" * 10
    rows = [(i, gap.join(f" item {i * 100 + k} " for k in range(20))) for i in range(20)] + [(99, "12 34 " * 5000)]
    got = op5_pii.sample_islands(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(got) == 21 * op5_pii.SAMPLE_ISLANDS and max(map(len, got)) <= op5_pii.ISLAND_CHARS
    assert any(f"item {i * 100 + k} " in p for p in got for i in range(20) for k in range(3, 20))
    assert "".join(op5_pii.pieces(rows[-1][1], 200)) == rows[-1][1]


def test_redact(spark, odd):
    w = op5_pii.fit([])
    rows = spark.createDataFrame([(1, "to a.b@c.de, 1.2.3.4", 7), (2, None, 8)], "doc_id long, text string, spans int")
    assert [tuple(r) for r in op5_pii.redact(rows, w).orderBy("doc_id").collect()] == [
        (1, "to [EMAIL], [IP]", 7), (2, None, 8)]


# --- 6: WARC

def test_warc_round_trip(spark):
    rows = [(3, "http://a", "same"), (1, "http://b\r\nX: y", "same"), (2, None, None), (5, "u", ""), (4, "u", "é\r\n\r\nWARC/1.1"),
            (None, "u", "same"), (None, "u", "own"), (1, "http://b\r\nX: y", "same"), (9, "u", "L" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows],
                                  "page_id long, url string, html string, digest string, size string")
    out = op6_warc.warc_query(pages)
    import base64
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        f = first.get(h or "")
        revisit = f is not None and f != i
        want[i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response",
             f if revisit else None] += 1
    assert Counter(tuple(r) for r in out.collect()) == want
    path = common.shared_path(spark, "w")
    op6_warc.write(op6_warc.resolve(pages, min_bytes=5), path)
    back = op6_warc.read(spark, path, with_payload=True)
    assert back.where("record_type = 'revisit'").count() == 0 and back.where("not sound").count() == 0
    assert Counter(r.payload for r in back.collect()) == Counter(r[2] or "" for r in rows)
    none = spark.createDataFrame([], pages.schema)
    assert op6_warc.warc_query(none).count() == 0


@pytest.mark.parametrize("bits", [1, 64, 1 << 20])
def test_warc_rows_that_share_a_bit(spark, monkeypatch, bits):
    """However many rows share a bit with a revisit (with one bit: all), each is told apart by its key."""
    monkeypatch.setattr(op6_warc, "BITS", bits)
    rng = random.Random(8)
    rows = [(rng.choice([None, rng.randrange(400)]) if n % 9 == 0 else 1000 + n, f"http://x/{n}",
             rng.choice(["hot", f"body {rng.randrange(90)}", f"own {n}"])) for n in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h] = min(i, first.get(h, i))
    want = Counter((i, u, None if (r := first.get(h, i) != i) else h, len(h), "revisit" if r else "response",
                    first[h] if r else None) for i, u, h in rows)
    out = op6_warc.resolve(pages).select("page_id", "url", "payload", "size", "record_type", "refers_to")
    assert Counter(tuple(r) for r in out.collect()) == want
    assert len({k[4] for k in want}) == 2


def test_warc_payloads_stay_where_they_are_read(spark):
    """No exchange carries the payloads of rows that share no bit with a revisit."""
    pages = spark.range(50).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(
        F.lit("body "), (F.col("id") % 40).cast("string")).alias("html"))
    text = op6_warc.resolve(pages)._jdf.queryExecution().executedPlan().toString()
    union = text[text.index("Union"):]
    branch = union[:union.index("LeftSemi")]
    assert "SortMergeJoin" not in branch and "BroadcastHashJoin" in branch


def test_archives_of_many_members(spark, tmp, monkeypatch):
    import gzip
    import os
    body = "HTTP/1.1 200 OK\r\n\r\n<p>é</p>"
    records = [("WARC/1.0\r\nWARC-Type: {t}\r\nWARC-Record-ID: <urn:uuid:{i}>\r\nWARC-Target-URI:http://x/{i}\r\n"
                "Content-Length: {n}\r\n\r\n{b}\r\n\r\n").format(t=t, i=i, b=b, n=len(b.encode())).encode()
               for i, (t, b) in enumerate([("warcinfo", "software: x"), *[("response", body + "z" * i * 999) for i in range(400)]])]
    os.makedirs(f"{tmp}/a")
    with open(f"{tmp}/a/x.warc.gz", "wb") as out:
        out.write(b"".join(gzip.compress(r) for r in records[:200]) + b"\0" * 99 + gzip.compress(b"".join(records[200:])))
    got = op6_warc.read(spark, f"{tmp}/a", with_payload=True).collect()
    assert sorted(r.url for r in got) == sorted(f"http://x/{i}" for i in range(401))
    assert sum(r.record_type == "response" for r in got) == 400 and {r.page_id for r in got} == {None}
    assert {len(r.payload) for r in got if r.payload} == {8 + 999 * i for i in range(400)}
    content = open(f"{tmp}/a/x.warc.gz", "rb").read()
    want = [b for _, b in op6_warc.parse(content)]
    for size, limit in ((1, 7), (13, 1 << 20), (1 << 16, 5)):
        monkeypatch.setattr(op6_warc, "INPUT", size)
        monkeypatch.setattr(op6_warc, "CHUNK", limit)
        short = b"".join(gzip.compress(r) for r in records[:3])
        assert [b for _, b in op6_warc.parse(short)] == want[:3]
    with pytest.raises(ValueError, match="ends inside"):
        list(op6_warc.parse(content[:-20]))


# --- 7: decontamination

def test_decontamination(spark, odd, odd_rows, empty):
    import re
    bench = [(1, NOTE), (2, "Dog and then"), (3, None), (4, "..."), (2, "Dog and then"), (10, "runs far away")]
    b = spark.createDataFrame([(*r, "x") for r in bench], "item_id long, text string, window string")

    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower_az(t))
    wins = {}
    for i, t in bench:
        w = split(t)
        for k in range(len(w) - min(10, len(w)) + 1 if w else 0):
            wins.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    want = Counter()
    for i, t in odd_rows:
        w, hit, items = split(t), set(), set()
        for g, its in wins.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    items |= its
        want[i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(),
             bool(hit)] += 1
    out = op7_decontaminate.decontamination_query(odd, b)
    assert Counter(tuple(r) for r in out.collect()) == want
    clean = op7_decontaminate.remove(odd, b)
    assert clean.columns == odd.columns and clean.count() == sum(n for k, n in want.items() if not k[-1])
    cut = op7_decontaminate.remove(odd, b, "spans")
    assert cut.count() == len(odd_rows)
    assert op7_decontaminate.report(cut, b).where("n_hit > 0").count() == 0
    assert op7_decontaminate.decontamination_query(empty, b).count() == 0
    assert op7_decontaminate.decontamination_query(odd, b.limit(0)).where("contaminated").count() == 0


# --- 8: SimHash

def test_simhash(spark, odd, odd_rows, empty):
    rng = random.Random(8)
    base = words(rng, 120).split()
    rows = [(i, t) for i, t in odd_rows if i is not None and (i, t) != (6, NOTE)]
    for k in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "changed"
        rows.append((100 + k, " ".join(w)))
    want = brute.simhash_components(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = {r.doc_id: (r.fingerprint, r.component_id) for r in op8_simhash.simhash_query(df).collect()}
    assert out == want
    kept = op8_simhash.keep_one(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want.values()})
    assert op8_simhash.keep_one(odd).columns == odd.columns
    assert op8_simhash.simhash_query(odd).count() == len(odd_rows)
    assert op8_simhash.keep_one(spark.createDataFrame([(1, NOTE), (1, NOTE), (None, "a b")], "doc_id long, text string")
                                ).count() == 2
    assert op8_simhash.simhash_query(empty).count() == 0 and op8_simhash.keep_one(empty).count() == 0


def test_links_match_all_pairs(spark):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    fps = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for s in seeds for _ in range(12)}
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = op8_simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    mask = (1 << 64) - 1

    def parts(pairs):
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in pairs:
            root[find(a)] = find(b)
        groups = {}
        for f in fps:
            groups.setdefault(find(f), set()).add(f)
        return sorted(map(sorted, groups.values()))
    near = [(a, b) for n, a in enumerate(fps) for b in fps[:n] if ((a ^ b) & mask).bit_count() <= 3]
    assert parts(near) == parts((r.a, r.b) for r in edges) and len(edges) < len(near) + len(fps)


def test_components_of_a_chain_and_a_star(spark):
    from refmart.llm.components import components
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500)]
    out = {(r.a, r.b) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {(i, 0) for i in range(1, 41)} | {(100 + i, 100) for i in range(1, 30)}


# --- 9: licenses

def test_license_scan(spark, odd, odd_rows, empty):
    rows = [(1, "Licensed under CC BY-NC 4.0. cc-by, CC by"), (2, "the GNU General  Public License!"),
            (3, "All rights\nreserved all rights reserved"), (4, "Released under the very MIT License"), (5, None),
            (6, "general public all rights"), (None, "cc by"), (1, "Licensed under CC BY-NC 4.0. cc-by, CC by")]
    out = op9_licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    have = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out)
    assert have == Counter({(1, 11, 3, 2, 9, "cc-by"): 2, (2, 5, 1, 2, 2, "gpl"): 1, (3, 6, 2, 0, 3, "reserved"): 1,
                            (4, 6, 0, None, None, ""): 1, (5, 0, 0, None, None, ""): 1, (6, 4, 0, None, None, ""): 1,
                            (None, 2, 1, 0, 0, "cc-by"): 1})
    by = {r.doc_id: r for r in out}
    assert "cc-by-nc-4.0" in by[1].labels and by[4].labels == "mit" and by[6].labels == ""
    assert all(0 <= r.score <= 1 for r in out) and by[5].score == 0
    assert op9_licenses.scan(odd).count() == len(odd_rows) and op9_licenses.scan(empty).count() == 0


def test_license_labels_are_exact(spark):
    gpl = "This work is licensed under the GNU General Public License"
    texts = {
        "Licensed under CC BY 4.0.": "cc-by,cc-by-4.0",
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0",
        "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa-4.0",
        "Licensed under CC BY-ND 4.0.": "cc-by", "Licensed under CC BY-NC-SA 4.0.": "cc-by",
        "Licensed under CC BY-NC 3.0.": "cc-by",
        f"{gpl}, version 2": "gpl", f"{gpl}, version 3.": "gpl,gpl-3.0", f"{gpl}, version exactly 3": "gpl,gpl-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 3": "gpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License v 1.1": "",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "mpl-2.0",
        "Licensed under the Apache License 2.0": "apache-2.0", "Licensed under the Apache License, Version 1.1": "",
        "Licensed under the BSD License": "", "licensed under the old MIT license": "mit", "licensed under MIT license": "mit",
        "the license MIT the under licensed": "", "licensed under " * 300 + "the MIT License": "mit",
        "Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0. " * 2: "cc-by,cc-by-4.0,cc-by-sa-4.0",
        "This work is not licensed under the GNU General Public License, version 3": "gpl",
        "Redistribution and use in source or binary forms, with or without modification, are permitted": "bsd"}
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    have = {rows[r.doc_id][1]: r.labels for r in op9_licenses.scan(docs).collect()}
    assert have == texts
    own = (("free to use by all of us", "short"), ("it is free to use by all of us here", "long"))
    one = spark.createDataFrame([(1, "It is free to use by all of us here.")], "doc_id long, text string")
    assert [r.labels for r in op9_licenses.scan(one, templates=own).collect()] == ["long"]


def test_license_headers_and_identifiers(spark):
    gpl = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General "
           "Public License as published by the Free Software Foundation, either version {} of the License, or (at your "
           "option) any later version.")
    mit = op9_licenses.HEADERS[2][0]
    isc = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted{} THE SOFTWARE IS PROVIDED AS IS")
    texts = {
        "SPDX-License-Identifier: Apache-2.0": "apache-2.0", "// SPDX-License-Identifier: MIT": "mit",
        "SPDX-License-Identifier: GPL-2.0-or-later x": "gpl-2.0-or-later", "SPDX-License-Identifier: GPL-2.0": "gpl-2.0",
        "SPDX-License-Identifier: LGPL-2.1-only": "lgpl-2.1-only", "SPDX-License-Identifier: LicenseRef-own": "",
        "MIT License\n\nCopyright (c) 2020 A": "mit", gpl.format("", 3): "gpl,gpl-3.0-or-later",
        gpl.format("Lesser ", "2.1"): "gpl,lgpl-2.1-or-later", gpl.format("Affero ", 3): "agpl-3.0-or-later,gpl",
        gpl.format("", 4): "gpl", "Creative Commons Attribution 4.0 International": "cc-by-4.0",
        "Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa-4.0",
        "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International": "cc-by-nc-nd-4.0",
        isc.format("."): "0bsd", isc.format(", provided that the above copyright notice and this permission notice appear in "
                                            "all copies."): "isc",
        "pre " + mit + " post": "mit", mit.replace("merge publish", "publish"): "mit", mit[:60]: "",
        "word " * 5000 + mit + " word" * 5000: "mit"}
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {rows[r.doc_id][1]: r.labels for r in op9_licenses.scan(docs).collect()} == texts


def test_license_scan_matches_sql(spark):
    rng = random.Random(12)
    parts = [t for t, _ in op9_licenses.TEMPLATES] + [t for t, _ in op9_licenses.PHRASES]
    rows = []
    for i in range(60):
        words_ = " ".join(rng.choice(parts) for _ in range(rng.randint(0, 3))).split()
        for _ in range(rng.randint(0, 4)):
            if words_:
                at = rng.randrange(len(words_))
                words_[at:at + rng.randint(0, 1)] = [rng.choice(["very", "not", "the", "7", "license"])] * rng.randint(0, 1)
        rows.append((i % 50, " ".join(words_) if i % 9 else None))
    frame = pd.DataFrame(rows, columns=["doc_id", "text"])
    with duckdb.connect() as db:
        db.register("documents", frame)
        want = Counter(db.execute(ORACLE["op9_license_scan"]).fetchall())
    got = op9_licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == want


# --- 10: language model

@pytest.mark.parametrize("order", [1, 2, 3])
def test_stupid_backoff(odd, odd_rows, empty, order):
    want = brute.stupid_backoff([t for _, t in odd_rows], order, 0.4, 2)
    out = op10_lm_score.score(odd, order, 0.4, 2, chunk_bytes=3000, range_bytes=50_000)
    have = Counter((r.doc_id, round(r.score, 5) + 0.0) for r in out.collect())
    assert have == Counter((i, round(s, 5) + 0.0) for (i, _), s in zip(odd_rows, want, strict=True))
    assert op10_lm_score.score(empty, order).count() == 0


def test_native_operators_run_no_python(odd, spark):
    bench = spark.createDataFrame([(1, NOTE)], "item_id long, text string")
    for df in (op2_quality.quality_query(odd), op7_decontaminate.decontamination_query(odd, bench),
               op9_licenses.scan(odd)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))
