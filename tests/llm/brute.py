"""Plain Python versions of the operators' contracts, quadratic and without Spark."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_az(text))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash_components(rows):
    """rows: (doc_id, text). {doc_id: (hex, component)}"""
    fp = {i: simhash(t) for i, t in rows}
    root = {i: i for i in fp}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(fp)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (fp[i] ^ fp[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (f"{fp[i]:016x}", find(i)) for i in ids}


def pii(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m.group())
        if 16 <= len(d) <= 19:
            s = 0
            for n, c in enumerate(d[::-1]):
                s += int(c) if n % 2 == 0 else sum(map(int, str(2 * int(c))))
            if s % 10 == 0:
                out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def repeated_bytes(rows, size=50):
    """rows: (doc_id, text). {doc_id: (n_bytes, n_removed, n_spans, sha256)}; equal ids share no window."""
    data = {i: (t or "").encode() for i, t in rows}
    first = {}
    for i in sorted(data):
        for p in range(len(data[i]) - size + 1):
            first.setdefault(data[i][p:p + size], i)
    out = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if first[b[p:p + size]] < i:
                gone[p:p + size] = b"\x01" * size
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def stupid_backoff(texts, order, alpha, cutoff):
    """Mean log10 score per word of every text, counts over all of them."""
    import math
    docs = [re.findall(r"[^\x20\x09-\x0D]+", lower_az(t)) for t in texts]
    counts = Counter(tuple(w[i:i + n]) for w in docs for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(map(len, docs))

    def seen(g):
        return len(g) == 1 or counts[g] >= cutoff

    def score(g):
        if len(g) == 1:
            return math.log10(counts[g] / total)
        if seen(g):
            return math.log10(counts[g] / counts[g[:-1]])
        return math.log10(alpha) + score(g[1:])
    return [sum(score(tuple(w[max(0, i - order + 1):i + 1])) for i in range(len(w))) for w in docs]
