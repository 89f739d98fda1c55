"""Personal data by a semi-Markov conditional random field.

Fixed base patterns (linear scanners, any text length) find e-mail addresses, IP
addresses, card and phone numbers; these spans always stand. Around digits and
``@`` (and a spelled-out ``dot``) the text is cut into islands of tokens, and a
semi-Markov CRF adds spans: every segment of up to ``MAX_TOKENS`` tokens and 80
characters on one line that holds a digit, an ``@``, ``at`` or ``dot`` is a
candidate. They are scored by whole-span features (shape, digit count, grouping,
checksum, separators, the word before), and a bounded-entity dynamic programme picks boundaries and types jointly.

The weights are fitted here, by the CRF's conditional likelihood, on islands of at
most ``SAMPLE`` documents: of each, ``SAMPLE_ISLANDS`` pieces at most, chosen by hash
wherever they stand, of ``ISLAND_CHARS`` characters at most; labels are the base spans, and copies of the islands
with loosened notation (no ``+``, dots for dashes, spelled-out ``at``) teach the
model forms that the patterns miss. Other segments of a sample that look like an
entity are unlabelled, not negative: they are left out of the likelihood.

Defined results: a null or empty text has no spans; repeated rows get equal
results; very long texts are scanned whole, island by island; offsets are code
points, end exclusive; an empty table gives an empty result (the
model is then fitted on its primer lines alone); other columns are kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 400        # documents at most that the weights are fitted on
SAMPLE_ISLANDS = 3  # islands at most of a document in the sample
ISLAND_CHARS = 200  # characters at most of an island in the sample; a longer one is cut into pieces
MAX_TOKENS = 16     # tokens of a segment (the bound of the dynamic programme)
MARGIN = 40         # characters of context on each side of a digit or @

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str):
    """Leftmost non-overlapping matches: at each ``@``, the whole run of local
    characters before it (not before the last match) and the domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1   # no later match can reach back over this @
        at = text.find("@", done)


def ips(text: str):
    """Four dotted parts at a time from each maximal dotted number."""
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def cards(text: str):
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind as listed, then start."""
    out = []
    if "@" in text:
        out += [("email", *s) for s in emails(text)]
    if _DIGIT.search(text):
        out += [("ip", *s) for s in ips(text)]
        out += [("card", *s) for s in cards(text)]
        if "+" in text:
            out += [("phone", *s) for s in phones(text)]
    return out


# --- the model -------------------------------------------------------------

_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[^A-Za-z0-9\s]")
_SEED = re.compile(r"[0-9@]+|[(\[](?:at|dot)[)\]]|(?<= )dot(?= )")
_WORD_BEFORE = re.compile(r"([A-Za-z]+)[^A-Za-z0-9]*$")
_CUES = {"phone": "phone", "tel": "phone", "call": "phone", "mobile": "phone", "fax": "phone", "mail": "email",
         "email": "email", "contact": "email", "card": "card", "visa": "card", "ip": "ip", "host": "ip", "server": "ip"}
_SHAPES = {
    "mail": re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+"),
    "mail_loose": re.compile(r"[\w.%+-]+ ?(?:\(at\)|\[at\]|@) ?[\w-]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[\w-]+)+"),
    "quad": re.compile(r"\d{1,3}(?:\.\d{1,3}){3}"),
    "fours": re.compile(r"\d{4}(?:[ .-]?\d{4}){3}"),
    "plus": re.compile(r"\+\d[\d ().-]+\d"),
    "area": re.compile(r"(?:\d[ .-])?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}"),
    "three_parts": re.compile(r"\d{3}[.-]\d{3}[.-]\d{4}"),
}
_GROUPED = re.compile(r"[+(]*\d+(?:[ ().-]+\d+)*")
_GROUP = re.compile(r"[0-9]+")
_WORDS = re.compile(r"[A-Za-z0-9_.+%-]+")
FEATURES = (*_SHAPES, "no_shape", "grouped", "one_group", "two_groups", "groups3-4", "groups>4", "short_group",
            "mixed_gaps", "spaces", "dashes", "dots", "last4", "phone_like", "zero_phone", "luhn15", "plain15", "plain16",
            "spelled", "half_spelled", "loose_words", "cut_short", *(f"cue_{k}" for k in KINDS), "bias", "digits<8", "digits8-15", "digits16-19", "digits>19",
            "letters", "luhn16", "at", "touches_word", "touches_digit", "edge_space", "many_tokens", "octets")
_F = {name: i for i, name in enumerate(FEATURES)}


def islands(text: str):
    """[start, end) stretches around digits and @, merged where they touch, cut at blanks."""
    spans = []
    for m in _SEED.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if spans and a <= spans[-1][1]:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    return spans


def segments(text: str, lo: int, hi: int, taken=()):
    """Tokens of the island and its candidate segments: (first token, last token + 1, features);
    none of them overlaps one of the ``taken`` spans."""
    toks = [m.span() for m in _TOKEN.finditer(text, lo, hi)]
    out = []
    digit = [text[a].isdigit() and text[a].isascii() for a, _ in toks]
    usable = [not text[a].isspace() and text[a] not in ",;:\"'|" for a, _ in toks]
    seed = [d or text[a] == "@" or text[a:b] in ("at", "dot") for d, (a, b) in zip(digit, toks, strict=True)]
    free = [not any(a < e and s < b for a, b in taken) for s, e in toks]
    for i, (a, _) in enumerate(toks):
        if not usable[i]:
            continue
        seeded = False
        for j in range(i + 1, min(i + MAX_TOKENS, len(toks)) + 1):
            b = toks[j - 1][1]
            if b - a > 80 or not free[j - 1] or "\n" in text[toks[j - 1][0]:b]:
                break
            seeded = seeded or seed[j - 1]
            if not seeded or not usable[j - 1] or text[b - 1] in ".(+@%&*#$":
                continue
            out.append((i, j, _features(text, a, b, text[a:b], j - i)))
    return toks, out


def _features(text, a, b, s, n):
    f = [name for name, p in _SHAPES.items() if p.fullmatch(s)] if n > 2 else []
    if not f:
        f.append("no_shape")
    f.append("bias")
    groups = _GROUP.findall(s)
    digits = "".join(groups)
    k = len(digits)
    f.append("digits<8" if k < 8 else "digits8-15" if k < 16 else "digits16-19" if k < 20 else "digits>19")
    if any(c.isalpha() for c in s):
        f.append("letters")
    elif _GROUPED.fullmatch(s):
        f.append("grouped")
        size, gaps = len(groups), {g for g in re.split(r"[0-9]+", s)[1:-1]}
        f.append("one_group" if size == 1 else "two_groups" if size == 2 else "groups3-4" if size < 5 else "groups>4")
        if size > 1:
            f += [name for name, gap in (("spaces", " "), ("dashes", "-"), ("dots", ".")) if gaps == {gap}]
            if len(gaps) > 1:
                f.append("mixed_gaps")
            if min(map(len, groups)) < 2:
                f.append("short_group")
            if len(groups[-1]) == 4:
                f.append("last4")
            if 9 <= k <= 15 and 3 <= size <= 5 and len(groups[-1]) in (3, 4) and max(map(len, groups)) <= 4:
                if gaps == {" "} and len(groups[-1]) == 4 and len(groups[-2]) in (3, 4):
                    f.append("zero_phone" if s[0] == "0" else "phone_like")
        if k == 15:
            f.append("luhn15" if luhn(digits) and [*map(len, groups)] in ([15], [4, 6, 5]) else "plain15")
        if 16 <= k <= 19 and not luhn(digits):
            f.append("plain16")
    if 16 <= k <= 19 and luhn(digits):
        f.append("luhn16")
    if "@" in s or "at" in s.lower():
        f.append("at")
    words = _WORDS.findall(s)
    if "dot" in words or "at" in words:
        # name at host dot ... dot end, and nothing else
        whole = (len(words) > 4 and len(words) % 2 and words[1] == "at" and all(w == "dot" for w in words[3::2])
                 and not any(w in ("at", "dot") for w in words[::2]))
        f.append("spelled" if whole else "half_spelled")
        if whole and re.match(r" dot [A-Za-z]", text[b:b + 6]):
            f.append("cut_short")
    elif " " in s and "letters" in f and re.search(r"[A-Za-z0-9] [A-Za-z0-9]", s):
        f.append("loose_words")
    if (a and (text[a - 1].isalpha())) or (b < len(text) and text[b].isalpha()):
        f.append("touches_word")
    if (a and (text[a - 1].isdigit() or text[a - 1] in "+.-(")) or (b < len(text) and (
            text[b].isdigit() or (text[b] in ".-" and text[b + 1:b + 2].isdigit()))):
        f.append("touches_digit")
    elif "grouped" in f and ((a > 1 and text[a - 1] == " " and text[a - 2].isdigit()) or (
            text[b:b + 1] == " " and text[b + 1:b + 2].isdigit())):
        f.append("cut_short")     # the number goes on behind a blank
    if s[0] == " " or s[-1] == " ":
        f.append("edge_space")
    if n > 12:
        f.append("many_tokens")
    if s.count(".") == 3 and all(p.isdigit() and len(p) < 4 and int(p) <= 255 for p in s.split(".")):
        f.append("octets")
    m = _WORD_BEFORE.search(text, max(0, a - MARGIN), a)
    if m and m.group(1).lower() in _CUES:
        f.append(f"cue_{_CUES[m.group(1).lower()]}")
    x = np.zeros(len(FEATURES), np.uint8)
    x[[_F[name] for name in f]] = 1
    return x


_LOOKS = ("mail", "mail_loose", "quad", "fours", "plus", "area", "three_parts", "phone_like", "zero_phone", "luhn15",
          "luhn16", "spelled")


def labelled(segs: list, gold: dict) -> tuple[list, dict]:
    """Without the unlabelled segments that look like an entity and lie apart from the gold ones."""
    look = [_F[name] for name in _LOOKS]
    kept, out = [], {}
    for i, (s, e, f) in enumerate(segs):
        if i in gold:
            out[len(kept)] = gold[i]
        elif f[look].any() and not any(segs[g][0] < e and s < segs[g][1] for g in gold):
            continue
        kept.append(segs[i])
    return kept, out


def _loosen(text: str) -> list[str]:
    """The island in other notations of the same data."""
    return [re.sub(r"\+\d+ (?=\()", "", text), re.sub(r"(?<=\w)@(?=\w)", " (at) ", text),
            re.sub(r"(?<=\d)-(?=\d{4}\b)", ".", text), re.sub(r"(\d{4})[ -](?=\d{4})", r"\1.", text)]


def _respelled(text: str, base: list) -> tuple[str, dict]:
    """The text with its e-mail addresses spelled out and its phone numbers as blank-separated
    groups without the country code, and where those and the other base spans then stand."""
    parts, truth, size, at = [], {}, 0, 0
    for a, b, kind in sorted((a, b, k) for k, a, b in base):
        if a < at:
            continue
        new = text[a:b]
        if kind == "email":
            name, host = new.rsplit("@", 1)
            new = f"{name} at {host.replace('.', ' dot ')}"
        elif kind == "phone":
            new = " ".join(_GROUP.findall(new)[1:]) or new
        parts += [text[at:a], new]
        size += a - at
        truth[size, size + len(new)] = kind
        size, at = size + len(new), b
    return "".join([*parts, text[at:]]), truth


# Labelled lines that every fit starts from, so that a kind which the sample lacks is
# known too: (text, kind, the span's text); no kind: nothing in the line is personal.
PRIMER = (
    ("reach me at ann.lee@mail.example.org today", "email", "ann.lee@mail.example.org"),
    ("write to ann.lee (at) example.org now", "email", "ann.lee (at) example.org"),
    ("mail ann [at] example [dot] org please", "email", "ann [at] example [dot] org"),
    ("call +1 (555) 010-2233 soon", "phone", "+1 (555) 010-2233"),
    ("call (555) 010-2233 soon", "phone", "(555) 010-2233"),
    ("phone 555.010.2233 or write", "phone", "555.010.2233"),
    ("tel 555-010-2233 or write", "phone", "555-010-2233"),
    ("card 4111 1111 1111 1111 expires", "card", "4111 1111 1111 1111"),
    ("paid with 5500.0000.0000.0004 then", "card", "5500.0000.0000.0004"),
    ("number 4012-8888-8888-1881 was used", "card", "4012-8888-8888-1881"),
    ("number 4012.8888.8888.1881 was used", "card", "4012.8888.8888.1881"),
    ("host 192.168.10.254 answered", "ip", "192.168.10.254"),
    ("from 10.0.0.7 and on", "ip", "10.0.0.7"),
    ("call 212 555 0147 today", "phone", "212 555 0147"),
    ("or 415 555 0199, after noon", "phone", "415 555 0199"),
    ("tel 0161 496 0123 or write", "phone", "0161 496 0123"),
    ("ring 029 2018 0456 at home", "phone", "029 2018 0456"),
    ("from abroad 0044 161 496 0123 only", "phone", "0044 161 496 0123"),
    ("dial 0033 14 4567 0123 first", "phone", "0033 14 4567 0123"),
    ("card 3714 496353 98431 expires", "card", "3714 496353 98431"),
    ("paid with 3787 344936 71000 then", "card", "3787 344936 71000"),
    ("the 3714 496353 98431 was used", "card", "3714 496353 98431"),
    ("number 3787-344936-71000 was used", "card", "3787-344936-71000"),
    ("billed to 371449635398431 then", "card", "371449635398431"),
    ("write to bob at mailbox dot org now", "email", "bob at mailbox dot org"),
    ("ask eve.low at post dot example dot net please", "email", "eve.low at post dot example dot net"),
    ("serial 3714 496353 98432 of a box", None, ""),
    ("part 1234 567890 12345 of a list", None, ""),
    ("look at the red dot on top of it", None, ""),
    ("we met at noon and a dot was seen", None, ""),
    ("rows 12 34 56 and 100 200 300 or 1999 2000 2001", None, ""),
    ("number 2123465659789240 and 5731080387325255 was seen", None, ""),
    ("part 1234.5678.1234.5678 of the list", None, ""),
    ("serial 1111 2222 3333 4444 of a box", None, ""),
    ("build 812.900.401.777 was made", None, ""),
    ("on 2024-01-05 at 12:30 with version 2.0.1", None, ""),
    ("see 1.2.3.4.5.6 in the table", None, ""),
    ("range 100-200-3000 and 12.50 or 7", None, ""),
)


def training_set(texts: list[str]) -> list[tuple[int, list, dict]]:
    """(number of tokens, segments, {segment index: kind}) of labelled islands."""
    out = []
    for text, kind, span in PRIMER:
        at = text.find(span)
        for lo, hi in islands(text):
            toks, segs = segments(text, lo, hi)
            gold = {i: kind for i, (s, e, _) in enumerate(segs)
                    if kind and (toks[s][0], toks[e - 1][1]) == (at, at + len(span))}
            if segs:
                out.append((len(toks), segs, gold))
    for text in texts:
        base = base_spans(text)
        spelled, stand = _respelled(text, base)
        for variant in dict.fromkeys([text, *_loosen(text), spelled]):
            truth = {(a, b): k for k, a, b in base_spans(variant)}
            if variant == spelled:
                truth = stand
            elif variant != text and base:
                # the loosened copy holds the same entities: find them by their loose shapes
                for name, kind in (("mail_loose", "email"), ("area", "phone"), ("fours", "card")):
                    for m in _SHAPES[name].finditer(variant):
                        if any(k == kind for k, _, _ in base) and not any(
                                a < m.end() and m.start() < b for a, b in truth):
                            truth[m.span()] = kind
            for lo, hi in islands(variant):
                toks, segs = segments(variant, lo, hi)
                gold = {i: truth[toks[s][0], toks[e - 1][1]] for i, (s, e, _) in enumerate(segs)
                        if (toks[s][0], toks[e - 1][1]) in truth}
                segs, gold = labelled(segs, gold)
                if segs:
                    out.append((len(toks), segs, gold))
    return out


def fit(texts: list[str], epochs: int = 12, rate: float = 0.3, decay: float = 1e-3) -> np.ndarray:
    """Weights (features x kinds) by gradient ascent on the conditional log-likelihood
    of the gold segmentations: observed minus expected feature counts, the latter by
    the semi-Markov forward-backward recursion over the islands."""
    w = np.zeros((len(FEATURES), len(KINDS)))
    w[_F["bias"]] = -2.0
    data = training_set(texts)
    for _ in range(epochs):
        for n, segs, gold in data:
            x = np.array([f for _, _, f in segs], float)
            score = x @ w
            total = np.logaddexp.reduce(score, axis=1)
            begin = [[] for _ in range(n + 1)]
            for k, (s, e, _) in enumerate(segs):
                begin[s].append((k, e))
            ahead = np.full(n + 1, -np.inf)
            ahead[0] = 0.0
            for i in range(n):     # one outside token, or a whole segment
                ahead[i + 1] = np.logaddexp(ahead[i + 1], ahead[i])
                for k, e in begin[i]:
                    ahead[e] = np.logaddexp(ahead[e], ahead[i] + total[k])
            back = np.full(n + 1, -np.inf)
            back[n] = 0.0
            for i in range(n - 1, -1, -1):
                back[i] = np.logaddexp.reduce([back[i + 1], *(total[k] + back[e] for k, e in begin[i])])
            p = np.exp(np.array([ahead[s] + back[e] for s, e, _ in segs])[:, None] + score - ahead[n])
            for k, kind in gold.items():
                p[k, KINDS.index(kind)] -= 1
            w -= rate * (x.T @ p + decay * w)
    return w


def added_spans(text: str, weights: np.ndarray, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans that the model adds: the best segmentation of every island, given that
    base spans are taken. Bounded: each position looks at segments of MAX_TOKENS at most."""
    out = []
    taken = sorted((a, b) for _, a, b in base)
    for lo, hi in islands(text):
        free = _SEED.search(_blank(text, lo, hi, taken))
        if free is None:
            continue
        toks, segs = segments(text, lo, hi, [(a, b) for a, b in taken if b > lo and a < hi])
        if not segs:
            continue
        score = np.array([f for _, _, f in segs]) @ weights
        kind, best = score.argmax(1), score.max(1)
        begin = {}
        for k, (s, e, _) in enumerate(segs):
            begin.setdefault(s, []).append((k, e))
        value, choice = [0.0] * (len(toks) + 1), [None] * (len(toks) + 1)
        for i in range(len(toks) - 1, -1, -1):
            value[i], choice[i] = value[i + 1], None
            for k, e in begin.get(i, ()):
                if best[k] + value[e] > value[i]:
                    value[i], choice[i] = best[k] + value[e], k
        i = 0
        while i < len(toks):
            if choice[i] is None:
                i += 1
            else:
                s, e, _ = segs[choice[i]]
                out.append((KINDS[kind[choice[i]]], toks[s][0], toks[e - 1][1]))
                i = e
    return out


def _blank(text, lo, hi, taken):
    part = list(text[lo:hi])
    for a, b in taken:
        if b > lo and a < hi:
            for i in range(max(a, lo), min(b, hi)):
                part[i - lo] = " "
    return "".join(part)


# --- Spark -----------------------------------------------------------------

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))


_BETWEEN_WORDS = re.compile(r"(?<=[A-Za-z.,]) (?=[A-Za-z])")


def pieces(text: str, chars: int) -> list[str]:
    """The islands of a text, those longer than ``chars`` cut, between two words where there are any."""
    out = []
    for lo, hi in islands(text):
        while hi - lo > chars:
            cuts = [m.end() for m in _BETWEEN_WORDS.finditer(text, lo + chars // 2, lo + chars)]
            cut = cuts[-1] if cuts else lo + chars
            out.append(text[lo:cut])
            lo = cut
        out.append(text[lo:hi])
    return out


def chosen(text: str, count: int, chars: int) -> list[str]:
    """``count`` pieces at most, by the hash of their number and text."""
    def order(piece):
        return hashlib.blake2b(f"{piece[0]} {piece[1]}".encode("utf-8", "replace"), digest_size=8).digest()
    return [p for _, p in sorted(enumerate(pieces(text, chars)), key=order)[:count]]


def sample_islands(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count: int = SAMPLE_ISLANDS,
                   chars: int = ISLAND_CHARS) -> list[str]:
    """Islands (``count`` a document, ``chars`` characters each at most) of at most SAMPLE documents
    (smallest hash of the id first) that hold a digit or @."""
    rows = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")).where(
        F.col("t").rlike("[0-9@]"))

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([chosen(t, count, chars) for t in texts])

    picked = rows.orderBy(F.xxhash64("i"), F.xxhash64("t")).limit(SAMPLE)
    return [s for r in picked.select(cut("t").alias("s")).collect() for s in r.s]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    return fit(sample_islands(docs, id_col, text_col))


def find(docs: DataFrame, weights: np.ndarray, text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with all spans as column ``out``: kind, start, end, base; by kind as listed, then start."""
    cells = weights.tolist()

    @F.pandas_udf(SPANS)
    def scan(texts: pd.Series) -> pd.Series:
        w = np.array(cells)
        found = []
        for t in texts:
            base = base_spans(t) if t else []
            more = added_spans(t, w, base) if t else []
            both = [(*s, True) for s in base] + [(*s, False) for s in more]
            both.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
            found.append([{"kind": k, "start": a, "end": b, "base": f} for k, a, b, f in both])
        return pd.Series(found)

    return docs.withColumn(out, scan(F.col(f"`{text_col}`")))


def redact(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in brackets."""
    cells = weights.tolist()

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        w = np.array(cells)
        out = []
        for t in texts:
            if t:
                base = base_spans(t)
                spans = sorted((a, b, k) for k, a, b in base + added_spans(t, w, base))
                parts, at = [], 0
                for a, b, k in spans:
                    if a >= at:
                        parts += [t[at:a], f"[{k.upper()}]"]
                    at = max(at, b)
                t = "".join([*parts, t[at:]])
            out.append(t)
        return pd.Series(out)

    return docs.withColumn(text_col, clean(F.col(f"`{text_col}`")))


def joined(spans: list) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def digest(spans: list) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def pii_query(docs: DataFrame) -> DataFrame:
    """The digest the op5 query returns; counts are of the base spans."""
    found = find(docs.select("doc_id", "text"), train(docs))
    base = F.filter("spans", lambda s: s["base"])

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    found = found.select("doc_id", "spans", base.alias("b"))
    return found.select("doc_id", *[_count(k) for k in KINDS], F.sha2(text(F.col("b")), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"))


def _count(kind: str):
    return F.size(F.filter("b", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
