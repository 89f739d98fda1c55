"""Recall and precision of the spans that op5's model adds, on labelled text that neither its
primer nor its sample holds: forms with drawn digits and names, in sentences of their own."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from refmart.llm import op5_pii

NAMES = ("maria", "jon", "li.wei", "s_kumar", "o-brien", "tom99")
HOSTS = ("acme", "north-mill", "uni", "webpost", "river7")
ENDS = ("org", "net", "com", "edu")
# sentences by kind; {} stands for the entity
SENTENCES = {
    "phone": ("you can phone the office: {} until five.", "Please ring {} and ask for Sam", "Fax: {}", "our number is {}, thanks",
              "text me on {} tonight"),
    "card": ("charge it to {} as before", "the payment by {} was declined", "Visa {} on file", "she typed {} into the form"),
    "email": ("send it to {} by Friday", "questions go to {} only", "contact: {}", "copied {} on the reply"),
    "none": ("item {} is out of stock", "the population was {} that year", "invoice {} is due", "chapter {} begins",
             "order {} has shipped"),
}


def _digits(rng, pattern):
    return "".join(str(rng.randrange(10)) if c == "#" else c for c in pattern)


def _card(rng, pattern):
    """Digits for the pattern's #, the last of which makes the number pass Luhn."""
    while True:
        text = _digits(rng, pattern)
        if op5_pii.luhn("".join(c for c in text if c.isdigit())):
            return text


def _name(rng, at, dot):
    return f"{rng.choice(NAMES)}{at}{rng.choice(HOSTS)}{dot}{rng.choice(ENDS)}"


FORMS = {
    "phone (ddd) ddd-dddd": ("phone", lambda r: _digits(r, "(2##) 555-####")),
    "phone ddd-ddd-dddd": ("phone", lambda r: _digits(r, "4##-555-####")),
    "phone ddd.ddd.dddd": ("phone", lambda r: _digits(r, "6##.555.####")),
    "phone ddd ddd dddd": ("phone", lambda r: _digits(r, "3## 555 ####")),
    "phone 0dddd dddddd": ("phone", lambda r: _digits(r, "01### 49####")),
    "phone 0ddd ddd dddd": ("phone", lambda r: _digits(r, "0## 49## ####")),
    "phone 00dd": ("phone", lambda r: _digits(r, "0049 ## ### ####")),
    "phone 0dddd ddd ddd": ("phone", lambda r: _digits(r, "077## 900 ###")),
    "phone pairs": ("phone", lambda r: _digits(r, "06 ## ## ## ##")),
    "phone ten digits": ("phone", lambda r: _digits(r, "555#######")),
    "card 4 groups, dots": ("card", lambda r: _card(r, "4###.####.####.####")),
    "card 15 digits": ("card", lambda r: _card(r, "37## ###### #####")),
    "card 15 digits, dashes": ("card", lambda r: _card(r, "34##-######-#####")),
    "email (at)": ("email", lambda r: _name(r, " (at) ", ".")),
    "email [at] [dot]": ("email", lambda r: _name(r, " [at] ", " [dot] ")),
    "email at dot": ("email", lambda r: _name(r, " at ", " dot ")),
    "none ddddd": ("none", lambda r: _digits(r, "7####")),
    "none d,ddd,ddd": ("none", lambda r: _digits(r, "3,###,###")),
    "none dddd/dddd": ("none", lambda r: _digits(r, "20##/####")),
    "none d.d.d": ("none", lambda r: _digits(r, "#.#.#")),
    "none dddd dddd dddd": ("none", lambda r: _digits(r, "1### 5### 9###")),
    "none 0dd dddd dddd": ("none", lambda r: _digits(r, "020 7### 0###")),
    "none dd-dd": ("none", lambda r: _digits(r, "1#-2#")),
}


def held_out(seed=17, each=40):
    """(form, kind, text, start, end); start is None where nothing is to be found."""
    rng = random.Random(seed)
    for form, (kind, make) in FORMS.items():
        for _ in range(each):
            entity, sentence = make(rng), rng.choice(SENTENCES[kind])
            text = sentence.format(entity)
            at = None if kind == "none" else text.index(entity)
            yield form, kind, text, at, at is not None and at + len(entity)


def measure(weights):
    """{form: (found, all)} with, for forms of no kind, the texts left alone as found."""
    right, every = Counter(), Counter()
    for form, kind, text, a, b in held_out():
        base = op5_pii.base_spans(text)
        spans = {*base, *op5_pii.added_spans(text, weights, base)}
        every[form] += 1
        right[form] += (not spans) if kind == "none" else ((kind, a, b) in spans)
    return {f: (right[f], every[f]) for f in every}


@pytest.fixture(scope="module")
def measured(spark):
    return measure(op5_pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))


def test_recall_of_added_spans(measured):
    """Floors a little below what was measured (phone 240 of 400, card 93 of 120, email 106 of 120, texts left
    alone 200 of 280). Known misses: numbers in pairs, with a five-digit area code or unseparated; known false
    finds: counts and orders of three groups that look like a phone number."""
    share = {}
    for kind in SENTENCES:
        found, every = (sum(x) for x in zip(*(v for f, v in measured.items() if FORMS[f][0] == kind)))
        share[kind] = found / every
    assert share["phone"] >= 0.55 and share["card"] >= 0.7 and share["email"] >= 0.85 and share["none"] >= 0.7, share


def test_the_held_out_set_is_not_the_training_set():
    primer = {text for text, _, _ in op5_pii.PRIMER}
    texts = [t for _, _, t, _, _ in held_out()]
    assert len(texts) == 40 * len(FORMS) and not primer & set(texts)
    assert not any(span and span in t for _, _, span in op5_pii.PRIMER for t in texts)
