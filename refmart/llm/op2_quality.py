"""Quality rules as a bitmask ledger (native DataFrame functions only).

Every rule is evaluated once per document; the ledger keeps the measurements and
one bit per failed rule. Policies are masks over the bits, so a new policy
version or an ablation ("what would be kept without rule r?") never touches the
text again: it is bitwise work on the ledger's distinct bit patterns.

Defined results: a null or empty text has no words (all measurements 0) and fails
the word-count rule; repeated rows and null ids are measured row by row, as they
stand; texts of any length are measured whole; an empty table gives an empty ledger;
other columns are ignored (``ledger``) or kept (``apply_policy``), whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import covered, space_words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# One bit per rule, in this order; bits are never reused for another rule.
RULES = ("few_words", "repeated_windows", "symbols", "duplicate_lines", "long_words", "shouting")
BIT = {name: 1 << i for i, name in enumerate(RULES)}

# Policy versions: the rules whose failure rejects a document.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "duplicate_lines"),
    "v2": RULES,
}


def mask(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


def _n_symbols(text: Column) -> Column:
    return sum((F.char_length(text) - F.char_length(F.replace(text, F.lit(ch), F.lit(""))) for ch in SYMBOLS),
               F.lit(0))


def _windows(words: Column, n: Column) -> tuple[Column, Column]:
    """Hashes of the 3-word windows, and the sorted (window, start) pairs. A set of
    the hashes clears documents without a repeat (equal windows have equal hashes);
    the others sort the windows themselves, so the count is exact."""
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    grams = F.sort_array(F.transform(starts, lambda i: F.struct(
        F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("g"), i.alias("i"))))
    return hashes, grams


def measure(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and a struct ``q`` with n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words, n_bangs (all long). One pass, no shuffle."""
    text = F.coalesce(F.col("q_text"), F.lit(""))
    df = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("q_text"))
    df = df.withColumn("q_words", space_words(F.col("q_text")))
    words = F.col("q_words")
    df = df.withColumn("q_n", F.size(words))
    n = F.col("q_n")
    hashes, grams = _windows(words, n)
    df = df.withColumn("q_hashes", hashes)
    df = df.withColumn("q_grams", F.when(
        F.size(F.array_distinct("q_hashes")) < F.size("q_hashes"), grams))
    g = F.col("q_grams")
    last = F.size(g) - 1
    repeated = F.transform(F.filter(g, lambda x, k: (
        F.when(k > 0, g[k - 1]["g"] == x["g"]).otherwise(False)
        | F.when(k < last, g[k + 1]["g"] == x["g"]).otherwise(False))), lambda x: x["i"])
    df = df.withColumn("q_at", F.sort_array(repeated))
    df = df.withColumn("q_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    flat = text
    for ch in (" ", "\t", "\n", "\x0b", "\x0c", "\r"):
        flat = F.replace(flat, F.lit(ch), F.lit(""))
    # an array of one struct, taken apart: filters on the measurements stay above it
    # (pushed below, each would repeat the expressions above many times over)
    return df.select(*[F.col(c) for c in keep], F.explode(F.array(F.struct(
        n.cast("long").alias("n_words"),
        F.char_length(flat).cast("long").alias("word_chars"),
        _n_symbols(text).cast("long").alias("n_symbols"),
        F.size("q_lines").cast("long").alias("n_lines"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered(F.col("q_at"), 3), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.regexp_count(text, F.lit(r"!!")).cast("long").alias("n_bangs"),
    ))).alias("q"))


def fail_bits(q: Column) -> Column:
    """The rule bits of one measurement struct (bigint)."""
    words = q["n_words"]
    failed = {
        "few_words": words < MIN_WORDS,
        "repeated_windows": 100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * words,
        "symbols": 100 * q["n_symbols"] > 30 * words,
        "duplicate_lines": (q["n_dup_lines"] >= 3) & (100 * q["n_dup_lines"] > 50 * q["n_lines"]),
        "long_words": q["word_chars"] > 25 * words,
        "shouting": 100 * q["n_bangs"] > 30 * words,
    }
    return sum((F.when(failed[r], F.lit(BIT[r])).otherwise(F.lit(0)) for r in RULES), F.lit(0)).cast("long")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, the measurements and ``fail_bits``."""
    m = measure(docs, text_col, (id_col,))
    return m.select(F.col(id_col), "q.*", fail_bits(F.col("q")).alias("fail_bits"))


def passes(bits: Column, policy: str) -> Column:
    return bits.bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def apply_policy(docs: DataFrame, policy: str = "v2", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all their columns) that the policy keeps."""
    cols = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("q_row"),
                       F.col(f"`{text_col}`").alias("q_in"))
    m = measure(held, "q_in", ("q_row",))
    return m.where(passes(fail_bits(F.col("q")), policy)).select("q_row.*")


def ablations(book: DataFrame) -> DataFrame:
    """Per policy and rule of it: documents rejected by the policy, by the rule,
    and by the rule alone (those come back when it is dropped). The ledger is
    first reduced to its distinct bit patterns (at most 2^rules rows)."""
    patterns = book.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    # patterns (<= 2^rules rows) times policies x rules (a fixed list)
    both = patterns.select("n", "fail_bits", F.explode(F.array(*[
        F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(mask(p)).cast("long").alias("mask"),
                 F.lit(BIT[r]).cast("long").alias("bit")) for p in POLICIES for r in POLICIES[p]])).alias("c"))
    both = both.select("n", "fail_bits", "c.*")
    return both.groupBy("policy", "rule").agg(
        F.sum(F.when(hit != 0, F.col("n")).otherwise(0)).alias("rejected"),
        F.sum(F.when(hit.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed_rule"),
        F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("rejected_by_rule_alone"))


def quality_query(docs: DataFrame) -> DataFrame:
    """The digest the op2 query returns; ``kept`` is the ``v2`` policy's verdict."""
    book = ledger(docs)
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~passes(F.col("fail_bits"), "base")).alias("base_failed"),
                       passes(F.col("fail_bits"), "v2").alias("kept"), "fail_bits")
