"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule rejects a document by an integer test over a few measures of its
text. On a bounded sample of the rows that reach the cascade, every rule's cost
(run time a row, above that of the same job without the rule) and selectivity
(share rejected of what the rules before it let through) are estimated; the
next rule is always the one of most rejection per cost. They are nested in one
CASE, so that a row pays for a rule only if no earlier one rejected it. The
order changes the cost, never the verdict."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.session import ensure_checkpoint_dir

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
SAMPLE_ROWS = 2000
COPIES = (4, 32, 256)  # how often a timed job evaluates a rule on each sampled row


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long")


def n_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def full_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE[1:]}"))


def n_dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def with_repeats(df: DataFrame, text: str, out: str, tokens: str = "_words") -> DataFrame:
    """Add ``tokens`` (the words) and ``out``: how many words stand in a 5-word
    window that occurs twice or more in the text.

    Windows are compared by 64-bit hashes. Only texts with a repeated window
    sort theirs, in one array of (hash, position); the work is linear in the
    words but for that sort, and nothing is shuffled. Each step is a column of
    its own, so no lambda evaluates an array again for each element."""
    w = F.col(tokens)
    df = df.withColumn(tokens, words(F.col(text)))
    df = df.withColumn("_grams", F.when(F.size(w) >= WINDOW, F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, WINDOW))))))
    grams = F.col("_grams")
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct(grams)) < F.size(grams), F.sort_array(
        F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    s = F.col("_sorted")
    beside = lambda x, j: F.get(s, j)["g"].eqNullSafe(x["g"])
    df = df.withColumn("_at", F.sort_array(F.transform(
        F.filter(s, lambda x, j: beside(x, j - 1) | beside(x, j + 1)), lambda x: x["i"])))
    covered = F.aggregate("_at", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda acc, p: F.struct(
        (acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n"), (p + WINDOW).alias("end")), lambda acc: acc["n"])
    # a generated column: a later filter on it is not pushed down, which would put all
    # of these steps, arrays within lambdas included, into one expression
    df = df.withColumn(out, F.explode(F.array(F.coalesce(covered, F.lit(0)).cast("long"))))
    return df.drop("_grams", "_sorted", "_at")


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Column], Column]  # of the non-null text


#: The method's rules beyond the base test: shares in hundredths of words or lines.
RULES = (
    Rule("symbols", lambda t: 100 * n_of(t, SYMBOLS) > 10 * n_words(t)),
    Rule("exclaims", lambda t: 100 * n_of(t, "!") > 50 * n_words(t)),
    Rule("lines", lambda t: 100 * n_dup_lines(full_lines(t)) > 30 * F.size(full_lines(t))),
    Rule("long_words", lambda t: word_chars(t) > 100 * n_words(t)),
)


class Estimate(NamedTuple):
    rule: Rule
    seconds: float   # of the rule alone, a row
    rejected: float  # share of the rows that the rules before it let through

    @property
    def rank(self) -> float:
        return self.rejected / max(self.seconds, 1e-12)


def base_failed(words_: Column, repeats: Column) -> Column:
    return (words_ < 10) | (100 * repeats > 20 * words_)


def _timed(sample: DataFrame, copies: int, verdict: Column) -> float:
    """Seconds of a job that evaluates ``verdict`` so often on each row; the better of two runs, as the first compiles."""
    job = sample.select("t", F.explode(F.sequence(F.lit(1), F.lit(copies)))).agg(F.count_if(verdict))
    best = float("inf")
    for _ in range(2):
        began = time.perf_counter()
        job.first()
        best = min(best, time.perf_counter() - began)
    return best


def costs(sample: DataFrame, rows: int, rules=RULES) -> dict[str, float]:
    """Seconds a row of each rule over a sample of (t): its job's time less that of the job
    that only looks at the text's length, at so many copies that the rule is the larger part."""
    empty = {}
    out = {}
    for rule in rules:
        for copies in COPIES:
            if copies not in empty:
                empty[copies] = _timed(sample, copies, F.octet_length("t") < 0)
            spent = _timed(sample, copies, rule.rejects(F.col("t"))) - empty[copies]
            if spent >= empty[copies]:
                break
        out[rule.name] = max(spent, 0.0) / (copies * max(rows, 1))
    return out


def ordered(rules, seconds: dict[str, float], patterns: dict[tuple, int]) -> list[Estimate]:
    """Rules by most rejection per cost among the rows left by those chosen before (ties by
    name). ``patterns`` counts rows by the tuple of the rules' verdicts."""
    left, todo, out = dict(patterns), dict(enumerate(rules)), []
    while todo:
        n = sum(left.values())
        found = {k: Estimate(r, seconds[r.name], sum(c for v, c in left.items() if v[k]) / max(n, 1)) for k, r in todo.items()}
        best = min(found, key=lambda k: (-found[k].rank, found[k].rule.name))
        out.append(found[best])
        left = {v: c for v, c in left.items() if not v[best]}
        del todo[best]
    return out


def estimate(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS, repeats_first: bool = True) -> list[Estimate]:
    """The cascade's order from a random sample of about ``sample_rows`` rows of ``docs``.

    Only sampled rows that pass the base test are used (with ``repeats_first`` false: its
    word count alone). The count for the sampling fraction reads no column. What comes to
    the driver is a row for each combination of verdicts in the sample."""
    ensure_checkpoint_dir(docs.sparkSession)
    sample = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    sample = sample.sample(min(1.0, sample_rows / max(1, docs.count())), seed=1).repartition(8)
    if repeats_first:
        sample = with_repeats(sample, "t", "r", "w").where(~base_failed(F.size("w"), F.col("r"))).select("t")
    else:
        sample = sample.where(n_words(F.col("t")) >= 10)
    sample = sample.checkpoint()
    verdicts = [F.coalesce(r.rejects(F.col("t")), F.lit(False)).alias(f"v{k}") for k, r in enumerate(rules)]
    patterns = {tuple(r[:-1]): r[-1] for r in sample.select(*verdicts).groupBy(*(f"v{k}" for k in range(len(rules)))).count().collect()}
    rows = sum(patterns.values())
    seconds = costs(sample, rows, rules) if rows else dict.fromkeys((r.name for r in rules), 0.0)
    return ordered(rules, seconds, patterns)


def cascade(text: Column, order: list[Estimate]) -> Column:
    """Name of the first rule in this order that rejects the text, else null."""
    verdict = None
    for e in order:
        hit, name = e.rule.rejects(text), F.lit(e.rule.name)
        verdict = F.when(hit, name) if verdict is None else verdict.when(hit, name)
    return verdict if verdict is not None else F.lit(None).cast("string")


def judge(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Measures and verdict of each row: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, rejected_by.

    The base test (fewer than 10 words, or over 20 % of words in repeated
    5-word windows) comes first; rows that pass it go through the cascade.
    Defined results: null or empty text has zero measures and fails the base
    test; repeated rows and rows without doc_id are judged one by one; columns
    but doc_id and text are not read; an empty table gives no rows."""
    order = estimate(docs, rules, sample_rows)
    t = F.col("t")
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    df = with_repeats(df, "t", "n_repeat_words", "w")
    df = df.select("doc_id", "t", F.size("w").cast("long").alias("n_words"), word_chars(t).alias("word_chars"),
                   n_of(t, SYMBOLS).alias("n_symbols"), n_dup_lines(full_lines(t)).alias("n_dup_lines"), "n_repeat_words")
    df = df.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    df = df.withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(t, order)))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                     F.col("rejected_by").isNull().alias("kept"), "rejected_by")


def keep_good(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``: word count and cascade
    first, the repeated windows (the dearest measure) only over what is left.

    Defined results: null or empty text goes; repeated rows and rows without doc_id are
    judged one by one; columns but text are passed on unread; an empty table gives no rows."""
    names = docs.columns
    df = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    order = estimate(docs, rules, sample_rows, repeats_first=False)
    df = df.where(F.when(n_words(F.col("t")) < 10, F.lit(False)).otherwise(cascade(F.col("t"), order).isNull()))
    df = with_repeats(df, "t", "n_repeat", "w")
    return df.where(100 * F.col("n_repeat") <= 20 * F.size("w")).select("row.*")
