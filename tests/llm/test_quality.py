import random
from collections import Counter

from helpers import ODD, WORD, frame, prose

from cantora.llm import quality


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    count = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {p for i in range(len(w) - 4) if count[tuple(w[i:i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    dup = len(lines) - len(set(lines))
    symbols, chars = sum(c in "#*$%&|<>" for c in t), sum(map(len, w))
    base = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    bad = base or 100 * symbols > 10 * len(w) or 100 * t.count("!") > 50 * len(w) or 100 * dup > 30 * len(lines) or chars > 100 * len(w)
    return len(w), chars, symbols, dup, len(covered), base, not bad


def cases():
    rng = random.Random(5)
    rows = list(ODD)
    for i in range(40):
        w = prose(rng, rng.randrange(1, 60), rng.choice([3, 30, 300])).split()
        glue = rng.choice([" ", "\n", "\t\x0b", " | ", "!! ", "*** "])
        rows.append((100 + i, glue.join(w)))
    rows.append((200, "é" * 3 + " " + " x " * 12))   # other spaces are parts of words
    rows.append((201, "a line of some words here\n" * 8 + "one more line to end this text with words"))
    return rows


def test_measures_and_verdict_match_brute_force(spark):
    rows = cases()
    got = [tuple(r)[:8] for r in quality.judge(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)


def test_cascade_order_never_changes_the_verdict(spark):
    rows, n = cases(), len(quality.RULES)
    docs = frame(spark, rows)
    order = quality.estimate(docs)
    assert sorted(e.rule.name for e in order) == sorted(r.name for r in quality.RULES)
    from pyspark.sql import functions as F
    t = F.coalesce("text", F.lit(""))
    verdicts = docs.select(*(quality.cascade(t, order[k:] + order[:k]).isNull().alias(str(k)) for k in range(n))).collect()
    assert all(len(set(r)) == 1 for r in verdicts)


def test_order_is_by_rejection_per_cost_of_what_is_left():
    """Against a brute-force version that judges the rows again for each place."""
    rng = random.Random(2)
    rules = [quality.Rule(n, None) for n in "abcd"]
    for _ in range(100):
        rows = [tuple(rng.random() < p for p in (0.1, 0.4, 0.3, 0.05)) for _ in range(rng.randrange(0, 60))]
        seconds = {n: rng.choice([1e-6, 3e-6, 2e-5]) for n in "abcd"}
        got = quality.ordered(rules, seconds, Counter(rows))
        left, names = list(rows), "abcd"
        for e in got:
            share = {n: sum(r["abcd".index(n)] for r in left) / max(len(left), 1) for n in names}
            best = max(share[n] / seconds[n] for n in names)
            assert e.rule.name == min(n for n in names if share[n] / seconds[n] == best) and e.rejected == share[e.rule.name]
            left = [r for r in left if not r["abcd".index(e.rule.name)]]
            names = names.replace(e.rule.name, "")


def test_costs_tell_a_dear_rule_from_a_cheap_one(spark):
    from pyspark.sql import functions as F
    rng = random.Random(3)
    sample = frame(spark, [(i, prose(rng, 300)) for i in range(200)]).select(F.col("text").alias("t")).repartition(4).checkpoint()
    rules = (quality.Rule("cheap", lambda t: F.octet_length(t) > 10), quality.Rule("dear", lambda t: F.size(quality.words(t)) > 10 ** 6))
    seconds = quality.costs(sample, 200, rules)
    assert seconds["dear"] > 5 * seconds["cheap"]


def test_rows_that_fail_the_base_test_do_not_count(spark):
    rng = random.Random(4)
    rows = [(i, "# " * 4) for i in range(50)] + [(100 + i, prose(rng, 30)) for i in range(45)] + [(200 + i, prose(rng, 30) + " " + "#" * 9) for i in range(5)]
    by_name = {e.rule.name: e.rejected for e in quality.estimate(frame(spark, rows))}
    assert by_name["symbols"] == 0.1 and by_name["lines"] == 0


def test_keep_good_returns_the_kept_rows_whole(spark):
    rows = cases()
    docs = frame(spark, rows)
    got = quality.keep_good(docs)
    assert got.schema.simpleString() == docs.schema.simpleString()
    assert sorted((str(r.doc_id), hash(r.text)) for r in got.collect()) == sorted((str(i), hash(t)) for i, t in rows if brute(t)[6])


def test_empty_table(spark):
    docs = frame(spark, [])
    assert quality.judge(docs).collect() == [] and quality.keep_good(docs).collect() == []
