import hashlib
import random
from collections import defaultdict

from helpers import ODD, frame, lower, prose

from cantora.llm import lines

SPACE = " \t\n\x0b\x0c\r"


def brute(docs):
    holds, last = defaultdict(set), {}
    for i, t in docs:
        for x in (t or "").split("\n"):
            k = lower(x.strip(SPACE))
            if len(k) >= 40:
                holds[k].add(i)
    for k, ids in holds.items():
        named = [i for i in ids if i is not None]
        last[k] = max(named) if named else None
    out = []
    for i, t in docs:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(holds.get(k := lower(x.strip(SPACE)), ())) < 5 or last[k] == i]
        out.append((i, len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_random_lines_against_brute_force(spark):
    rng = random.Random(3)
    pool = [prose(rng, 12) for _ in range(30)] + ["short line", "", "É" * 39, "É" * 40, "é" * 40, "A" * 40, "a" * 40]
    docs = []
    for i in range(300):
        pick = [rng.choice(pool) if rng.random() < 0.6 else prose(rng, 9) for _ in range(rng.randrange(0, 200 if i % 50 == 0 else 9))]
        docs.append((i * 1000, "\n".join(rng.choice(("", " ", "\t\r")) + x + rng.choice(("", "\x0b ", " ")) for x in pick)))
    assert rows(lines.report(frame(spark, docs))) == brute(docs)


def test_odd_rows_long_texts_and_shared_ids(spark):
    line, other = "the same line that stands in many of the documents here", "another line that some of the rows without id hold, too"
    docs = ODD + [(i, f"{line}\n\n{line} \n x{i}") for i in range(100, 104)] + [(103, f"{line}\nagain"), (None, line), (None, f"{line}\nb")]
    docs += [(i, f"{line}\n" * 20_000 + other) for i in (7, 8)] + [(None, other), (None, f"{other}\n{other}"), (9, other), (2**62, other), (-5, other)]
    assert rows(lines.report(frame(spark, docs))) == brute(docs)


def test_rows_without_id_are_one_document(spark):
    line = "x" * 50
    docs = [(None, f"{line}\n{k}") for k in range(20)] + [(k, line) for k in range(3)]
    assert rows(lines.report(frame(spark, docs))) == brute(docs)
    assert lines.bitmaps(frame(spark, docs)).collect() == []
    docs += [(4, line)]
    assert rows(lines.report(frame(spark, docs))) == brute(docs)
    assert sum(r[2] for r in brute(docs)) == 23


def test_bitmap_words_and_gaps(spark):
    line = "y" * 60
    docs = [(k, line) for k in range(10, 20)] + [(1, "\n" * 130 + line + "\n" + line + "\n" * 100)]
    got = {r.doc_id: list(r.dropped) for r in lines.bitmaps(frame(spark, docs)).collect()}
    assert got[1] == [0, 0, 0b1100] and got[10] == [1] and 19 not in got


def test_empty_table(spark):
    assert lines.report(frame(spark, [])).collect() == []
