import random

from helpers import ODD, WORD, frame, lower, prose

from cantora.llm import decontaminate as D

BENCH = "item_id long, text string, doc_id long, item_text string"


def bench(spark, items):
    return spark.createDataFrame([(i, t, 99, "clash") for i, t in items], BENCH)


def brute_tiles(a, b, least):
    """Textbook greedy string tiling: mark the longest unmarked match, ties by item place, then document place."""
    out, ma, mb = [], set(), set()
    while True:
        best = None
        for j in range(len(b)):
            for i in range(len(a)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in ma and j + n not in mb:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (i, j, n)
        if best is None:
            return out
        i, j, n = best
        ma.update(range(i, i + n))
        mb.update(range(j, j + n))
        out.append(best)


def brute(docs, items, least=5, percent=50):
    for i, t in docs:
        a = WORD.findall(lower(t))
        for k, u in items:
            b = WORD.findall(lower(u))
            found = brute_tiles(a, b, least) if len(b) >= least else []
            if found and 100 * sum(n for _, _, n in found) >= percent * len(b):
                yield i, k, len(b), sum(n for _, _, n in found)


def cases():
    rng = random.Random(6)
    items = [(k, prose(rng, rng.randrange(3, 40), 60)) for k in range(12)] + [(50, None), (51, ""), (52, "Two words"), (53, "a " * 9), (54, "a " * 9)]
    docs = [(i, t) for i, t in ODD if len(t or "") < 100]
    for n in range(60):
        words = WORD.findall(rng.choice(items[:12])[1])
        half = len(words) // 2
        inside = rng.choice([words, words[half:] + ["x"] + words[:half], words[:half], words[: half // 2], words[half:], [w.upper() for w in words]])
        docs.append((100 + n, " ".join([prose(rng, rng.randrange(0, 20), 60), *inside, prose(rng, 5, 60)])))
    docs.append((200, "a " * 40))
    return docs, items


def test_leaks_match_brute_force_also_over_slices(spark):
    docs, items = cases()
    want = sorted(brute(docs, items), key=str)
    assert len(want) > 30
    for size in (D.SLICE_BYTES, 300):
        got = D.leaks(frame(spark, docs), bench(spark, items), slice_bytes=size).collect()
        assert sorted((tuple(r)[:4] for r in got), key=str) == want
        assert all(sum(t.words for t in r.tiles) == r.covered_words for r in got)


def test_reordered_passage_is_caught():
    import numpy as np
    a, b = [*range(10, 20), *range(0, 10)], list(range(20))
    pairs = [(i, j) for i in range(16) for j in range(16) if a[i:i + 5] == b[j:j + 5]]
    assert D.tiles(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]), 5) == brute_tiles(a, b, 5) == [(10, 0, 10), (0, 10, 10)]


def test_clean_keeps_the_other_rows_whole(spark):
    docs, items = cases()
    docs += [(300, "y" * 80_000), (301, "b " * 30_000), (302, None)]
    bad = {i for i, *_ in brute(docs[:-3], items)}
    df = frame(spark, docs)
    out = D.clean(df, bench(spark, items), slice_bytes=400)
    assert out.dtypes == df.dtypes
    assert sorted((str(r.doc_id), hash(r.text), r.component) for r in out.collect()) == sorted((str(i), hash(t), "x") for i, t in docs if i not in bad)


def test_empty_tables(spark):
    docs, items = cases()
    assert D.leaks(frame(spark, []), bench(spark, items)).collect() == []
    assert D.leaks(frame(spark, docs), bench(spark, [])).collect() == []
    assert D.clean(frame(spark, docs), bench(spark, [])).count() == len(docs)
