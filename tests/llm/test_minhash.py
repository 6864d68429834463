import random

from helpers import ODD, frame, prose, shingles

from cantora.llm.minhash import near_duplicates


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: top(i) for i in root}


def check(spark, rows, **kw):
    got = [tuple(r) for r in near_duplicates(frame(spark, rows), **kw).collect()]
    want = brute(rows)
    assert sorted(got, key=str) == sorted(((i, len(shingles(t)), want.get(i), i is None or want[i] == i) for i, t in rows), key=str)


def test_matches_brute_force_on_edited_copies(spark):
    rng = random.Random(3)
    rows = []
    for base in range(12):
        words = prose(rng, rng.randrange(30, 200)).split()
        for copy in range(rng.randrange(1, 12)):
            w = list(words)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    check(spark, rows)
    check(spark, rows, block=4)  # families over several blocks


def test_odd_rows(spark):
    check(spark, ODD)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).collect() == []


def test_rows_that_share_an_id_are_one_document(spark):
    a, b = "p q r s t u v w", "h i j k l m n o"
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, [(5, a), (5, b), (3, a), (4, b)])).collect()}
    assert got == {3: 3, 4: 3, 5: 3}
