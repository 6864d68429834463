import hashlib
import random
import zlib

from helpers import DOCS, ODD, frame

from cantora.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    """All levels of the tree over nodes, by the definition."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[k:k + 2]) for k in range(0, len(below), 2)])
    return levels


def siblings(levels, i):
    out = []
    for below in levels[:-1]:
        j = i ^ 1
        out.append((j < i, below[j] if j < len(below) else ""))
        i >>= 1
    return out


def leaf(doc_id, lang, source, n_chars, text):
    f = [None if x is None else str(x) for x in (doc_id, source, lang, n_chars, text)]
    return H(*["-" if x is None else f"{len(x.encode())}:{x}" for x in f])


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    sub, of = [], {}
    for lang in order:
        rs = sorted(trees[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r[0], r[2], r[3], r[4], r[1])))
        of[lang] = rs, climb([leaf(r[0], r[2], r[3], r[4], r[1]) for r in rs])
        sub.append(of[lang][1][-1][0])
    top, out = climb(sub), []
    for k, lang in enumerate(order):
        rs, levels = of[lang]
        for i, (doc_id, text, _, source, n_chars) in enumerate(rs):
            steps = siblings(levels, i) + siblings(top, k)
            hit = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            acc = leaf(doc_id, lang, source, n_chars + hit, text) if hit else levels[0][i]
            for left, d in steps:
                acc = H(d, acc) if left else H(acc, d)
            out.append((doc_id, levels[0][i], sub[k], top[-1][0], H(*[d for _, d in steps]), acc, acc == top[-1][0]))
    return sorted(out, key=str)


def got(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 5, "c", None) for r in rows], DOCS)
    return sorted((tuple(r) for r in merkle.manifest(df, **kw).collect()), key=str)


def test_trees_of_many_sizes(spark):
    rng = random.Random(5)
    sizes = {"en": 700, "de": 1, "fr": 2, None: 3, "": 64, "zh": 65, "é": 5}
    rows = [(i if rng.random() < 0.9 else None, f"t{rng.random()}", lang, rng.choice(["a", None]), rng.choice([None, 2**63 - 1, 5]))
            for i, lang in enumerate(x for x, n in sizes.items() for _ in range(n))]
    want = brute(rows)
    assert got(spark, rows) == want
    assert {r[-1] for r in want} == {True, False}


def test_rounds_of_small_blocks_give_the_same_tree(spark):
    rows = [(i, "x", "en", None, i) for i in range(133)] + [(i, "y", f"l{i % 21:02}", None, i) for i in range(200, 290)]
    assert got(spark, rows, bits=2) == brute(rows)


def test_more_leaves_than_a_block(spark):
    rows = [(i, str(i), "en" if i % 3 else "de", "s", i) for i in range(14_000)]
    assert got(spark, rows) == brute(rows)


def test_odd_repeated_and_single_rows(spark):
    rows = [(i, t, "en", "s", n) for i, t in ODD for n in (None, 7)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[:1]) == brute(rows[:1])


def test_a_proof_fails_on_any_other_leaf():
    levels = merkle.forward([H(str(i)) for i in range(11)], None)
    proofs = merkle.backward(levels, ())
    assert all(merkle.fold(levels[0][i], p) == levels[-1][0] for i, p in enumerate(proofs))
    assert not any(merkle.fold(levels[0][i], proofs[i - 1]) == levels[-1][0] for i in range(11))


def test_empty_table(spark):
    assert merkle.manifest(frame(spark, [])).collect() == []
