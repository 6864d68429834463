import hashlib
import random
from collections import Counter

from helpers import ODD, frame, prose

from cantora.llm import suffixes


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[s:s + length] for t in texts for s in range(len(t) - length + 1))
    for (i, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if count[t[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        yield i, len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()


def cases(seed, shared):
    rng = random.Random(seed)
    common = [prose(rng, shared) for _ in range(6)]
    rows = []
    for i in range(70):
        parts = [prose(rng, rng.randrange(0, 30)) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(common)[rng.randrange(0, 40):rng.choice([None, -30, 90])])
        rows.append((i, " é".join(parts)))
    rows += [(100 + i, rows[i][1]) for i in range(4)] + [(200, "ab" * 300), (201, "y" * 500), (202, prose(rng, 40) * 2)]
    return rows


def check(spark, rows, length, gram, **kw):
    got = [tuple(r) for r in suffixes.remove_repeats(frame(spark, rows), length, gram, **kw).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, length), key=str)


def test_matches_brute_force(spark):
    check(spark, cases(1, 60), 60, 8)


def test_contract_lengths_and_odd_rows(spark):
    odd = [(i, t[:3000] if t else t) for i, t in ODD]
    check(spark, odd + cases(2, 160), suffixes.LENGTH, suffixes.GRAM, batches=3)


def test_offsets_in_blocks(spark, monkeypatch):
    import numpy as np
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 99, 40, dtype=np.uint8)) for _ in range(30)]
    data, start = np.frombuffer(b"".join(texts), np.uint8), np.arange(30) * 40
    args = (np.zeros(30, np.uint64), np.full(30, 20), np.full(30, 20), np.ones(30, np.int64), data, start, 6)
    whole = [x.tolist() for x in suffixes._repeated(*args)]
    monkeypatch.setattr(suffixes, "_WINDOWS", 64)
    assert [x.tolist() for x in suffixes._repeated(*args)] == whole and whole[0]


def test_kept_bytes_can_be_returned(spark):
    rows = [(1, "a" * 10 + "the same forty bytes stand in both texts" + "b"), (2, "c" + "the same forty bytes stand in both texts")]
    got = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(frame(spark, rows), 40, 8, with_text=True).collect()}
    assert got == {1: b"a" * 10 + b"b", 2: b"c"}


def test_levels_merge_geometrically(spark):
    index = suffixes.Index(spark, 60, 8)
    texts = frame(spark, cases(3, 60)).selectExpr("unhex(md5(text)) as key", "text")
    for _ in range(6):
        index.add(texts)
    assert [size for size, _ in index.levels] == [4, 1, 1]


def test_empty_table(spark):
    assert suffixes.remove_repeats(frame(spark, [])).collect() == []
