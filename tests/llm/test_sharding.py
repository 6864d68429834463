import random
import zlib
from collections import Counter, defaultdict

from helpers import ODD, frame, prose

from cantora.llm import sharding


def check(rows, docs, shards):
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
    slots, groups, load = defaultdict(list), defaultdict(set), [0] * shards
    for r in rows:
        slots[r.shard].append(r.slot)
        groups[r["size"], r.text_crc32].add(r.shard)
        load[r.shard] += r["size"]
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(g) == 1 for g in groups.values())
    return load


def test_near_equal_bytes_and_whole_groups(spark):
    rng = random.Random(1)
    docs = [(i, prose(rng, rng.randrange(1, 200))) for i in range(400)]
    docs += [(1000 + i, docs[i % 20][1]) for i in range(60)]
    load = check(sharding.shard(frame(spark, docs)).collect(), docs, 8)
    assert max(load) <= 1.02 * min(load)


def test_odd_rows_and_a_group_beyond_an_even_share(spark):
    docs = ODD + [(i, "copy " * 900) for i in range(500, 560)]
    load = check(sharding.shard(frame(spark, docs)).collect(), docs, 8)
    assert max(load) == 60 * 4501


def by_hand(sizes, bins, capacity):
    """Best-fit decreasing one group at a time."""
    gaps, out = [capacity] * bins, []
    for s in sizes:
        fits = [(g, b) for b, g in enumerate(gaps) if g >= s]
        if not fits:
            return None
        gaps[min(fits)[1]] -= s
        out.append((s, min(fits)[1]))
    return out, gaps


def test_runs_of_equal_groups_are_placed_as_one_by_one():
    rng = random.Random(7)
    for _ in range(300):
        counts = {rng.randrange(1, 60): rng.randrange(1, 9) for _ in range(rng.randrange(1, 12))}
        sizes = [s for s, n in sorted(counts.items(), reverse=True) for _ in range(n)]
        bins, capacity = rng.randrange(1, 9), rng.randrange(max(counts), 2 * sum(sizes))
        got, want = sharding.best_fit(sorted(counts.items(), reverse=True), bins, capacity), by_hand(sizes, bins, capacity)
        assert (got is None) == (want is None)
        if got is not None:
            assert sorted(one_by_one(got, counts)) == sorted(want[0])


def one_by_one(plan, counts):
    for (s, first, b), after in zip(plan, [*plan[1:], (None, 0, 0)]):
        yield from [(s, b)] * ((after[1] if after[0] == s else counts[s]) - first)


def test_plan_is_at_the_least_capacity():
    rng = random.Random(9)
    for _ in range(200):
        counts = {rng.randrange(1, 50): rng.randrange(1, 20) for _ in range(rng.randrange(1, 12))}
        bins = rng.randrange(1, 9)
        sizes = [s for s, n in sorted(counts.items(), reverse=True) for _ in range(n)]
        placed = list(one_by_one(sorted(sharding.plan(counts, bins), key=lambda x: (-x[0], x[1])), counts))
        assert sorted(s for s, _ in placed) == sorted(sizes) and all(0 <= b < bins for _, b in placed)
        load = Counter()
        for s, b in placed:
            load[b] += s
        alone, left = 0, sum(sizes)
        while alone < min(len(sizes), bins - 1) and sizes[alone] * (bins - alone) > left:
            left -= sizes[alone]
            alone += 1
        rest = sizes[alone:]
        if rest:
            least = next(c for c in range(max(rest[0], -(-left // (bins - alone))), left + 1) if by_hand(rest, bins - alone, c))
            top = sorted(load.values(), reverse=True)[alone:][:1]
            assert top and top[0] <= least + max(1, least // 100)


def test_empty_table(spark):
    assert sharding.shard(frame(spark, [])).collect() == []
