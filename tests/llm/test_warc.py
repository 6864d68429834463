import base64
import hashlib
import os
import random

from cantora.llm import warc

PAGES = "page_id long, url string, html string, shard int, sha1 string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "clash") for r in rows], PAGES)


def brute(rows):
    kept = {}
    for i, _, h in rows:
        kept.setdefault(h or "", []).append(-1 if i is None else i)
    for i, u, h in rows:
        top = max(kept[h or ""])
        top = None if top == -1 else top
        data = (h or "").encode()
        yield (i, u, "response" if i == top else "revisit", None if i == top else top, base64.b32encode(hashlib.sha1(data).digest()).decode(), len(data), data if i == top else None)


ROWS = ([(i, f"http://x/{i}%20\n", "<p>é" * (i % 7) + "\r\n\r\nWARC/1.1\r\n") for i in range(1, 60)] + [(100 + i, None, None) for i in range(4)]
        + [(200, "u", ""), (None, "n", "<p>"), (None, None, "only"), (300, "a", "long" * 50_000), (301, "a", "long" * 50_000), (301, "a", "long" * 50_000), (2**62, "far", "z"), (-5, "neg", "z")])


def test_round_trip_and_rolling(spark, tmp_path):
    for shard_bytes, roll in ((warc.SHARD_BYTES, warc.ROLL_BYTES), (20_000, 900)):
        root = str(tmp_path / f"w{roll}")
        warc.write_archives(frame(spark, ROWS), root, shard_bytes, roll)
        got = [tuple(r) for r in warc.read_archives(spark, root).collect()]
        assert sorted(got, key=str) == sorted(brute(ROWS), key=str)
    manifest = spark.read.parquet(f"{root}/manifest").collect()
    assert len({r.shard for r in manifest}) > 1 and len(manifest) > len({r.shard for r in manifest})
    assert all(r.bytes <= 900 or r.records == 1 for r in manifest)
    assert sum(r.records for r in manifest) == len(ROWS) and not os.listdir(f"{root}/_attempts")


def test_same_bytes_for_another_partitioning(spark, tmp_path):
    def digests(n):
        root = str(tmp_path / f"d{n}")
        warc.write_archives(frame(spark, ROWS).repartition(n), root, 20_000, 900)
        return {f: hashlib.sha1(open(f"{root}/{f}", "rb").read()).hexdigest() for f in os.listdir(root) if f.endswith(".gz")}
    assert digests(1) == digests(7)


def test_far_off_and_missing_ids_leave_shards_even(spark, tmp_path):
    """One id far from the others, and rows without one: shards are as even as rows allow."""
    rng = random.Random(4)
    rows = [(i, "u", f"{i} " + "x" * rng.randrange(2000)) for i in range(300)] + [(2**62, "far", "z"), (-2**63, "low", "a")]
    rows += [(None, None, f"{i}" * 500) for i in range(300)]
    root = str(tmp_path / "far")
    warc.write_archives(frame(spark, rows), root, 50_000)
    got = [tuple(r) for r in warc.read_archives(spark, root).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    total = sum(len(h) + 512 for _, _, h in rows)
    assert len({r.shard for r in spark.read.parquet(f"{root}/manifest").collect()}) == -(-total // 50_000)
    weights = warc._borders(frame(spark, rows).selectExpr("page_id", "html", "unhex(sha1(html)) as sha1"), 50_000)
    place = {(1, i + 2**63, hashlib.sha1(h.encode()).digest()) if i is not None else (0, 0, hashlib.sha1(h.encode()).digest()): len(h) + 512 for i, _, h in rows}
    before, want = 0, {}
    for (known, n, sha1), size in sorted(place.items()):
        want.setdefault(before // 50_000, bytes([known]) + n.to_bytes(8, "big") + sha1)
        before += size
    assert [bytes(w).ljust(29, b"\0") for w in weights] == list(want.values())


def test_empty_table(spark, tmp_path):
    warc.write_archives(frame(spark, []), str(tmp_path / "e"))
    assert warc.read_archives(spark, str(tmp_path / "e")).collect() == []
