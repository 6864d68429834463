import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import ODD, frame, prose

from cantora.llm import packing
from cantora.llm.tokens import Encoder

JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ids_of():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_encoder_gives_the_ids_of_tokenizers(spark, ids_of):
    e = Encoder(JSON)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for t in [*texts, "a<|endoftext|>b", " \n\n x  y\t\t", "   ", "I'll it's 12 34 　z", "漢字かな 🙂🙂", "x" * 9000, "é" * 300]:
        assert [*e.encode(t).tolist(), 0] == ids_of(t), t[:60]


def check(rows, docs, capacity, ids_of):
    want = defaultdict(list)
    for i, t in docs:
        want[i].append(ids_of(t))
    at, per_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
        per_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for spans in at.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    for i, lists in want.items():
        expect = []
        for ids in lists:
            first = len(ids) % capacity or capacity
            cuts = [0, *range(first, len(ids), capacity), len(ids)]
            expect += [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(per_doc[i]) == sorted(expect)
    return len(at)


def test_odd_rows_round_trip(spark, ids_of):
    rng = random.Random(2)
    docs = ODD + [(100 + i, prose(rng, rng.randrange(0, 300))) for i in range(80)]
    rows = packing.pack(frame(spark, docs), JSON, 256).collect()
    total = sum(len(ids_of(t)) for _, t in docs)
    assert check(rows, docs, 256, ids_of) <= -(-total // 256) + 2


def test_ids_can_be_returned(spark, ids_of):
    r = packing.pack(frame(spark, [(1, "some words")]), JSON, with_ids=True).first()
    assert r.ids == ids_of("some words")


def test_plan_uses_every_piece_once():
    rng = random.Random(4)
    for capacity in (1, 2, 7, 64):
        for _ in range(30):
            counts = {s: rng.randrange(1, 40) for s in rng.sample(range(1, capacity + 1), rng.randrange(1, capacity + 1))}
            plan = packing.intervals(counts, capacity)
            bins, seen = defaultdict(list), 0
            for length, n in counts.items():
                mine = [p for p in plan.tolist() if p[0] == length]
                for r in range(n):
                    _, first, per, sequence, offset = [p for p in mine if p[1] <= r][-1]
                    bins[sequence + (r - first) // per].append((offset + (r - first) % per * length, length))
                    seen += 1
            assert seen == sum(counts.values())
            for spans in bins.values():
                end = 0
                for offset, length in sorted(spans):
                    assert offset == end
                    end += length
                assert end <= capacity


def test_exact_fills_beat_greedy_halves():
    # 6+4 and 5+3+2 fill all; best fit decreasing alone needs one more
    assert len(packing.intervals({6: 1, 5: 1, 4: 1, 3: 1, 2: 1}, 10)) == 5
    left = [0, 0, 1, 1, 1, 1, 1, 0, 0, 0, 0]
    assert sum(t for _, t in packing.exact_fills(left, 10)) == 2 and not any(left)


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), JSON).collect() == []


def test_special_token_strings_are_their_ids(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(JSON)
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> y<|endoftext|><|endoftext|>", "w " * 30 + "<|endoftext|>", "y" * 3000 + "<|endoftext|> \n", "no special token", "<|endoftext|", ""]
    ids = [[*t.encode(x, add_special_tokens=False).ids, 0] for x in texts]
    assert 50256 in ids[0]
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack(frame(spark, list(enumerate(texts))), JSON).collect()}
    assert got == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in enumerate(ids)}
