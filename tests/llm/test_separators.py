import random

import numpy as np
import public_tokenizers
from helpers import ODD, frame
from tokenizers import Tokenizer

from cantora.llm import separators

JSON = public_tokenizers.path("byte_bpe_50k.json")


def test_counts_equal_the_tokenizer(spark, tmp_path):
    t = Tokenizer.from_file(JSON)
    for k, rows in enumerate((ODD, [(i, "word " * i) for i in range(30)])):
        root = str(tmp_path / str(k))
        files = separators.write_flat(frame(spark, rows), JSON, root)
        for block in (separators.BLOCK_TOKENS, 7):
            if block == 7 and rows is ODD:
                continue
            got = separators.count_tokens(spark, files, root, block_tokens=block).collect()
            assert sorted(r.n_tokens for r in got) == sorted(len(t.encode(x or "", add_special_tokens=False).ids) for _, x in rows)
            assert all(r.terminated for r in got)


def test_stitching_matches_a_plain_scan(spark, tmp_path):
    rng = random.Random(9)
    listed, want = [], []
    for part in range(12):
        ids = [rng.choice([0, 1, 2, 9]) if part % 3 else rng.choice([1, 1, 1, 9]) for _ in range(rng.choice([0, 1, 5, 64, 200]))]
        ids = [1] * 50 if part == 5 else [9] * 20 if part == 6 else ids
        np.array(ids, "<u2").tofile(tmp_path / f"f{part}")
        listed.append((part, f"f{part}", len(ids)))
        start = no = 0
        for k, x in enumerate(ids):
            if x == 9:
                want.append((part, no, start, k - start, True))
                start, no = k + 1, no + 1
        if start < len(ids):
            want.append((part, no, start, len(ids) - start, False))
    files = spark.createDataFrame(listed, "part int, file string, tokens long")
    for block in (1, 8, 1000):
        got = separators.count_tokens(spark, files, str(tmp_path), separator=9, block_tokens=block).collect()
        assert sorted(tuple(r) for r in got) == sorted(want)


def test_empty_table(spark, tmp_path):
    files = separators.write_flat(frame(spark, []), JSON, str(tmp_path / "e"))
    assert separators.count_tokens(spark, files, str(tmp_path / "e")).collect() == []
