import hashlib
import random
import re

from helpers import ODD, frame, prose

from cantora.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else None, "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if ok(k, m[0])]


def cases():
    rng = random.Random(8)
    parts = ["a.b@c.de", "x@y", "a@b.c%d@e.f.g", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "00012.1.1.255", "4012 8888-8888 1881", "4012888888881881",
             "4012888888881882", "+1 (988) 555-2485", "+1 (988) 555-2485 4012888888881881", "+12", "+1...........5", "é漢🙂", "tel 415 555-0199", "joe (at) mail (dot) org",
             "1:2:3:4:5:6:7:8", "a" * 30, "3782 822463 10005", "9" * 25, "12-34", "@", "++4 4", "1234.5.6.7-8 9", "x@a-b.c-d.e_f@g.hh"]
    rows = list(ODD) + [(20, "7" * 20_000), (21, "a.b-" * 8_000), (22, "+1" + " " * 5_000), (23, "1." * 10_000), (24, "a@b.c " * 1500)]
    for i in range(150):
        rows.append((100 + i, rng.choice(["", " "]).join(rng.choice([rng.choice(parts), prose(rng, 2), " ", "-", "."]) for _ in range(rng.randrange(1, 14)))))
    return rows


def test_base_spans_match_brute_force_and_stay(spark):
    rows = cases()
    got = {}
    for r in pii.report(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans))
    for i, t in rows:
        want = brute(t)
        counts = tuple(sum(w.startswith(k + ":") for w in want) for k in PATTERNS)
        mine = [g for g in got[i] if g[:5] == (*counts, hashlib.sha256(",".join(want).encode()).hexdigest())]
        assert mine, (i, (t or "")[:80], want[:5], got[i][0][5][:80])
        assert set(want) <= set(mine[0][5].split(","))


def test_proposals_are_added_where_the_labelers_agree(spark):
    rng = random.Random(1)
    rows = [(i, f"{prose(rng, 5)} call phone 415 555-01{i:02d} {prose(rng, 5)} mail joe{i}@mail.org or jim{i} (at) mail (dot) org end") for i in range(60)]
    rows += [(100 + i, f"order 415555 {prose(rng, 5)}") for i in range(30)]
    spans = {r.doc_id: r.spans for r in pii.report(frame(spark, rows)).collect()}
    assert all(spans[i].count("email:") == 2 and spans[i].count("phone:") == 1 for i in range(60))
    assert all(spans[100 + i] == "" for i in range(30))


def test_em_recovers_a_bad_labeler():
    rng = random.Random(3)
    seen = {}
    for _ in range(4000):
        y = rng.random() < 0.5
        good = lambda p: 1 if (rng.random() < p) == y else -1
        row = (0, "0", str(good(0.95)), str(good(0.9)), str(good(0.9)), str(good(0.5)), "1-" if y else "2-")
        seen[row] = seen.get(row, 0) + 1
    w = pii.fit([(*k, n) for k, n in seen.items()])
    pull = [w[f"0|{j}|1"] - w[f"0|{j}|-1"] for j in (1, 2, 3, 4)]
    assert pull[0] > 3 and pull[1] > 2 and pull[2] > 2 and abs(pull[3]) < 0.5
    assert w["0|5|1-"] > 1 > -1 > w["0|5|2-"]


def test_mask(spark):
    docs = frame(spark, [(1, "mail a.b@c.de now"), (2, None), (3, "x +1 (988) 555-2485 y 1.2.3.4"), (None, "é漢 1.2.3.4."), (5, "clean")])
    out = pii.mask(docs)
    assert out.dtypes == docs.dtypes
    assert sorted((str(r.doc_id), r.text, r.n_chars) for r in out.collect()) == sorted(
        [("1", "mail <EMAIL> now", 16), ("2", None, None), ("3", "x <PHONE> y <IP>", 16), ("None", "é漢 <IP>.", 8), ("5", "clean", None)])


def test_empty_table(spark):
    assert pii.report(frame(spark, [])).collect() == [] and pii.mask(frame(spark, [])).collect() == []
