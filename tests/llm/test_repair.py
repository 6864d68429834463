import hashlib
import random
import re
import zlib
from functools import lru_cache
from itertools import product as tuples

from cantora.llm import repair

SF = "/root/testdata/sf0.01"
COLS = "conv_id long, turn long, role string, text string, head string, audit string, copies long"


def md5(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out[conv] += [(turn, role, text)] * (2 if fate == 3 else 1)
    for conv in out:
        out[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, md5(r[1], r[2])))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """Cost and least audit by the recursion on rows left and the roles written so far."""
    # insertions: at every place, up to two before each row
    @lru_cache(None)
    def full(i, state):
        best = (10**9, "")
        for k in range(3):
            s, cost = state, 5 * k
            for _ in range(k):
                s = "a" if s == "u" else "u"
            if i == len(rows):
                if s in ("", "a"):
                    best = min(best, (cost, "I" * k))
                continue
            want = "a" if s == "u" else "u"
            ways = [(2, "D", s)]
            if fault[i] not in ("blank", "duplicate"):
                early = 5 if fault[i] else 0
                ways.append((1 + early, "R", want))
                initial = rows[i][1][:1]
                if initial == want or (initial == "s" and s == ""):
                    ways.append((early, "K", initial))
            for c, op, to in ways:
                rest = full(i + 1, to)
                best = min(best, (cost + c + rest[0], "I" * k + op + rest[1]))
        return best
    return full(0, "")


def repaired(rows, audit):
    out, it, last = [], iter(rows), ""
    for op in audit:
        role, text = "", ""
        if op != "I":
            _, role, text = next(it)
        if op == "D":
            continue
        want = "assistant" if last == "u" else "user"
        role = role if op == "K" else want
        last = role[:1]
        out.append((role, text))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out)) and next(it, None) is None
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def brute(rows):
    out = []
    for conv, rs in damaged(rows).items():
        f = faults(rs)
        turns = [r[0] for r in rs if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:]))
        cost, audit = cheapest(rs, f)
        out.append((conv, gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit, repaired(rs, audit)))
    return sorted(out, key=str)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "h", "a", 9) for r in rows], COLS)
    return sorted((tuple(r) for r in repair.repair(df).collect()), key=str)


def test_given_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert sorted((tuple(r) for r in repair.repair(df).collect()), key=str) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_random_conversations(spark):
    rng, rows = random.Random(4), []
    for conv in range(150):
        for turn in range(rng.randrange(0, 12)):
            rows.append((conv, rng.choice([turn, turn, turn * 2, None if rng.random() < 0.2 else turn]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "s"]),
                         rng.choice(["a.", "b!", "c?", "d", "e \n", "  \t", "", None, "Ü.", f"{turn}.", f"{conv} {turn}!", f"{conv}{turn}. \x0b"])))
    rng.shuffle(rows)
    assert got(spark, rows) == brute(rows)


def test_long_odd_and_repeated_rows(spark):
    rng = random.Random(8)
    rows = [(None, k % 40, rng.choice(["user", "assistant"]), f"t{rng.randrange(30)}.") for k in range(120)]
    rows += [(1, None, "user", "same.")] * 5 + [(1, 3, "user", "same.")] * 3 + [(2, -2**40, "x" * 3000, "y" * 200_000), (2, 2**40, "user", "z. " * 50_000)]
    assert got(spark, rows) == brute(rows)


def test_conversations_of_many_segments(spark):
    rng = random.Random(2)
    rows = [(c, k, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice([f"{k}.", f"{k}.", "again.", "end"])) for c in (1, 2) for k in range(400 * c)]
    df = spark.createDataFrame([(*r, "h", "a", 9) for r in rows], COLS)
    segs = repair.segments(repair.damage(df), most=5)
    assert segs.agg({"seg": "max"}).first()[0] >= 128
    have = {r.conv_id: (r.cost, r.audit) for r in repair.edits(segs).collect()}
    import sys
    sys.setrecursionlimit(20_000)
    assert have == {c: cheapest(rs, faults(rs)) for c, rs in damaged(rows).items()}


def test_grammar_gives_the_plain_product():
    rng, g = random.Random(1), repair.Grammar()
    g.rules = ["ua", chr(0x100) * 2, "x" + chr(0x101)]
    for _ in range(100):
        s = "".join(rng.choice("suaoSUAOxxuauaua") for _ in range(rng.randrange(1, 60)))
        plain = repair.Grammar().evaluate(s)
        assert {k: (c, str(t)) for k, (c, t) in g.evaluate(s).items()} == {k: (c, str(t)) for k, (c, t) in plain.items()}


def test_all_audits_of_short_sequences():
    """Every edit string up to a length, tried one by one."""
    for n in range(4):
        for s in tuples("suoxU", repeat=n):
            best = None
            for length in range(n, n + 5):
                for ops in tuples("DIKR", repeat=length):
                    if sum(o != "I" for o in ops) != n:
                        continue
                    it, roles, cost = iter(s), "", 0
                    for o in ops:
                        x = next(it) if o != "I" else ""
                        want = "a" if roles[-1:] == "u" else "u"
                        if o == "D":
                            cost += 2
                        elif x == "x":
                            cost = 10**6
                        else:
                            cost += {"I": 5, "K": 0, "R": 1}[o] + (5 if x.isupper() else 0)
                            roles += x.lower() if o == "K" else want
                    if cost < 10**6 and re.fullmatch("(s?(ua)+)?", roles):
                        best = min(best or (cost, "".join(ops)), (cost, "".join(ops)))
            m = repair.Grammar().evaluate("".join(s)) if s else repair.insertions()
            assert repair.finish(m) == best, s


def test_empty_table(spark):
    assert got(spark, []) == []
