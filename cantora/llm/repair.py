"""Conversation structure repair by dynamic programming on a shared grammar.

Every row of a conversation is one symbol: its role's kind and whether it must
go or ends early. The cheapest edits that give the roles ``(s?(ua)+)?`` are a
path through four states, so a row is a min-plus matrix between states, and a
run of rows is the product of theirs. Equal runs occur in very many
conversations: Re-Pair turns the pairs of symbols that are most frequent over
all conversations into rules, each rule's matrix is computed once from its two
parts, and each distinct sequence is evaluated once, over its compressed form.
An entry of a matrix has a cost and a rope, the edits' initials as a tree of
shared parts.

Rows are range-partitioned by (conversation, turn) and cut into segments of at
most 4,096 rows; a product is associative, so a conversation of any length is
evaluated segment by segment in many tasks and joined in a tree. Only the last
pass, a SHA-256 over a conversation's repaired text, is sequential by nature: it
streams the sorted rows of a conversation through one task without holding them."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cantora.llm.files import written

SPACES = " \\t\\n\\u000B\\f\\r"
DELETE, REROLE, INSERT, EARLY = 2, 1, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ACCEPT = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
SEGMENT = 4096
ROUNDS, RULES_A_ROUND = 6, 16   # size of the grammar; results don't depend on it
FAN_IN = 64
FIRST_RULE = 0x100              # rule symbols are characters from here on


# ------------------------------------------------------------------- matrices
class Rope:
    """Two ropes or texts after each other; put together at most once."""

    __slots__ = ("left", "right", "whole")

    def __init__(self, left, right):
        self.left, self.right, self.whole = left, right, None

    def __str__(self):
        if self.whole is None:
            self.whole = str(self.left) + str(self.right)
        return self.whole


def _better(new: tuple, old: tuple | None) -> bool:
    return old is None or new[0] < old[0] or new[0] == old[0] and str(new[1]) < str(old[1])


def product(a: dict, b: dict) -> dict:
    """Min-plus product of {(from, to): (cost, rope)}; ties take the least text. Between
    the same two states texts of equal cost are never prefixes of each other (one more
    insertion costs more), so the least text of a whole has the least text of each part."""
    out: dict = {}
    for (i, k), (cost, text) in a.items():
        for j in range(4):
            if (k, j) in b:
                new = (cost + b[k, j][0], Rope(text, b[k, j][1]))
                if _better(new, out.get((i, j))):
                    out[i, j] = new
    return out


def insertions() -> dict:
    """Any number of inserted rows; more than two never pay."""
    out = {(s, s): (0, "") for s in range(4)}
    for s in range(4):
        out[s, NEXT[s]] = (INSERT, "I")
        if s in (START, SYSTEM):
            out[s, ASSISTANT] = (2 * INSERT, "II")
    return out


def matrix(symbol: str) -> dict:
    """One row: s, u, a or o (its role's initial; capital if it ends early), or x (must go),
    with the insertions before it."""
    row = {(s, s): (DELETE, "D") for s in range(4)}
    early = EARLY if symbol.isupper() else 0
    kind = symbol.lower()
    if kind != "x":
        for s in range(4):
            row[s, NEXT[s]] = (REROLE + early, "R")
            if {USER: "u", ASSISTANT: "a"}[NEXT[s]] == kind:
                row[s, NEXT[s]] = (early, "K")
        if kind == "s":
            row[START, SYSTEM] = (early, "K")
    return product(insertions(), row)


def fold(parts: list[dict]) -> dict:
    """Product of matrices, as a balanced tree."""
    while len(parts) > 1:
        parts = [product(*parts[k:k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


def finish(m: dict) -> tuple[int, str]:
    """Cheapest way from the start to an accepted end."""
    m, best = product(m, insertions()), None
    for s in ACCEPT:
        if (START, s) in m and _better(m[START, s], best):
            best = m[START, s]
    return best[0], str(best[1])


class Grammar:
    """Rules in the order they were made; matrices are made bottom-up, when first used."""

    def __init__(self):
        self.rules: list[str] = []
        self._matrices: dict[str, dict] = {}

    def __getstate__(self):
        return {"rules": self.rules, "_matrices": {}}

    def compress(self, symbols: str) -> str:
        for k, pair in enumerate(self.rules):
            symbols = symbols.replace(pair, chr(FIRST_RULE + k))
        return symbols

    def matrix(self, symbol: str) -> dict:
        if symbol not in self._matrices:
            k = ord(symbol) - FIRST_RULE
            self._matrices[symbol] = matrix(symbol) if k < 0 else product(*[self.matrix(x) for x in self.rules[k]])
        return self._matrices[symbol]

    def evaluate(self, symbols: str) -> dict:
        return fold([self.matrix(x) for x in self.compress(symbols)])


def learn(forms: DataFrame, rounds: int = ROUNDS, rules: int = RULES_A_ROUND) -> Grammar:
    """Re-Pair over the column ``symbols``: in each round the most frequent pairs that
    share no symbol become rules. A round counts all pairs of all rows in Spark; there are
    no more distinct pairs than the square of the symbols in use."""
    g = Grammar()
    for _ in range(rounds):
        def count(batches: Iterator[pa.RecordBatch], g=g) -> Iterator[pa.RecordBatch]:
            pairs: Counter = Counter()
            for b in batches:
                for s in b.column(0).to_pylist():
                    s = g.compress(s)
                    pairs.update(s[k:k + 2] for k in range(len(s) - 1))
            yield pa.RecordBatch.from_pydict({"pair": pa.array(list(pairs), pa.string()), "n": pa.array(list(pairs.values()), pa.int64())})

        counts = forms.select("symbols").mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        used: set[str] = set()
        for r in counts.where("n > 1").orderBy(F.desc("n"), "pair").collect():
            if len(used) < 2 * rules and not used & set(r.pair):
                used |= set(r.pair)
                g.rules.append(r.pair)
        if not used:
            break
    return g


# ------------------------------------------------------------- rows and symbols
def damage(convs: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the rows left by the planted damage. By
    crc32(conv_id:turn) % 20, 0 drops a row, 1 empties its text, 2 takes its ``.!?`` away,
    3 repeats it, 4 makes it the user's. Null roles and texts become one space."""
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    name = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    rows = convs.select(conv.alias("conv_id"), turn.alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("fate"))
    fate = F.col("fate")
    text = F.when(fate == 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.where(fate != 0).select("conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                                        F.when(fate == 3, 2).otherwise(1).cast("long").alias("copies"))


def same(a: DataFrame, b: DataFrame, *cols: str):
    out = F.lit(True)
    for c in cols:
        out = out & a[c].eqNullSafe(b[f"_{c}"])
    return out


def _content():
    """Hash of role and text."""
    return F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))


def symbols(rows: DataFrame) -> DataFrame:
    """conv_id, turn, content, copies (equal rows of a turn are one row here), initial, symbol,
    blank, repeated (role and text stand at an earlier turn). Counting equal rows and
    finding first turns are aggregates with partial sums before the shuffle."""
    end = F.expr(f"trim(TRAILING '{SPACES}' FROM text)")
    blank, early = end == "", ~F.substring(end, -1, 1).isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    one = rows.select("conv_id", "turn", _content().alias("content"), "copies", initial.alias("initial"), blank.alias("blank"),
                      F.when(blank, "x").when(early, F.upper(kind)).otherwise(kind).alias("symbol"))
    one = one.groupBy("conv_id", "turn", "content", "initial", "blank", "symbol").agg(F.sum("copies").alias("copies"))
    turn = F.struct(F.isnotnull("turn").alias("named"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = one.groupBy("conv_id", "content").agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
    first = first.select(F.col("conv_id").alias("_conv_id"), F.col("content").alias("_content"), "first")
    j = one.join(first, same(one, first, "conv_id", "content"), "left")
    return j.select("conv_id", "turn", "content", "copies", "initial", "symbol", "blank", F.coalesce(turn > F.col("first"), F.lit(False)).alias("repeated"))


SEGMENTS = ("conv_id long, part int, at long, symbols string, first_initial string, last_initial string, first_turn long, last_turn long, low long, high long, "
            "turns long, illegal long, blank long, duplicate long, truncated long")


class _Segment:
    def __init__(self, conv_id, initial: str, turn):
        self.conv_id, self.symbols, self.size = conv_id, [], 0
        self.first_initial = self.last_initial = initial
        self.first_turn = self.last_turn = turn
        self.low = self.high = turn
        self.turns = int(turn is not None)
        self.illegal = self.blank = self.duplicate = self.truncated = 0

    def add(self, symbol: str, times: int, initial: str, turn) -> None:
        if self.size:
            self.illegal += self.last_initial + initial not in LEGAL
            if turn != self.last_turn:
                self.turns += 1
        self.illegal += times - 1           # no initial may follow itself
        self.last_initial, self.last_turn, self.high = initial, turn, turn
        self.low = turn if self.low is None else self.low
        self.symbols.append(symbol)
        self.size += times

    def row(self, part: int, at: int) -> tuple:
        return (self.conv_id, part, at, "".join(self.symbols), self.first_initial, self.last_initial, self.first_turn, self.last_turn, self.low, self.high,
                self.turns, self.illegal, self.blank, self.duplicate, self.truncated)


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Segments of the sorted rows of one partition."""
    part, at, seg, done = TaskContext.get().partitionId(), 0, None, []
    schema = _schema(SEGMENTS)

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    for b in batches:
        for conv, turn, copies, initial, symbol, blank, repeated in zip(*[b.column(k).to_pylist() for k in range(7)]):
            left = copies
            while left:
                if seg is None or seg.conv_id != conv or seg.size >= most:
                    if seg is not None:
                        done.append(seg.row(part, at))
                        at += 1
                        if len(done) >= 256:
                            yield flush()
                            done.clear()
                    seg = _Segment(conv, initial, turn)
                own = left == copies and not blank and not repeated       # the first of its kind
                times = 1 if own else min(left, most - seg.size)
                seg.add(symbol if own else "x" * times, times, initial, turn)
                seg.blank += times if blank else 0
                seg.duplicate += times if not blank and not own else 0
                seg.truncated += own and symbol.isupper()
                left -= times
    if seg is not None:
        done.append(seg.row(part, at))
        yield flush()


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def segments(rows: DataFrame, most: int = SEGMENT) -> DataFrame:
    """``symbols`` of every conversation in order of turn (nulls first, then by content),
    in segments of at most ``most`` rows numbered by seg, with what the counts need."""
    spread = symbols(rows).repartitionByRange("conv_id", "turn", "content").sortWithinPartitions("conv_id", "turn", "content")
    cut = spread.select("conv_id", "turn", "copies", "initial", "symbol", "blank", "repeated").mapInArrow(lambda it: _cut(it, most), SEGMENTS)
    cut = written(cut, "repair-segments")
    order = Window.partitionBy("conv_id").orderBy("part", "at")
    return cut.withColumns({"seg": (F.row_number().over(order) - 1).cast("long"), "before_initial": F.lag("last_initial").over(order), "before_turn": F.lag("last_turn").over(order)})


# ------------------------------------------------------------------ evaluation
_ENTRIES = "array<struct<i:int,j:int,cost:long,audit:string>>"
_ENTRY = pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _entries(m: dict) -> list[dict]:
    return [{"i": i, "j": j, "cost": c, "audit": str(t)} for (i, j), (c, t) in m.items()]


def _from_entries(entries: list[dict]) -> dict:
    return {(e["i"], e["j"]): (e["cost"], e["audit"]) for e in entries}


def _evaluate(forms: DataFrame, g: Grammar) -> DataFrame:
    """symbols, cost, audit, and the matrix where a segment is part of a longer conversation."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [g.evaluate(s) for s in b.column(0).to_pylist()]
            ends = [finish(m) for m in got]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), pa.array([c for c, _ in ends], pa.int64()), pa.array([a for _, a in ends], pa.string()),
                                              pa.array([_entries(m) if many else None for m, many in zip(got, b.column(1).to_pylist())], _ENTRY)],
                                             names=["symbols", "cost", "audit", "entries"])
    return forms.select("symbols", "many").mapInArrow(work, f"symbols string, cost long, audit string, entries {_ENTRIES}")


def _join_up(t: pa.Table) -> pa.Table:
    t = t.sort_by("seg")
    m = fold([_from_entries(e) for e in t.column("entries").to_pylist()])
    cost, audit = finish(m)
    return pa.table({"conv_id": t.column("conv_id").slice(0, 1), "seg": pa.array([t.column("seg")[0].as_py() // FAN_IN], pa.int64()),
                     "cost": pa.array([cost], pa.int64()), "audit": pa.array([audit], pa.string()), "entries": pa.array([_entries(m)], _ENTRY)})


def edits(segs: DataFrame) -> DataFrame:
    """conv_id, cost, audit of every conversation."""
    segs = written(segs.select("conv_id", "seg", "symbols").withColumn("many", F.max("seg").over(Window.partitionBy("conv_id")) > 0), "repair-forms")
    forms = written(segs.groupBy("symbols").agg(F.max("many").alias("many")), "repair-distinct")
    values = _evaluate(forms, learn(forms))
    j = written(segs.join(values, "symbols").select("conv_id", "seg", "many", "cost", "audit", "entries"), "repair-values")
    out, long = j.where("not many").select("conv_id", "cost", "audit"), j.where("many")
    schema = f"conv_id long, seg long, cost long, audit string, entries {_ENTRIES}"
    while (long.agg(F.max("seg")).first()[0] or 0) > 0:
        long = written(long.select("conv_id", "seg", "entries", F.expr(f"seg div {FAN_IN}").alias("to")).groupBy("conv_id", "to").applyInArrow(_join_up, schema), "repair-joined")
    return out.unionByName(long.select("conv_id", "cost", "audit"))


# ------------------------------------------------------------------- the report
REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Writer:
    """The repaired conversation's hash, row by row, under the given edits."""

    def __init__(self, head: tuple, audit: str):
        self.head, self.audit, self.at = head, audit, 0
        self.state, self.hash, self.first = START, hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self.hash.update((("" if self.first else "\n") + role + ":" + text).encode())
        self.first = False

    def _step(self) -> str:
        self.state = NEXT[self.state]
        return "user" if self.state == USER else "assistant"

    def _insert(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._put(self._step(), "")

    def row(self, role: str, text: str) -> None:
        self._insert()
        op = self.audit[self.at]
        self.at += 1
        if op == "R":
            self._put(self._step(), text)
        elif op == "K":
            self.state = SYSTEM if role[:1] == "s" else NEXT[self.state]
            self._put(role, text)

    def end(self) -> tuple:
        self._insert()
        return (*self.head, self.audit, self.hash.hexdigest())


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, now, done = _schema(REPORT), None, []

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    for b in batches:
        for head, audit, role, text, copies in zip(*[b.column(k).to_pylist() for k in range(5)]):
            if head is not None:
                if now is not None:
                    done.append(now.end())
                    if len(done) >= 256:
                        yield flush()
                        done.clear()
                now = _Writer(tuple(head.values()), audit)
            else:
                for _ in range(copies):
                    now.row(role, text)
    if now is not None:
        done.append(now.end())
        yield flush()


def repair(convs: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of
    every conversation of ``convs`` after the planted damage.

    Defined results: null roles and texts are one space, an empty role has no initial;
    rows without conv_id are one conversation; null turns come first, and rows
    that tie in turn go by the md5 of role and text; repeated rows are duplicates; a
    conversation without rows has zeros and an empty audit; columns of other names are
    not read; an empty table has no rows."""
    rows = damage(convs)
    segs = segments(rows)
    seen = F.col("before_turn").eqNullSafe(F.col("first_turn")) & F.isnotnull("first_turn")
    clash = F.isnotnull("before_initial") & ~F.concat("before_initial", "first_initial").isin(*LEGAL)
    totals = segs.groupBy("conv_id").agg(
        (F.max("high") - F.min("low") + 1 - F.sum(F.col("turns") - seen.cast("long"))).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + clash.cast("long")).alias("illegal"))
    cheapest = edits(segs)
    names = convs.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    heads = names
    for t in (totals, cheapest):
        t = t.withColumnRenamed("conv_id", "_conv_id")
        heads = heads.join(t, same(heads, t, "conv_id"), "left").drop("_conv_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    heads = heads.select("conv_id", F.struct("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts]).alias("head"), F.coalesce("audit", F.lit("")).alias("audit"))
    body = rows.select("conv_id", "turn", _content().alias("content"), "role", "text", "copies")
    both = heads.unionByName(body, allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", F.isnull("head"), "turn", "content")
    return both.select("head", "audit", "role", "text", "copies").mapInArrow(_hash_rows, REPORT)
