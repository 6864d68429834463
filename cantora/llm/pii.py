"""Personal data by weak supervision, in DataFrame expressions only.

Base patterns find the contract's spans (e-mail, ip, card, phone). Looser
patterns propose more. Labelers (regex, checksum, gazetteer, context, edges)
vote on every candidate; expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is, and the posteriors train a
naive-Bayes span classifier over the votes and shape features, which decides
on the proposals. Base spans stay whatever it says.

The only thing that leaves the cluster is the table of (kind, votes, shape)
counts, at most 4 * 3**5 * 12 rows whatever the corpus; EM runs on those."""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns. Possessive quantifiers and the lookbehind (or the end
# of the last match) find the same spans without trying each start in a long run.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Proposals of the method.
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++\x20?(?:\(at\)|\[at\]|@)\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z]{{2,}}+)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}[\x20.-]?[0-9]{6}[\x20.-]?[0-9]{5}(?![0-9])",
    "phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# Cheap tests that a text must pass to have a match at all.
GUARD = {
    "email": r"@|\(at\)|\[at\]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:",
    "card": r"[0-9](?:[\x20.-]?[0-9]){14}",
    "phone": r"\+[0-9]|[0-9][\x20.-][0-9]{4}",
}
# Gazetteers and context cues.
TLDS = "com org net edu gov io co uk de fr es it ch at eu info biz us ca au jp cn in br nl se"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|30|6011|65)"
CALLING = r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])[^0-9]"
CUES = {"email": "mail|contact|write", "ip": r"\bip\b|host|server|addr", "card": "card|visa|pay|credit", "phone": r"tel|phone|call|fax|mobile"}
AGAINST = r"isbn|order|version|invoice|serial|issue|\bid\b|no\.\s*$"
LABELERS = ("regex", "check", "gazetteer", "context", "edges")
AROUND = 24


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    return F.call_function("luhn_check", _digits(m))


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    return {
        "email": F.lit(True),
        "ip": m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"),
        "card": n.between(16, 19) & _luhn(m),
        "phone": n.between(8, 15),
    }[kind]


def _matches(text: Column, pattern: str, valid) -> Column:
    """(start, end, m) in code points of the matches that ``valid`` accepts: the
    text between matches and the matches themselves, added up in order."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)).alias("m"))
    one = "struct<start:int,end:int,m:string>"

    def step(acc, x):
        start = acc["pos"] + F.length(x["gap"])
        end = (start + F.coalesce(F.length(x["m"]), F.lit(0))).cast("int")
        ok = x["m"].isNotNull() & F.coalesce(valid(x["m"]), F.lit(False))
        found = F.array(F.struct(start.cast("int").alias("start"), end.alias("end"), x["m"].alias("m")))
        return F.struct(end.alias("pos"), F.when(ok, F.concat(acc["out"], found)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(zipped, F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{one}>").alias("out")), step, lambda acc: acc["out"])


def _vote(yes: Column, no: Column | None = None) -> Column:
    v = F.when(yes, F.lit(1))
    return F.coalesce((v.when(no, F.lit(-1)) if no is not None else v).otherwise(F.lit(0)), F.lit(0))


def _labels(kind: str, base: bool, m: Column, before: Column, after: Column) -> list[Column]:
    """The labelers' votes (1 for, -1 against, 0 abstains) in the order of LABELERS, then shape."""
    n, tld = F.length(_digits(m)), F.regexp_extract(F.lower(m), r"([a-z]+)$", 1)
    check = {"email": _vote(~m.contains(" ")), "ip": _vote(_valid("ip", m), F.lit(base)),
             "card": _vote(_luhn(m), F.lit(True)), "phone": _vote(n.between(10, 12), ~n.between(8, 15))}[kind]
    gazetteer = {"email": _vote(tld.isin(TLDS.split()), F.lit(True)), "ip": _vote(~m.rlike(r"^(?:0|10|127)\.|^192\.168\.")),
                 "card": _vote(_digits(m).rlike(ISSUERS), F.lit(True)), "phone": _vote(m.rlike(CALLING))}[kind]
    others = "|".join(c for k, c in CUES.items() if k != kind)
    context = _vote(before.rlike(CUES[kind]), before.rlike(f"{AGAINST}|{others}"))
    edges = _vote(~before.rlike(r"[A-Za-z0-9]$") & ~after.rlike(r"^[A-Za-z0-9]"), F.lit(True))
    shape = F.concat(F.least(F.floor(F.length(m) / 8), F.lit(5)).cast("string"), F.when(m.rlike(r"[\x20()-]"), "s").otherwise("-"))
    return [F.lit(1 if base else 0), check, gazetteer, context, edges, shape]


def _candidates(text: Column, kind: str, base: bool) -> Column:
    found = _matches(text, BASE[kind] if base else LOOSE[kind], (lambda m: _valid(kind, m)) if base else (lambda m: F.lit(True)))

    def labelled(x):
        before = F.lower(F.substring(text, F.greatest(x["start"] - AROUND, F.lit(0)) + 1, F.least(x["start"], F.lit(AROUND))))
        votes = _labels(kind, base, x["m"], before, F.substring(text, x["end"] + 1, F.lit(1)))
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.lit(base).alias("base"),
                        *(v.cast("string").alias(name) for v, name in zip(votes, (*LABELERS, "shape"))))

    return F.when(text.rlike(GUARD[kind]), F.transform(found, labelled))


def candidates(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: all candidates of the (non-null) text with their votes, base ones first."""
    arrays = [F.coalesce(_candidates(F.col(text), k, b), F.array()) for b in (True, False) for k in KINDS]
    # generated, so that no later filter pulls these expressions into itself
    return df.withColumn(out, F.explode(F.array(F.concat(*arrays))))


def fit(counts: list[tuple], rounds: int = 40) -> dict[str, float]:
    """Weights of the span classifier from (kind, votes..., shape, count) rows.

    EM: a candidate is personal or not; labelers vote independently given that,
    each with its own probabilities for a kind; start from the majority of
    votes. The posteriors then train naive Bayes over votes and shape: the sum
    of a span's weights is its log-odds."""
    rows = [(k, votes[:len(LABELERS)], votes, n) for k, *votes, n in counts]
    post = [1 / (1 + math.exp(-sum(map(int, v)))) for _, v, _, _ in rows]

    def tables(width):
        prior, seen = defaultdict(lambda: [1.0, 1.0]), defaultdict(lambda: [1.0, 1.0])
        for (k, _, features, n), p in zip(rows, post):
            for y, w in enumerate((n * (1 - p), n * p)):
                prior[k][y] += w
                for j, f in enumerate(features[:width]):
                    seen[k, j, f][y] += w
        return prior, seen

    def weights(width):
        prior, seen = tables(width)
        kinds = {j: len({f for (_, i, f) in seen if i == j}) for j in range(width)}
        out = {str(k): math.log(p[1] / p[0]) for k, p in prior.items()}
        for (k, j, f), s in seen.items():
            out[f"{k}|{j}|{f}"] = math.log(s[1] / (prior[k][1] + kinds[j])) - math.log(s[0] / (prior[k][0] + kinds[j]))
        return out

    for _ in range(rounds):
        w = weights(len(LABELERS))
        post = [1 / (1 + math.exp(-max(-50.0, min(50.0, w[str(k)] + sum(w[f"{k}|{j}|{f}"] for j, f in enumerate(v)))))) for k, v, _, _ in rows]
    return weights(len(LABELERS) + 1)


def _score(x: Column, table: Column) -> Column:
    names = [F.concat_ws("|", x["kind"].cast("string"), F.lit(str(j)), x[c]) for j, c in enumerate((*LABELERS, "shape"))]
    return reduce(lambda a, b: a + b, (F.coalesce(F.try_element_at(table, n), F.lit(0.0)) for n in (x["kind"].cast("string"), *names)))


def train(docs: DataFrame) -> dict[str, float]:
    """The classifier's weights, from the votes on all candidates of all texts."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    names = ["kind", *LABELERS, "shape"]
    counts = candidates(texts, "t", "c").select(F.explode("c").alias("x")).groupBy(*(F.col(f"x.{n}").alias(n) for n in names)).count()
    return fit(sorted(tuple(r) for r in counts.collect()))


def find(df: DataFrame, text: str, out: str, weights: dict[str, float]) -> DataFrame:
    """Add ``out``: struct of ``base`` and ``all`` arrays of (kind, start, end), sorted by kind and start."""
    table = F.create_map(*(F.lit(x) for item in (weights or {"": 0.0}).items() for x in item))
    df = candidates(df, text, "_c")
    slim = lambda a: F.transform(a, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    df = df.withColumn("_base", F.filter("_c", lambda x: x["base"]))
    free = lambda x: ~F.exists("_base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    df = df.withColumn("_more", F.filter("_c", lambda x: ~x["base"] & (_score(x, table) >= 0) & free(x)))
    both = F.struct(F.sort_array(slim(F.col("_base"))).alias("base"), F.sort_array(slim(F.concat("_base", "_more"))).alias("all"))
    return df.withColumn(out, both).drop("_c", "_base", "_more")


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row.

    Defined results: null text is empty; repeated rows and rows without doc_id
    are searched one by one; columns but doc_id and text are not read; an empty
    table gives no rows. Whole texts are searched."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    found = find(rows, "t", "f", train(docs))
    of = lambda k: F.size(F.filter("f.base", lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", *(of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
                        F.sha2(_joined(F.col("f.base")), 256).alias("base_sha256"), _joined(F.col("f.all")).alias("spans"))


def mask(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in angle brackets
    (overlapping spans by the first one's); n_chars, if there, follows the text."""
    names = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    found = find(rows, "t", "f", train(docs))
    by_start = F.array_sort(F.transform("f.all", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    found = found.withColumn("s", F.when(F.size("f.all") > 0, by_start))
    labels = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))

    def step(acc, x):
        begun = x["start"] >= acc["pos"]
        text = F.when(begun, F.concat(acc["out"], F.substring(F.col("t"), acc["pos"] + 1, x["start"] - acc["pos"]), F.get(labels, x["kind"]))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["pos"], x["end"]).alias("pos"), text.alias("out"))

    done = F.aggregate("s", F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(F.col("t"), acc["pos"] + 1, F.length("t"))))
    found = found.withColumn("masked", F.explode(F.array(done)))
    new = {"text": F.coalesce("masked", "row.text")}
    if "n_chars" in names:
        kind = dict(docs.dtypes)["n_chars"]
        new["n_chars"] = F.when(F.col("masked").isNotNull(), F.length("masked")).otherwise(F.col("row.n_chars")).cast(kind)
    return found.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in names))
