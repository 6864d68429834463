"""Line dedup on range-partitioned line hashes, in DataFrame expressions only.

Every line of at least ``least`` characters becomes (hash of its key, document,
position). These rows are range-partitioned by (hash, block of documents) and
sorted by hash, document (largest first) and position, so that a run of one
hash streams by with its last document in front; a hash in very many documents
is spread over as many groups as it has blocks. Each group yields one summary,
summaries are summed per hash, and the rows of the hashes that are frequent
enough become one bitmap of dropped lines per document. Texts are not moved
for any of this; ``apply`` joins the bitmaps to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cantora.llm.files import written

LEAST_CHARS = 40
LEAST_DOCS = 5
BLOCK_BITS = 12          # documents of a group: ids that agree above these bits
WORD_BITS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and row, which tells rows that share a doc_id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"))


def _stripped(line: str):
    return F.expr(f"btrim({line}, ' \\t\\n\\u000B\\f\\r')")


def occurrences(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """key (16 bytes of hash), doc_id, row, pos and block of every line long enough."""
    lines = _rows(docs).select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("doc_id", "row", "pos", _stripped("line").alias("line")).where(F.char_length("line") >= least_chars)
    key = F.unhex(F.md5(F.translate("line", UPPER, LOWER).cast("binary")))
    # rows without doc_id are one document, but any number of rows: their blocks come from the text
    block = F.coalesce(F.shiftright("doc_id", BLOCK_BITS), F.col("row"))
    return lines.select(key.alias("key"), block.alias("block"), "doc_id", "row", "pos")


def frequent(occ: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """key and last (largest doc_id that holds it; null if only rows without one do)
    of the keys found in at least ``least_docs`` documents."""
    run = Window.partitionBy("key", "block").orderBy(F.desc_nulls_last("doc_id"), "pos")
    new = ~F.lag("doc_id").over(run).eqNullSafe(F.col("doc_id")) | (F.row_number().over(run) == 1)
    first = occ.repartitionByRange("key", "block").select("key", "block", "doc_id", new.alias("new")).where("new")
    groups = first.groupBy("key", "block").agg(F.count("doc_id").alias("n"), F.max("doc_id").alias("last"), F.max(F.isnull("doc_id").cast("int")).alias("unnamed"))
    keys = groups.groupBy("key").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.max("unnamed").alias("unnamed"))
    return keys.where(F.col("n") + F.col("unnamed") >= least_docs).select("key", "last")


def bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, row (xxhash64 of the text), dropped: words of 64 lines, bit k of word w
    set where line 64 * w + k goes; words after the last set bit are left out, and so
    are documents that keep all lines.

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z
    lower-cased. Lines whose key has at least ``least_chars`` characters and stands in
    at least ``least_docs`` documents go, but for those of the largest doc_id that holds
    it. Defined results: null and empty texts are one empty line; rows that share a
    doc_id are one document, and so are all rows without one, which is the smallest;
    repeated rows share a bitmap; other columns are not read; an empty table has no rows."""
    occ = written(occurrences(docs, least_chars), "line-hashes")   # texts are split and hashed once
    # a scan on this side lets Spark split the rows of a hot key at run time
    keys = written(frequent(occ, least_docs), "frequent-lines")
    gone = occ.join(keys, "key").where(~F.col("doc_id").eqNullSafe(F.col("last")))
    words = gone.groupBy("doc_id", "row", F.expr(f"pos div {WORD_BITS}").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pos % {WORD_BITS} as int))")).alias("bits"))
    rows = words.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w"))
    # zeros where words are missing: each word is preceded by the gap before it
    gap = "cast(x.word - if(i = 0, -1, w[i - 1].word) - 1 as int)"
    return rows.select("doc_id", "row", F.expr(f"flatten(transform(w, (x, i) -> concat(array_repeat(0L, {gap}), array(x.bits))))").alias("dropped"))


def apply(docs: DataFrame, maps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the remaining lines joined by newlines) of every row of docs."""
    d, m = _rows(docs), maps.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), "dropped")
    j = d.join(m, d["doc_id"].eqNullSafe(m["_doc"]) & (d["row"] == m["_row"]), "left")
    lines = F.split("text", "\n")
    kept = F.expr(f"array_join(filter(split(text, '\\n'), (x, i) -> coalesce(shiftright(get(dropped, cast(i div {WORD_BITS} as int)), cast(i % {WORD_BITS} as int)) & 1L, 0L) = 0L), '\\n')")
    n = F.aggregate(F.coalesce("dropped", F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda a, x: a + F.bit_count(x))
    return j.select("doc_id", F.size(lines).cast("long").alias("n_lines"), n.alias("n_dropped"), F.when(F.isnull("dropped"), F.col("text")).otherwise(kept).alias("kept"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row of docs."""
    out = apply(docs, bitmaps(docs))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
