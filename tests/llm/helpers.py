"""Brute-force counterparts and odd inputs shared by the tests of cantora.llm."""
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, component string, key string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n=5):
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def frame(spark, rows):
    """documents with clashing extra columns; rows are (doc_id, text)."""
    return spark.createDataFrame([(i, t, "en", "s", None, 7, "x", None) for i, t in rows], DOCS)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \t\n "), (None, "a b c d e f g"), (None, None), (4, "one two"), (5, "ONE two"),
       (6, "x" * 70_000), (7, "é ü   ñ 漢字 a b"), (8, "same words in this short text"), (8, "same words in this short text"),
       (9, "same words in this short text"), (10, "a " * 30_000)]
