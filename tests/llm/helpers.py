"""Small tables and brute-force versions for the tests of the training-data operators."""

import re
import zlib

from pyspark.sql import types as T

LONG = "Ein sehr langer Text. " * 4000


def documents(spark, rows, extra=True):
    """(doc_id, text, lang, source, n_chars) plus columns whose names clash with operators' own."""
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
    clash = ["size", "fp", "digest", "hash", "kept", "score", "found", "slots", "n", "draw", "verdict", "rule", "label"] if extra else []
    schema = T.StructType([T.StructField(n, t) for n, t in fields] + [T.StructField(n, T.StringType()) for n in clash])
    full = [(i, t, lang, source, None if t is None else len(t)) + ("x",) * len(clash) for i, t, lang, source in rows]
    return spark.createDataFrame(full, schema)


ODD_ROWS = [
    (1, "the cat sat on the mat and the dog ran off", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (None, "no id here but some words to keep", "en", "b"),
    (5, "the cat sat on the mat and the dog ran off", "en", "b"),
    (5, "the cat sat on the mat and the dog ran off", "en", "b"),
    (-6, "1234 5678 !!! ...", None, "b"),
    (7, LONG, "de", "c"),
    (8, "  two  spaces\n\nand lines \t tabs  ", "en", None),
    (9, "x" * 70000, "en", "c"),
    (10, "naïve café Straße <|endoftext|> 日本語 \U0001f600", "fr", "a"),
]


def fold(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def lowered(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def components(keys, linked):
    """Smallest member of each key's component, by union of all linked pairs."""
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    ordered = sorted(keys)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}
