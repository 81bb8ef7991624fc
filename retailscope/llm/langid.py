"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of an n-gram binds (multiplies) the vectors of
its letters, each permuted (rotated) by its place; a text bundles (adds) the vectors of its n-grams, and a
language's prototype bundles its training texts. A text has the language of the prototype with the largest
cosine. Only sums of fixed length leave a task, whatever the number of texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailscope.llm.common import only_named, whole_text, worker_state

DIMENSIONS = 1024
NGRAM = 3
SYMBOLS = 0x110000  # a letter's symbol is the code point of its lower case; 0 is the gap between words
MAX_LANGUAGES = 2000  # prototypes a model holds: those of the languages with the most training texts
SEED = 9
UNDECIDED = "und"
TEXTS_AT_ONCE = 64
JUDGED_AT_ONCE = 16 * TEXTS_AT_ONCE  # texts whose vectors a task holds
CHARS_AT_ONCE = 1 << 20


def letter_symbols() -> np.ndarray:
    """The symbol of every code point: letters by their lower case, everything else 0."""
    table = np.zeros(SYMBOLS, dtype=np.int32)
    for point in range(SYMBOLS):
        char = chr(point)
        if char.isalpha():
            table[point] = ord(char.lower()[0])
    return table


class LetterVectors:
    """Random vectors of letters, each drawn from its symbol alone when the letter is first met."""

    def __init__(self):
        self.place = np.full(SYMBOLS, -1, dtype=np.int32)
        self.drawn = np.zeros((0, DIMENSIONS), dtype=np.int8)

    def of(self, symbols: np.ndarray) -> np.ndarray:
        new = np.unique(symbols[self.place[symbols] < 0])
        if len(new):
            draws = [np.random.default_rng([SEED, int(s)]).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1 for s in new]
            self.place[new] = len(self.drawn) + np.arange(len(new))
            self.drawn = np.concatenate([self.drawn, draws])
        return self.drawn[self.place[symbols]]


def bound(codes: np.ndarray, letters: LetterVectors) -> np.ndarray:
    """The vectors of n-gram codes (base ``SYMBOLS`` numbers)."""
    out = np.ones((len(codes), DIMENSIONS), dtype=np.int8)
    for place in range(NGRAM):
        out *= np.roll(letters.of(codes // SYMBOLS**place % SYMBOLS), place, axis=1)
    return out


def gram_codes(text: str, table: np.ndarray) -> Iterator[np.ndarray]:
    """The codes of a text's n-grams, a bounded stretch of it at a time; words are padded by one gap.

    An n-gram holds at least one letter; runs of other characters are a single gap.
    """
    carried = np.zeros(1, dtype=np.int32)
    for start in range(0, len(text), CHARS_AT_ONCE):
        stretch = table[np.frombuffer(text[start : start + CHARS_AT_ONCE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        last = start + CHARS_AT_ONCE >= len(text)
        symbols = np.concatenate([carried, stretch, [0]] if last else [carried, stretch])
        keep = np.ones(len(symbols), dtype=bool)
        keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
        symbols = symbols[keep].astype(np.int64)
        n = len(symbols) - NGRAM + 1
        if n > 0:
            codes = sum(symbols[i : i + n] * SYMBOLS ** (NGRAM - 1 - i) for i in range(NGRAM))
            yield codes[codes > 0]
        carried = symbols[-(NGRAM - 1) :].astype(np.int32)


def gram_counts(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = list(gram_codes(text, table))
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if len(parts) == 1:
        return np.unique(parts[0], return_counts=True)
    counted = [np.unique(p, return_counts=True) for p in parts]
    codes, place = np.unique(np.concatenate([c for c, _ in counted]), return_inverse=True)
    return codes, np.bincount(place, weights=np.concatenate([n for _, n in counted])).astype(np.int64)


def bundles(texts: list[str], table: np.ndarray, letters: LetterVectors) -> np.ndarray:
    """One vector per text: its n-gram counts times the n-grams' vectors, for some texts at a time."""
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    for start in range(0, len(texts), TEXTS_AT_ONCE):
        counted = [gram_counts(t, table) for t in texts[start : start + TEXTS_AT_ONCE]]
        codes, place = np.unique(np.concatenate([c for c, _ in counted]), return_inverse=True)
        rows = np.repeat(np.arange(len(counted)), [len(c) for c, _ in counted])
        for low in range(0, len(codes), 4096):
            inside = (place >= low) & (place < low + 4096)
            matrix = np.zeros((len(counted), min(4096, len(codes) - low)), dtype=np.float32)
            matrix[rows[inside], place[inside] - low] = np.concatenate([n for _, n in counted])[inside]
            out[start : start + len(counted)] += matrix @ bound(codes[low : low + 4096], letters).astype(np.float32)
    return out


def tables() -> tuple[np.ndarray, LetterVectors]:
    return worker_state("langid", SEED, lambda: (letter_symbols(), LetterVectors()))


def fit_prototypes(labelled: DataFrame) -> dict[str, np.ndarray]:
    """Prototypes of all languages from every row of ``labelled`` (lang, text).

    A task sends ``DIMENSIONS`` sums per language; they are added up map-side and then by Spark, and what
    comes back is one vector per language. Of more than ``MAX_LANGUAGES``, those with the most texts are
    learned (ties: the first by code point).
    """
    kept = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES)
    names = [row["lang"] for row in kept.collect()]
    labelled = labelled.where(F.col("lang").isin(names)) if len(names) == MAX_LANGUAGES else labelled

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, letters = tables()
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for start in range(0, len(texts), TEXTS_AT_ONCE):
                own = langs[start : start + TEXTS_AT_ONCE]
                vectors = bundles(texts[start : start + TEXTS_AT_ONCE], table, letters)
                for lang in set(own):
                    share = vectors[[i for i, l in enumerate(own) if l == lang]].sum(axis=0, dtype=np.float64)
                    sums[lang] = sums.get(lang, 0) + share
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(vector.astype(np.int64))],
                ["lang", "dimension", "value"],
            )

    parts = labelled.select("lang", "text").mapInArrow(bundle, "lang string, dimension int, value bigint")
    total = parts.groupBy("lang", "dimension").agg(F.sum("value").alias("value")).toPandas()
    return {
        lang: rows.sort_values("dimension")["value"].to_numpy(dtype=np.float64) for lang, rows in total.groupby("lang", sort=True)
    }


def predict(texts: Column, prototypes: dict[str, np.ndarray]) -> Column:
    """(lang_pred, score) of texts that are never null."""
    langs = list(prototypes)
    matrix = np.array([prototypes[l] / max(np.linalg.norm(prototypes[l]), 1e-300) for l in langs]).reshape(len(langs), DIMENSIONS)

    def identify(column: pa.Array) -> pa.Array:
        parts = [judge(column.slice(start, JUDGED_AT_ONCE)) for start in range(0, len(column), JUDGED_AT_ONCE)]
        return pa.concat_arrays(parts) if parts else judge(column)

    def judge(column: pa.Array) -> pa.Array:
        table, letters = tables()
        vectors = bundles(column.to_pylist(), table, letters).astype(np.float64)
        lengths = np.linalg.norm(vectors, axis=1)
        if not langs:
            return pa.StructArray.from_arrays(
                [pa.array([UNDECIDED] * len(vectors), pa.string()), pa.array(np.zeros(len(vectors)))], ["lang_pred", "score"]
            )
        cosines = vectors @ matrix.T / np.maximum(lengths, 1e-300)[:, None]
        best = cosines.argmax(axis=1)
        named = [langs[b] if n > 0 else UNDECIDED for b, n in zip(best.tolist(), lengths.tolist())]
        score = np.clip(cosines.max(axis=1), 0.0, 1.0)
        return pa.StructArray.from_arrays([pa.array(named, pa.string()), pa.array(score)], ["lang_pred", "score"])

    return F.arrow_udf(identify, "lang_pred string, score double")(texts)


def identify_languages(
    docs: DataFrame, training: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of ``docs``; with ``keep``, those input columns instead of the id.

    Prototypes come from all rows of ``training`` whose language is not null. Null texts, and texts without
    a letter, are ``und`` with score 0, as is everything when there are no training rows. ``score`` is the
    cosine with the chosen prototype, cut at 0; equal cosines go to the first language by code point.
    Whole texts are read, a bounded stretch at a time. Repeated rows are judged alike; an empty table gives
    no rows.
    """
    labelled = only_named(training, lang=lang_column, text=text_column).where(F.col("lang").isNotNull())
    prototypes = fit_prototypes(labelled.select(F.col("lang").cast("string").alias("lang"), whole_text().alias("text")))
    carried = [F.col(c) for c in keep] or [F.col(id_column).alias("doc_id")]
    names = list(keep) or ["doc_id"]
    found = docs.select(*carried, predict(whole_text(text_column), prototypes).alias("found"))
    return found.select(*names, "found.lang_pred", "found.score")


def in_fold(id_column: str, folds: int, fold: int):
    """Whether the CRC-32 of an id's decimal text leaves ``fold`` when divided by ``folds``; a null id's text is empty."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds == fold
