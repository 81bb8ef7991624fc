"""How far the sources of a language differ in their words.

Texts are tokenized as bytes: one translation table lowers A-Z and blanks separators, ``split`` gives the
words and a counter per document the frequencies. A task sums what it has seen for each group and word before
anything is shuffled; all later tables are sparse, with a row only for words that occur. Where absent words
matter (sources against each other), words are dealt to buckets of bounded size, in which every source has a
dense row, and only sums per pair of sources leave a bucket. All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailscope.functions.hotkeys import join_groups
from retailscope.llm.common import only_named, whole_text
from retailscope.sources.shared import materialize

LEAST_DOCUMENTS = 3
MOST_TERMS = 200
SCALE = 1_000_000_000
HELD_TERMS = 400_000  # counters a task holds before it passes them on
CELLS = 1 << 20  # sources times words of a bucket
LETTERS = {*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in LETTERS else 0x20 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def count_words(rows: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) sums by task; every group also has a row without a term."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, Counter] = defaultdict(Counter)
        holders: dict[tuple, Counter] = defaultdict(Counter)
        held = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, source), own in totals.items():
                terms, docs = [None, *own], holders[lang, source]
                yield pa.RecordBatch.from_pydict({
                    "lang": [lang] * len(terms), "source": [source] * len(terms), "term": pa.array(terms, pa.binary()),
                    "n": pa.array([0, *own.values()], pa.int64()), "docs": pa.array([0, *(docs[t] for t in own)], pa.int64()),
                })
            totals.clear()
            holders.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                own, total = Counter(words(text.as_py())), totals[lang, source]
                before = len(total)
                total.update(own)
                holders[lang, source].update(iter(own))
                held += len(total) - before
                if held > HELD_TERMS:
                    yield from flushed()
                    held = 0
        yield from flushed()

    return rows.mapInArrow(counted, "lang string, source string, term binary, n bigint, docs bigint")


def share(count: str, size: str) -> Column:
    """1 + floor(SCALE * (count + 1) / size), exact beyond 64 bits."""
    return F.expr(f"1 + (cast({SCALE} AS decimal(10, 0)) * cast({count} + 1 AS decimal(20, 0))) div cast({size} AS decimal(20, 0))")


def distance(p: str, q: str) -> Column:
    """floor((p - q)^2 / q); shares stay below 2^30, so the square fits."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def bucket_sums(key: tuple, terms: pa.Table, sources: pa.Table) -> pa.Table:
    """Distances of all pairs of sources over the words of one bucket."""
    names, absent = sources.column("source"), sources.column("absent").to_numpy()
    row = {name: i for i, name in enumerate(names.to_pylist())}
    encoded = terms.column("term").combine_chunks().dictionary_encode()
    shares = np.repeat(absent[:, None], len(encoded.dictionary), axis=1)
    shares[[row[s] for s in terms.column("source").to_pylist()], encoded.indices.to_numpy()] = terms.column("p").to_numpy()
    values = np.zeros((len(row), len(row)), dtype=np.int64)
    for i in range(len(row) if terms.num_rows else 0):
        apart = shares[i] - shares
        values[i] = (apart * apart // shares).sum(axis=1)
    first, second = np.nonzero(~np.eye(len(row), dtype=bool))
    return pa.table({
        "lang": pa.array([key[0].as_py()] * len(first), pa.string()), "source": names.take(pa.array(first)),
        "item": names.take(pa.array(second)), "value": values[first, second],
    })


def audit_sources(
    docs: DataFrame, least: int = LEAST_DOCUMENTS, most: int = MOST_TERMS,
    text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group of documents that share language and source.

    Null texts, languages and sources count as empty. Words are runs of letters and characters beyond ASCII,
    A-Z lowered; a language keeps those in ``least`` of its documents. A word's share in a group, or in the
    language, is 1 + floor(10^9 (count + 1) / (words + kept words)), and its distance floor((p - q)^2 / q)
    for the group's share p. Part ``pair`` has the group's distance from each other source of the language,
    summed over all kept words (0 without any); part ``term`` the kept words in the group whose share is
    above the language's, by distance from it, the first ``most``. Equal values are ranked by item, in
    UTF-8 order. Repeated rows are documents like others; a language with one source has no pairs; an
    empty table gives no rows.
    """
    rows = only_named(docs, lang=lang_column, source=source_column, text=text_column)
    rows = rows.select(whole_text("lang").alias("lang"), whole_text("source").alias("source"), whole_text().cast("binary").alias("text"))
    counts = materialize(
        count_words(rows).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "audit-counts")
    occurring = counts.where("term IS NOT NULL")
    kept = occurring.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least)
    found = materialize(occurring.drop("docs").join(kept.drop("docs"), ["lang", "term"]), "audit-kept")

    langs = found.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_words"))
    own = found.groupBy("lang", "source").agg(F.sum("n").alias("words"), F.count(F.lit(1)).alias("terms"))
    sources = counts.where("term IS NULL").select("lang", "source")
    many = sources.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    none = {"v": 0, "lang_words": 0, "words": 0, "terms": 0}
    groups = sources.join(many, "lang").join(langs, "lang", "left").join(own, ["lang", "source"], "left").fillna(none)
    buckets = F.greatest(F.lit(1), F.ceil(F.col("v") * F.col("sources") / F.lit(float(CELLS)))).cast("int")
    absent = F.when(F.col("v") > 0, share("0", "greatest(words + v, 1)")).otherwise(F.lit(0).cast("bigint"))
    groups = materialize(groups.withColumns({"buckets": buckets, "absent": absent}), "audit-groups")
    total = groups.agg(F.coalesce(F.sum("terms"), F.lit(0))).first()[0]
    shares = join_groups(found, groups, ["lang", "source"], "terms", total).select(
        "lang", "source", "term", share("n", "words + v").alias("p"), share("lang_n", "lang_words + v").alias("q"),
        F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket"))

    above = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), distance("p", "q").alias("value"))
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = above.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most)

    dealt = groups.select("lang", "source", "absent", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"))
    sums = (
        shares.groupBy("lang", "bucket").cogroup(dealt.groupBy("lang", "bucket"))
        .applyInArrow(bucket_sums, "lang string, source string, item string, value bigint")
    )
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(first))
    return (
        pairs.withColumn("part", F.lit("pair"))
        .unionByName(terms.withColumn("item", F.col("item").cast("string")).withColumn("part", F.lit("term")))
        .select("lang", "source", "part", "item", "value", "rank")
    )
