"""Benchmark decontamination: an FM-index per shard of documents, searched for the benchmark's phrases.

A shard's index covers every run of words that the benchmark knows and that is long enough to hold a
phrase; other words can be part of no occurrence and only end runs. Documents never move: each task
indexes the documents it reads, shard by shard.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import repeat
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailscope.llm.common import only_named, whole_text
from retailscope.llm.fm_index import FMIndex
from retailscope.sources.shared import materialize

PHRASE_WORDS = 10
SHARD_WORDS = 1 << 20  # indexed words per shard; a longer document is a shard of its own
BLOCK_BYTES = 2 << 20  # benchmark text searched by one job; it travels with every task
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of lower-cased text

# A-Z to a-z; everything else in ASCII but digits and small letters divides words.
WORD_BYTES = bytes(
    b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


@dataclass
class Phrases:
    """The distinct phrases of a set of items, as symbols, and the items that hold each of them."""

    vocabulary: dict[bytes, int]
    symbols: np.ndarray  # right-aligned rows
    lengths: np.ndarray
    items: list[str]
    holders: list[list[int]]

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else 0


def phrases_of(items: Sequence[tuple[str | None, str | None]], size: int = PHRASE_WORDS) -> Phrases:
    """Every run of ``size`` words of an item, or all its words if it has fewer; an item without words has none.

    Phrases of items without an id are searched like others, but name no item.
    """
    vocabulary: dict[bytes, int] = {}
    names: dict[str, int] = {}
    holders: dict[tuple[int, ...], set[int]] = defaultdict(set)
    for item_id, text in items:
        words = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of((text or "").encode())]
        for start in range(max(1, len(words) - size + 1) if words else 0):
            held = holders[tuple(words[start : start + size])]
            if item_id is not None:
                held.add(names.setdefault(item_id, len(names)))
    symbols = np.zeros((len(holders), size), dtype=np.int64)
    lengths = np.array([len(p) for p in holders], dtype=np.int64)
    for row, phrase in enumerate(holders):
        symbols[row, size - len(phrase) :] = phrase
    return Phrases(vocabulary, symbols, lengths, list(names), [sorted(h) for h in holders.values()])


def search_shard(documents: list[np.ndarray], phrases: Phrases) -> list[tuple[list[tuple[int, int]], list[str]]]:
    """Per document of the shard: merged spans of words (end exclusive) and the items found.

    ``documents`` are the symbols of each document's words, 0 for words no item has.
    """
    nothing = [([], []) for _ in documents]
    starts = np.concatenate([[0], np.cumsum([len(d) + 1 for d in documents])]).astype(np.int64)
    joined = np.zeros(starts[-1], dtype=np.int64)  # a 0 after every document
    for start, symbols in zip(starts, documents):
        joined[start : start + len(symbols)] = symbols
    edges = np.flatnonzero(np.diff(np.concatenate([[False], joined != 0, [False]]).astype(np.int8)))
    run_from, run_to = edges[0::2], edges[1::2]
    long_enough = run_to - run_from >= phrases.shortest
    run_from, run_to = run_from[long_enough], run_to[long_enough]
    if not len(run_from):
        return nothing
    # the kept runs with the 0 behind each, and where each indexed word stands in the shard
    sizes = run_to - run_from + 1
    ends = np.cumsum(sizes)
    origin = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(run_from, sizes)
    index = FMIndex(joined[origin], len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.symbols, phrases.lengths)
    times = high - low
    total = int(times.sum())
    if not total:
        return nothing
    phrase = np.repeat(np.arange(len(times)), times)
    rows = np.arange(total) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
    begin = origin[index.locate(rows)]

    step = np.zeros(len(joined) + 1, dtype=np.int64)
    np.add.at(step, begin, 1)
    np.add.at(step, begin + phrases.lengths[phrase], -1)
    covered = np.cumsum(step) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered]).astype(np.int8)))
    in_document = np.searchsorted(starts, begin, side="right") - 1
    out = [([], set()) for _ in documents]
    for first, last in zip(edges[0::2].tolist(), edges[1::2].tolist()):
        number = int(np.searchsorted(starts, first, side="right")) - 1
        out[number][0].append((first - int(starts[number]), last - int(starts[number])))
    for number, p in set(zip(in_document.tolist(), phrase.tolist())):
        out[number][1].update(phrases.holders[p])
    return [(spans, [phrases.items[i] for i in sorted(found)]) for spans, found in out]


def searched(texts: list[bytes], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """(number of words, spans, items) per text, indexing shard after shard."""
    results, shard, waiting, size = [], [], [], 0

    def flush():
        for n, (spans, items) in zip(waiting, search_shard(shard, phrases) if len(phrases.lengths) else repeat(([], []))):
            results.append((n, spans, items))

    for text in texts:
        words = words_of(text)
        shard.append(np.fromiter(map(phrases.vocabulary.get, words, repeat(0)), dtype=np.int64, count=len(words)))
        waiting.append(len(words))
        size += len(words)
        if size >= SHARD_WORDS:
            flush()
            shard, waiting, size = [], [], 0
    flush()
    return results


FOUND = "n_words bigint, spans array<struct<from:int,to:int>>, items array<string>"


def find_phrases(texts: Column, phrases: Phrases) -> Column:
    """What texts that are never null hold of the phrases (FOUND)."""

    def find(column: pa.Array) -> pa.Array:
        rows = searched(column.cast(pa.binary()).to_pylist(), phrases)
        return pa.array(
            [{"n_words": n, "spans": [{"from": a, "to": b} for a, b in spans], "items": items} for n, spans, items in rows],
            pa.struct([
                ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))),
                ("items", pa.list_(pa.string())),
            ]),
        )

    return F.arrow_udf(find, FOUND)(texts)


def benchmark_blocks(benchmark: DataFrame, id_column: str, text_column: str, block_bytes: int) -> tuple[int, Iterator[Phrases]]:
    """The benchmark in blocks of about ``block_bytes`` of text: their number, and one after another.

    The items are written once; a block comes to the driver when it is asked for and can go before the next.
    """
    items = only_named(benchmark, item_id=id_column, text=text_column).select(
        F.col("item_id").cast("string").alias("item_id"), whole_text().alias("text")
    )
    n_bytes = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-n_bytes // block_bytes))
    if blocks > 1:
        items = materialize(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "benchmark")

    def one_by_one() -> Iterator[Phrases]:
        for b in range(blocks):
            own = items.where(F.col("block") == b) if blocks > 1 else items
            yield phrases_of([(r["item_id"], r["text"]) for r in own.select("item_id", "text").collect()])

    return blocks, one_by_one()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_id_column: str = "item_id", item_text_column: str = "text", block_bytes: int = BLOCK_BYTES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, n_words, spans, items), one row per input row.

    With ``keep``, those input columns instead of the id.
    ``spans`` are the merged stretches of words (positions from 0, end exclusive) inside any occurrence
    of a benchmark phrase, ``items`` the sorted ids, as text, of the items whose phrases occur. Null and
    empty texts have no words and no spans; an empty benchmark finds nothing; items with equal ids count
    once; repeated documents are judged alike; an empty table gives no rows. Whole texts are searched; one
    longer than a shard is a shard of its own. ``without_spans`` cuts the spans out of a text.

    A benchmark of one block is searched in one pass that moves no document. A larger one takes a job for
    each block over a written copy of the documents; a job writes what it found by row, and the rows meet
    their findings at the end, so neither the driver nor a task ever holds more than one block.
    """
    blocks, one_by_one = benchmark_blocks(benchmark, item_id_column, item_text_column, block_bytes)
    carried = [F.col(c) for c in keep] or [F.col(id_column).alias("doc_id")]
    if blocks == 1:
        rows = docs.select(F.struct(*carried).alias("kept"), find_phrases(whole_text(text_column), next(one_by_one)).alias("found"))
        items = F.array_sort(F.array_distinct("found.items"))
        return rows.select("kept.*", "found.n_words", F.array_sort("found.spans").alias("spans"), items.alias("items"))
    rows = docs.select(F.struct(*carried).alias("kept"), whole_text(text_column).alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows, "searched-documents")
    parts = []
    for phrases in one_by_one:
        found = rows.select("row", find_phrases(F.col("text"), phrases).alias("found")).where(F.size("found.spans") > 0)
        parts.append(materialize(found.select("row", "found.spans", "found.items"), "found-phrases"))
    by_row = reduce(DataFrame.unionByName, parts).groupBy("row").agg(  # at most one row for each block
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    n_words = F.regexp_count(F.translate("text", ascii_uppercase, ascii_lowercase), F.lit(WORD)).cast("bigint")
    met = rows.select("kept", "row", n_words.alias("n_words")).join(by_row, "row", "left")
    spans = merged(F.coalesce("spans", F.array().cast(SPANS)))
    items = F.array_sort(F.array_distinct(F.coalesce("items", F.array().cast("array<string>"))))
    return met.select("kept.*", "n_words", spans.alias("spans"), items.alias("items"))


SPANS = "array<struct<from:int,to:int>>"


def merged(spans: Column) -> Column:
    """Sort spans and join those that touch or overlap."""

    def join(column: pa.Array) -> pa.Array:
        rows = []
        for own in column.to_pylist():
            done: list[dict] = []
            for span in sorted(own, key=lambda s: (s["from"], s["to"])):
                if done and span["from"] <= done[-1]["to"]:
                    done[-1]["to"] = max(done[-1]["to"], span["to"])
                else:
                    done.append(dict(span))
            rows.append(done)
        return pa.array(rows, pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))

    return F.arrow_udf(join, SPANS)(spans)


def without_spans(text: str, spans: Sequence[tuple[int, int]]) -> str:
    """``text`` without the given word spans; what stands between words inside a span goes with them."""
    data = text.encode()
    plain = data.translate(WORD_BYTES)
    places, at = [], 0
    for word in plain.split():
        at = plain.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    kept, done = [], 0
    for first, last in spans:
        kept.append(data[done : places[first][0]])
        done = places[last - 1][1]
    kept.append(data[done:])
    return b"".join(kept).decode()


def contamination(found: DataFrame) -> DataFrame:
    """The report on each document: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["to"] - s["from"]).cast("bigint"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
