"""SimHash near-duplicates: segment bit counts, a grid join under Manhattan distance, exact verification.

A 64-bit fingerprint is cut into 32 segments of two bits. Its embedding is the number of set bits of
every segment, so the Manhattan distance of two embeddings is a lower bound of their Hamming distance.
Written in unary (0, 1 or 2 ones per segment) an embedding is again a 64-bit number, and the bound is the
bit count of an exclusive or.

Segments are dealt to a number of axis groups. Embeddings within ``max_bits`` differ in at most that many
groups, so they share the grid cell formed by all axes of some ``groups - max_bits`` of them. Fingerprints
meet in the cells of every such choice, are dropped by the bound and then verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailscope.functions.hotkeys import join_groups
from retailscope.llm.common import only_named, whole_text
from retailscope.operators.density import connected_labels
from retailscope.sources.shared import materialize

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = 32
SAME_COUNT = 3 / 8  # chance that two random segments of two bits have equal counts
CELL_ROWS = 8  # fingerprints per cell aimed at when choosing the number of groups
BLOCK_ROWS = 2048  # larger cells are compared in blocks, each pair of blocks on its own
MAX_GROUPS = 10
HASHES_AT_ONCE = 1 << 16
ASCII_LOWER = bytes(b | 32 if 65 <= b <= 90 else b for b in range(256))
LOW_BITS = 0x5555555555555555


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 without words."""
    words = text.translate(ASCII_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spread = min(size, len(words)) - 1
    begin, end = starts[: len(words) - spread].tolist(), ends[spread:].tolist()
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(begin), HASHES_AT_ONCE):
        part = [digest(joined[b:e], SEED) for b, e in zip(begin[i : i + HASHES_AT_ONCE], end[i : i + HASHES_AT_ONCE])]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begin), bitorder="little").view("<u8")[0])


def fingerprints(texts: Column, size: int = SHINGLE_WORDS) -> Column:
    """Fingerprints as signed 64-bit numbers."""

    def take(column: pa.Array) -> pa.Array:
        values = [fingerprint(t, size) for t in column.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(values, dtype=np.uint64).view(np.int64))

    return F.arrow_udf(take, "bigint")(texts)


def embedding(value: Column) -> Column:
    """Each segment's bit count in unary: the segment with its ones moved to the low end."""
    above, low = F.shiftrightunsigned(value, 1), F.lit(LOW_BITS).cast("bigint")
    some = value.bitwiseOR(above).bitwiseAND(low)
    both = value.bitwiseAND(above).bitwiseAND(low)
    return some.bitwiseOR(F.shiftleft(both, 1))


def embed(values: np.ndarray) -> np.ndarray:
    above, low = values >> np.uint64(1), np.uint64(LOW_BITS)
    return ((values | above) & low) | ((values & above & low) << np.uint64(1))


def group_masks(groups: int) -> list[int]:
    """The bits of each group of neighbouring segments."""
    edges = [round(g * SEGMENTS / groups) for g in range(groups + 1)]
    return [((1 << 2 * (b - a)) - 1) << 2 * a for a, b in zip(edges, edges[1:])]


def group_count(rows: int, max_bits: int) -> int:
    """The fewest groups with which random fingerprints are few to a cell; any number gives all links."""
    for groups in range(max_bits + 1, MAX_GROUPS):
        if rows * SAME_COUNT ** (SEGMENTS * (groups - max_bits) / groups) <= CELL_ROWS:
            return groups
    return MAX_GROUPS


def cells(distinct: DataFrame, groups: int, max_bits: int) -> DataFrame:
    """(cell, fp): one row per fingerprint and choice of groups."""
    masks = group_masks(groups)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    chosen = [signed(sum(c)) for c in combinations(masks, groups - max_bits)]
    assert len(chosen) == comb(groups, max_bits)
    place = [F.xxhash64(F.lit(i), F.col("t").bitwiseAND(F.lit(m).cast("bigint"))) for i, m in enumerate(chosen)]
    return distinct.withColumn("t", embedding(F.col("fp"))).select(F.explode(F.array(*place)).alias("cell"), "fp")


def meetings(occupied: DataFrame) -> DataFrame:
    """(unit, fp): rows of a unit are to be compared with each other; a cell of one row has none.

    A cell of up to ``BLOCK_ROWS`` rows is one unit. A larger one is cut into blocks, and a unit holds two
    of them, so no task has to hold more than two blocks at a time.
    """
    sizes = materialize(
        occupied.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-cells"
    )
    small = occupied.join(sizes.where(F.col("n") <= BLOCK_ROWS).select("cell"), "cell", "left_semi")
    blocks = F.ceil(F.col("n") / BLOCK_ROWS)
    large = (
        occupied.join(sizes.where(F.col("n") > BLOCK_ROWS), "cell")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select(F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "fp")
    )
    return small.select(F.col("cell").alias("unit"), "fp").unionByName(large)


def near_pairs(unit: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of the same unit within ``max_bits``; rows are sorted by unit."""
    unary, left, right = embed(fp), [], []

    def verify(a: np.ndarray, b: np.ndarray) -> None:
        close = np.bitwise_count(unary[a] ^ unary[b]) <= max_bits
        a, b = a[close], b[close]
        exact = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        left.append(a[exact])
        right.append(b[exact])

    starts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(unit)]]))
    many = sizes > 32
    in_few = np.flatnonzero(np.repeat(~many, sizes))
    for apart in range(1, int(sizes[~many].max(initial=0))):
        a = in_few[in_few + apart < len(unit)]
        a = a[unit[a] == unit[a + apart]]
        if not len(a):
            break
        verify(a, a + apart)
    for start, size in zip(starts[many].tolist(), sizes[many].tolist()):
        own, own_unary = fp[start : start + size], unary[start : start + size]
        for i in range(0, size, 256):
            close = np.bitwise_count(own_unary[i : i + 256, None] ^ own_unary[None, :]) <= max_bits
            a, b = np.nonzero(close)
            keep = a + i < b
            a, b = a[keep] + i, b[keep]
            exact = np.bitwise_count(own[a] ^ own[b]) <= max_bits
            left.append(a[exact] + start)
            right.append(b[exact] + start)
    nothing = np.zeros(0, dtype=np.int64)
    return np.concatenate([nothing, *left]), np.concatenate([nothing, *right])


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links that a forest needs to connect what the given links connect."""
    values, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = []
    for i, (x, y) in enumerate(zip(ends[: len(a)].tolist(), ends[len(a) :].tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            keep.append(i)
    return a[keep], b[keep]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect the same fingerprints as all pairs within ``max_bits`` do.

    A unit's rows lie together in one sorted partition; a task works through them a stretch at a time and
    keeps of each stretch the links of a spanning forest, so its output grows with rows, not pairs.
    """
    spark = distinct.sparkSession
    groups = group_count(distinct.count(), max_bits)
    units = meetings(materialize(cells(distinct, groups, max_bits), "simhash-grid"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, fp = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)

        def found(upto: int) -> pa.RecordBatch:
            i, j = near_pairs(unit[:upto], fp[:upto], max_bits)
            a, b = spanning_links(fp[i], fp[j])
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            unit = np.concatenate([unit, batch.column("unit").to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            last = int(np.searchsorted(unit, unit[-1])) if len(unit) else 0  # this unit may go on
            if last:
                yield found(last)
                unit, fp = unit[last:], fp[last:]
        if len(unit):
            yield found(len(unit))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        units.repartition(parts, "unit").sortWithinPartitions("unit").mapInArrow(compare, "a bigint, b bigint").distinct()
    )


def linked_rows(
    docs: DataFrame, size: int, max_bits: int, id_column: str, text_column: str,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, fp), fingerprints (fp, first_id, n), and those of them with links (fp, label, first_id)."""
    rows = materialize(
        only_named(docs, doc_id=id_column, text=text_column).select(
            F.col("doc_id").cast("bigint").alias("doc_id"), fingerprints(whole_text(), size).alias("fp")
        ),
        "simhash",
    )
    distinct = materialize(
        rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "simhash-nodes"
    )
    found = materialize(links(distinct.select("fp"), max_bits), "simhash-links")
    nodes = found.select(F.col("a").alias("id")).union(found.select("b")).distinct()
    labels = connected_labels(nodes, found).withColumnRenamed("id", "fp")
    return rows, distinct, materialize(distinct.join(labels, "fp").select("fp", "label", "first_id"), "simhash-linked")


def simhash_heads(
    docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
    id_column: str = "doc_id", text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of the rows that may stand for their group, and (doc_id, n) of ids that tell no row.

    Groups are those of ``simhash_groups``, told apart by their fingerprints. The head of a group has the
    smallest id and, with that, the smallest fingerprint; a group has a null id for its head only if it has
    no others. Rows equal in both come out as often as they came in. An id that several rows share, and
    null, tells a row only together with its fingerprint.
    """
    rows, distinct, linked = linked_rows(docs, size, max_bits, id_column, text_column)
    first = F.min(F.struct(F.col("first_id").isNull().alias("unnamed"), "first_id", "fp")).alias("head")
    alone = distinct.join(linked, "fp", "left_anti").select("first_id", F.col("fp").alias("first_fp"))
    heads = linked.groupBy("label").agg(first).select("head.first_id", F.col("head.fp").alias("first_fp"))
    heads = materialize(heads.unionByName(alone), "simhash-heads")
    is_head = [F.col("fp") == F.col("first_fp"), F.col("doc_id").eqNullSafe(F.col("first_id"))]
    counted = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    shared = materialize(counted.where("n > 1 OR doc_id IS NULL"), "simhash-shared-ids")
    return materialize(rows.join(heads.hint("merge"), is_head, "left_semi"), "simhash-head-rows"), shared


def simhash_groups(
    docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Fingerprints within ``max_bits`` differing bits are linked; ``component_id`` is the smallest id in
    the connected component, over any number of links. Null and empty texts have fingerprint zero, which
    links like any other; texts of fewer words than a shingle hash as a whole. Rows with equal
    fingerprints are one node, so copies make no pairs; repeated rows come out as often as they came in.
    Null ids name a component only if it has no others. An empty table gives no rows.
    """
    rows, distinct, linked = linked_rows(docs, size, max_bits, id_column, text_column)
    heads = linked.groupBy("label").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("size"))
    heads = materialize(heads, "simhash-heads")
    named = join_groups(linked, heads, "label", "size", linked.count(), "merge").select("fp", "component_id")
    groups = materialize(
        distinct.join(named, "fp", "left").select("fp", "n", F.coalesce("component_id", "first_id").alias("component_id")),
        "simhash-groups",
    )
    return join_groups(rows, groups, "fp", "n", rows.count(), "merge").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
