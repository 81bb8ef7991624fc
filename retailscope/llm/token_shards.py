"""Token ids in training order: fixed-stride binary shards read sequentially from any slot.

Documents are tokenized, ended by the end token and packed one after another into sequences of fixed
length, partition by partition of the input. A sequence's number is its input partition's base plus its
place in it; bases are spaced by the most sequences the bytes of any partition can make, so numbers are
known without a pass that counts tokens. A keyed Feistel permutation with cycle-walking sends each number
to its slot in training order. A shard holds one range of slots, and its file their records in order, each
of ``stride`` bytes and led by its slot: a reader finds any slot by bisection and reads on from there.
Texts are tokenized once and token ids move between machines once.
"""

from __future__ import annotations

import base64
import json
import struct
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.llm.common import fresh_path, only_named, whole_text, worker_state
from retailscope.llm.pieces import EncodedOnce, cut, vocabulary_path

VOCABULARY = "byte_bpe_50k.tiktoken"
END_TOKEN = 50256
SEQUENCE_TOKENS = 1024
SHARD_BYTES = 64 << 20  # no shard is larger
KEY = 20240607
ROUNDS = 6
SLOT, SLOT_BYTES = "<q", 8  # leads every record
GUARD = b"\n"  # ends every record
INDEX = -1  # the number of the shard that holds the index instead of records


@dataclass(frozen=True)
class Layout:
    """Everything a reader needs besides the files; written beside them as JSON.

    ``domain`` is the number of slots, ``spacing`` that of one input partition, ``per_shard`` that of a shard.
    """

    domain: int
    spacing: int
    sequence_tokens: int
    per_shard: int
    key: int
    vocabulary: str
    end_token: int

    @property
    def stride(self) -> int:
        return SLOT_BYTES + 2 * self.sequence_tokens + len(GUARD)

    @property
    def shards(self) -> int:
        return -(-self.domain // self.per_shard)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        return permuted(numbers, self.domain, self.key)


def permuted(numbers: np.ndarray, domain: int, key: int) -> np.ndarray:
    """A keyed permutation of [0, ``domain``): balanced Feistel rounds on the next even number of bits.

    Values that land beyond the domain walk on through the cipher until they come back inside.
    """
    half = max(1, (max(domain - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)

    def cipher(values: np.ndarray) -> np.ndarray:
        left, right = values >> shift, values & mask
        for r in range(ROUNDS):
            mixed = right + np.uint64((key * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1B54A32D192ED03) & (2**64 - 1))
            mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(31)) & mask)
        return (left << shift) | right

    with np.errstate(over="ignore"):
        out = cipher(numbers.astype(np.uint64))
        walking = np.flatnonzero(out >= domain)
        while len(walking):
            out[walking] = cipher(out[walking])
            walking = walking[out[walking] >= domain]
    return out.astype(np.int64)


def id_caches(vocabulary: str) -> tuple[EncodedOnce, EncodedOnce]:
    """Token ids, as little-endian 16-bit numbers, of pieces at the start of a text and of pieces led by a space."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encode = tiktoken.Encoding("shards", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(piece: str) -> bytes:
        numbers = encode(piece)
        return struct.pack(f"<{len(numbers)}H", *numbers)

    return EncodedOnce(ids, ""), EncodedOnce(ids, " ")


def token_bytes(texts: list[str], vocabulary: str, end_token: int) -> Iterator[bytes]:
    """Each text's ids as little-endian 16-bit numbers, the end token last."""
    first, led = worker_state("pieces", ("shard ids", vocabulary), lambda: id_caches(vocabulary))
    end = struct.pack("<H", end_token)
    for text in texts:
        first.make_room()
        led.make_room()
        pieces = cut(text)
        yield first[pieces[0]] + b"".join(map(led.__getitem__, pieces[1:])) + end


def most_sequences(rows: DataFrame, sequence_tokens: int) -> tuple[int, int]:
    """Input partitions, and the most sequences one of them can make: no token is shorter than a byte."""
    tokens = F.sum(F.octet_length("text").cast("bigint") + 1)
    sizes = rows.groupBy(F.spark_partition_id().alias("part")).agg(tokens.alias("tokens"))
    row = sizes.agg(F.max("part"), F.max("tokens")).first()
    return (0, 0) if row[0] is None else (row[0] + 1, -(-row[1] // sequence_tokens))


def write_records(rows: DataFrame, path: str, layout: Layout) -> None:
    """Write the shards and, as lines of another, where every document's tokens start.

    A task that is run again on another executor makes the same records. Should the input come in other
    partitions than when it was measured, so that numbers could clash, the job fails.
    """
    width = 2 * layout.sequence_tokens
    end = struct.pack("<H", layout.end_token)
    schema = "shard int, slot bigint, record binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, number, kept = TaskContext.get().partitionId(), 0, 0, bytearray()

        def out(shard, slots, values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(slots, pa.int64()), pa.array(values, pa.binary())], ["shard", "slot", "record"]
            )

        def records(data: bytes) -> pa.RecordBatch:
            n = len(data) // width
            if number + n > layout.spacing or (part + 1) * layout.spacing > layout.domain:
                raise RuntimeError(f"input partition {part} grew between measuring and writing; write the input out first")
            slots = layout.slots(part * layout.spacing + np.arange(number, number + n))
            led = [struct.pack(SLOT, s) + data[i * width : (i + 1) * width] for i, s in enumerate(slots.tolist())]
            return out(slots // layout.per_shard, slots, led)

        for batch in batches:
            ids, lines = batch.column("doc_id").to_pylist(), []
            for doc_id, tokens in zip(ids, token_bytes(batch.column("text").to_pylist(), layout.vocabulary, layout.end_token)):
                lines.append(f"{'' if doc_id is None else doc_id},{len(tokens) // 2},{part},{at}".encode())
                at += len(tokens) // 2
                kept += tokens
                if len(kept) >= 4 << 20:
                    whole = len(kept) // width * width
                    yield records(bytes(kept[:whole]))
                    number += whole // width
                    del kept[:whole]
            yield out([INDEX] * len(lines), [part] * len(lines), lines)
        if kept:
            kept += end * (-len(kept) % width // 2)
            yield records(bytes(kept))

    lanes = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    target = F.when(F.col("shard") == INDEX, layout.shards + F.col("slot") % lanes).otherwise(F.col("shard"))
    (
        rows.mapInArrow(pack, schema)
        .repartitionById(layout.shards + lanes, target.cast("int"))
        .sortWithinPartitions("shard", "slot")
        # the text writer copies the bytes as they are and commits like any Spark output, on any file system
        .select("shard", F.col("record").cast("string").alias("value"))
        .write.partitionBy("shard")
        .option("lineSep", GUARD.decode())
        .option("compression", "none")
        .text(f"{path}/shards")
    )


def write_shards(
    docs: DataFrame, path: str, sequence_tokens: int = SEQUENCE_TOKENS, shard_bytes: int = SHARD_BYTES, key: int = KEY,
    vocabulary: str = VOCABULARY, end_token: int = END_TOKEN, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Materialise ``docs`` below ``path``; returns where every document went.

    Returns (doc_id, n_tokens, first_token, slots), one row per input row: its tokens with the end token,
    the place of the first one in the first of its sequences, and the slots of its sequences in reading
    order. The last sequence of an input partition is filled up with end tokens. Null and empty texts are
    a lone end token. Repeated rows are written as often as they come. An empty table makes a layout
    without shards. The order depends on the files, the size of their splits and ``key``.
    """
    spark = docs.sparkSession
    rows = only_named(docs, doc_id=id_column, text=text_column).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")
    )
    parts, spacing = most_sequences(rows, sequence_tokens)
    stride = SLOT_BYTES + 2 * sequence_tokens + len(GUARD)
    layout = Layout(parts * spacing, spacing, sequence_tokens, max(1, shard_bytes // stride), key, vocabulary, end_token)
    spark.createDataFrame([(json.dumps(asdict(layout)),)], "value string").coalesce(1).write.text(f"{path}/layout")
    fields = "doc_id bigint, n_tokens bigint, part int, at bigint"
    if layout.domain:
        write_records(rows, path, layout)
        index = spark.read.schema(fields).csv(f"{path}/shards/shard={INDEX}")
    else:
        index = spark.createDataFrame([], fields)

    def slots(part: pa.Array, at: pa.Array, n: pa.Array) -> pa.Array:
        first = part.to_numpy(zero_copy_only=False).astype(np.int64) * layout.spacing
        begin, length = at.to_numpy(zero_copy_only=False), n.to_numpy(zero_copy_only=False)
        low = first + begin // sequence_tokens
        count = first + (begin + length - 1) // sequence_tokens + 1 - low
        ends = np.cumsum(count)
        numbers = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(low, count)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(layout.slots(numbers), pa.int64()))

    where = F.arrow_udf(slots, "array<bigint>")("part", "at", "n_tokens")
    return index.select("doc_id", "n_tokens", (F.col("at") % sequence_tokens).alias("first_token"), where.alias("slots"))


def read_layout(spark: SparkSession, path: str) -> Layout:
    return Layout(**json.loads(spark.read.text(f"{path}/layout").first()["value"]))


def read_sequences(path: str, layout: Layout, slot: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, token ids) in training order from ``slot`` on, for a trainer: a bisection, then sequential reads.

    ``path`` is a local folder or any URI that pyarrow can open.
    """
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    for number in range(slot // layout.per_shard, layout.shards):
        folder = fs.FileSelector(f"{root}/shards/shard={number}", allow_not_found=True)
        for name in sorted(f.path for f in store.get_file_info(folder) if f.base_name.startswith("part-")):
            with store.open_input_file(name) as shard:

                def slot_at(record: int) -> int:
                    shard.seek(record * layout.stride)
                    return struct.unpack(SLOT, shard.read(SLOT_BYTES))[0]

                low, high = 0, shard.size() // layout.stride
                last = high
                while low < high:
                    middle = (low + high) // 2
                    low, high = (middle + 1, high) if slot_at(middle) < slot else (low, middle)
                shard.seek(low * layout.stride)
                for _ in range(low, last):
                    record = shard.read(layout.stride)
                    yield struct.unpack_from(SLOT, record)[0], np.frombuffer(record[SLOT_BYTES : -len(GUARD)], dtype="<u2")


def token_shards(docs: DataFrame) -> DataFrame:
    """Write ``docs`` to a new folder in shared storage with the production parameters."""
    return write_shards(docs, fresh_path(docs.sparkSession, "token-shards"))
