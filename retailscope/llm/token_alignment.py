"""Alignment of two tokenizers over a corpus: which tokens end together, and how often corpus-wide.

Texts are tokenized once. A token pair that ends together is a link; how many links hold a pair, and which
pair is the most frequent of its B token, is counted externally (``spill_counts``): every task writes sorted,
compressed runs of pair-document records, radix-partitioned by B token; the runs of a part merge into counts
and maxima; a second reading of the runs takes these back to the documents. A part whose runs outgrow
``UNIT_BYTES`` is dealt to several units, so a token that holds a large share of all links is no task's burden.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailscope.llm.common import only_named, whole_text, worker_state
from retailscope.llm.pieces import groups_by_bytes, vocabulary_path
from retailscope.llm.spill_counts import (
    PairCode, contributions, cut_runs, merge_counts, packed, pairs_of, read_blocks, unpacked, with_maxima, write_blocks,
)
from retailscope.sources.shared import materialize

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
PARTS = 32
RUN_RECORDS = 4 << 20  # links a task sorts at once
UNIT_BYTES = 48 << 20  # runs a merging task holds, compressed
MAX_PIECES = 400_000
MAX_PIECE_BYTES = 64 << 20
LEARNT_AT_ONCE = 40_000
JOINED = 100  # pieces encoded as one string
SPACE = "▁"
BARE = "\ud800"  # marks a piece that no space leads; no text holds half a surrogate pair
ODD_SPACE = re.compile(r"[^\S \n]|[ \n][ \n]|^[ \n]|[ \n]$")


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself and the others as the letters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Tokens of the first vocabulary."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the unit of parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        letters = byte_of_letter()
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.size)]
        self.bytes = [bytes(map(letters.__getitem__, t)) if all(c in letters for c in t) else b"" for t in tokens]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Tokens of the second vocabulary, which puts a space before what it encodes."""

    def __init__(self, vocabulary: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(vocabulary))
        self.size = self.model.get_piece_size()
        self.bytes, names = [], []
        for i in range(self.size):
            name = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(name[3:5], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                self.bytes.append(b"")
            else:
                self.bytes.append(name.replace(SPACE, " ").encode())
                names.append(name)
        followed = {pair for n in names for pair in zip(n, n[1:])}
        alone = not self.model.is_unknown(self.model.piece_to_id(SPACE))

        def parted(mark: str) -> bool:
            """No piece reaches over a character that is not white space into ``mark``."""
            return not any(y == mark and x != SPACE and not x.isspace() for x, y in followed)

        self.cuts = " " * parted(SPACE) + "".join(c for c in "\n\t" if alone and parted(c) and (SPACE, c) not in followed)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Tokens of texts that begin with a space, or with a character that surely begins a token."""
        found = self.model.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        return [ids if t[0] == " " else ids[1:] for t, ids in zip(texts, found)]


class AlignedPieces:
    """Pieces of texts and how their tokens align, worked out once for each distinct piece.

    A text led by a space is cut after a character that is not white space before one of ``cuts``: there the
    first vocabulary's words end, and no token of the second reaches over. A cut is a common end of tokens,
    so the groups of a text are those of its pieces. A lone character at the end stays with what it follows,
    since the second vocabulary puts no space before nothing.
    """

    def __init__(self, vocabulary_a: str, vocabulary_b: str):
        self.a, self.b = ByteLevel(vocabulary_a), Pieces(vocabulary_b)
        self.code = PairCode(self.b.size, self.a.size, PARTS)
        self.lengths = [np.array([len(t) for t in side.bytes]) for side in (self.a, self.b)]
        self.names = [
            [np.array([f"{i}{mark}" for i in range(side.size)], dtype=object) for mark in (",", last)]
            for side, last in ((self.a, "|"), (self.b, ";"))
        ]
        self.simple = {" ", "\n"} <= set(self.b.cuts)
        self.cut = re.compile(rf"(?<=\S)(?=[{self.b.cuts}][\s\S])") if self.b.cuts else None
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 4), dtype=np.int64)  # tokens A, tokens B, groups, whether bytes differ
        self.links, self.starts, self.held = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64), 0

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text without the space that leads each; ``BARE`` leads those that none does."""
        if self.simple and not ODD_SPACE.search(text):
            return text.replace("\n", f" {BARE}\n").split(" ")
        parts = self.cut.split(" " + text) if self.cut else [" " + text]
        return [p[1:] if p[0] == " " else BARE + p for p in parts]

    def learn(self, texts: list[list[str]]) -> None:
        if len(self.number) > MAX_PIECES or self.held > MAX_PIECE_BYTES:
            self.forget()
        new = list({p for pieces in texts for p in pieces if p not in self.number})
        for low in range(0, len(new), LEARNT_AT_ONCE):
            self.learn_some(new[low : low + LEARNT_AT_ONCE])

    def learn_some(self, new: list[str]) -> None:
        """Encode pieces in strings of many, which may be cut again wherever a piece may; odd ones alone."""
        whole = [p[1:] if p.startswith(BARE) else " " + p for p in new]
        joined: list[list[int]] = []
        for place, piece in enumerate(whole):
            if piece[-1].isspace() or not piece[0] in self.b.cuts or not joined or len(joined[-1]) >= JOINED or whole[joined[-1][-1]][-1].isspace():
                joined.append([place])
            else:
                joined[-1].append(place)
        texts = ["".join([whole[i] for i in own]) for own in joined]
        found = list(zip(joined, texts, self.a.encode(texts), self.b.encode(texts)))
        right = [f for f in found if self.same_bytes(*f[1:])]
        if len(right) < len(found):
            doubtful = [i for own, *f in found if not self.same_bytes(*f) for i in own]
            alone = [whole[i] for i in doubtful]
            again = [([i], *f) for i, *f in zip(doubtful, alone, self.a.encode(alone), self.b.encode(alone))]
            right += [f for f in again if self.same_bytes(*f[1:])]
        self.keep(new, whole, right)

    def same_bytes(self, text: str, a: list[int], b: list[int]) -> bool:
        content = text.encode()
        return b"".join([self.a.bytes[i] for i in a]) == content == b"".join([self.b.bytes[i] for i in b])

    def keep(self, new: list[str], whole: list[str], right: list[tuple]) -> None:
        """Note sizes, links and written groups of the pieces in ``right``; the others' bytes differ.

        All strings lie behind each other on one axis of bytes: tokens group up to each common end, and a
        piece has the groups that end inside it.
        """
        order = np.array([i for own, *_ in right for i in own], dtype=np.int64)
        ends = np.cumsum([len(whole[i].encode()) for i in order])
        ids = [np.array([i for f in right for i in f[side]], dtype=np.int64) for side in (2, 3)]
        ended = [np.cumsum(lengths[own]) for lengths, own in zip(self.lengths, ids)]
        common = np.intersect1d(*ended, assume_unique=True)
        piece = np.searchsorted(ends, common)
        sizes = np.zeros((len(new), 4), dtype=np.int64)
        sizes[:, 3] = 1
        sizes[order] = np.stack([*(np.bincount(np.searchsorted(ends, e), minlength=len(order)) for e in (*ended, common)), 0 * order], axis=1)
        marked, groups = [], []
        for own, end, (inner, last) in zip(ids, ended, self.names):
            marked.append(np.where(np.isin(end, common, assume_unique=True), last[own], inner[own]))
            groups.append(np.searchsorted(common, end))
        sides = np.concatenate([2 * groups[0], 2 * groups[1] + 1])
        written = np.concatenate(marked)[np.argsort(sides, kind="stable")].tolist()
        tokens = np.cumsum(sizes[order, 0] + sizes[order, 1]).tolist()
        names = [""] * len(new)
        for i, low, high in zip(order.tolist(), [0, *tokens], tokens):
            names[i] = "".join(written[low:high])[:-1]
        links = self.code.of(ids[1][np.searchsorted(ended[1], common)], ids[0][np.searchsorted(ended[0], common)])
        links = links[np.argsort(order[piece], kind="stable")]
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.sizes = np.concatenate([self.sizes, sizes])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes[:, 2])])
        self.links = np.concatenate([self.links, links])
        self.groups += names
        self.held += sum(map(len, names)) + sum(map(len, whole))

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(tokens A, tokens B, groups) and a digest of the groups for each text; links and the texts they are in.

        The texts are not empty. One whose tokens do not give its bytes back has zeros and no digest.
        """
        split = [self.pieces(t) for t in texts]
        self.learn(split)
        numbers = [list(map(self.number.__getitem__, pieces)) for pieces in split]
        flat = np.fromiter((n for own in numbers for n in own), dtype=np.int64)
        length = np.array([len(own) for own in numbers])
        sums = np.add.reduceat(self.sizes[flat], np.cumsum(length) - length)
        broken = sums[:, 3] > 0
        sums[broken] = 0
        digests = [
            "" if bad else hashlib.sha256(";".join(map(self.groups.__getitem__, own)).encode()).hexdigest()
            for own, bad in zip(numbers, broken)
        ]
        place = np.repeat(np.arange(len(texts)), length)
        kept = ~broken[place]
        flat, place = flat[kept], place[kept]
        many = self.sizes[flat, 2]
        at = np.repeat(self.starts[flat] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return sums[:, :3], digests, self.links[at], np.repeat(place, many)


class Runs:
    """The rows a task puts out: one for each document, and the runs of the links seen so far."""

    def __init__(self, code: PairCode):
        self.code, self.number, self.flushed = code, TaskContext.get().partitionId() << 32, 0
        self.rows = 0
        self.records: list[np.ndarray] = []
        self.held = 0

    def add(self, links: np.ndarray, places: np.ndarray) -> None:
        self.records.append(links << self.code.place_bits | (self.rows + places))
        self.held += len(links)

    def full(self) -> bool:
        return self.held >= RUN_RECORDS or self.rows >= 1 << min(20, self.code.place_bits - 1)

    def flush(self) -> Iterator[tuple[int, bytes]]:
        records = np.concatenate(self.records) if self.records else np.zeros(0, dtype=np.int64)
        self.records, self.held = [], 0
        yield from cut_runs(records, self.code)
        self.number, self.rows = self.number + 1, 0


def align_tokens(
    docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per input row.

    A text led by a space is tokenized by ``vocabulary_a`` (byte-level, .json) and ``vocabulary_b`` (.model,
    which adds the space itself). Places where both end a token cut the tokens into groups; the two tokens
    that end there are linked. A pair's count is the number of its links in the table; ``n_best`` are links
    whose pair has the largest count of all pairs with its B token, ties included; ``count_sum`` adds the
    counts over links. Null and empty texts, and those whose tokens do not give their bytes back, have no
    tokens: zeros and an empty digest. Repeated rows, ids and null ids are rows like others, each with its
    links counted; an empty table gives no rows.
    """
    rows = only_named(docs, doc_id=id_column, text=text_column).select("doc_id", whole_text().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = "n_a bigint, n_b bigint, n_groups bigint"

    def tools() -> AlignedPieces:
        return worker_state("alignment", (vocabulary_a, vocabulary_b), lambda: AlignedPieces(vocabulary_a, vocabulary_b))

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, runs, schema = tools(), None, None

        def written() -> Iterator[pa.RecordBatch]:
            for part, blob in runs.flush():
                yield pa.RecordBatch.from_pydict(
                    {"run": [runs.number], "part": [part], "bytes": [len(blob)], "blob": [blob]}
                    | {n: [None] for n in ("place", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")}, schema)

        for batch in batches:
            if runs is None:
                runs = Runs(pieces.code)
                schema = pa.schema([
                    ("run", pa.int64()), ("place", pa.int64()), ("doc_id", batch.schema.field("doc_id").type),
                    ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()),
                    ("part", pa.int32()), ("bytes", pa.int64()), ("blob", pa.binary()),
                ])
            ids, start = batch.column("doc_id"), 0
            for group in groups_by_bytes(batch.column("text").to_pylist()):
                filled = [i for i, t in enumerate(group) if t]
                sums, digests = np.zeros((len(group), 3), dtype=np.int64), [""] * len(group)
                if filled:
                    sums[filled], found, links, places = pieces.align([group[i] for i in filled])
                    for i, digest in zip(filled, found):
                        digests[i] = digest
                    runs.add(links, np.array(filled)[places])
                n = len(group)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, runs.number)), pa.array(runs.rows + np.arange(n)), ids.slice(start, n),
                    *(pa.array(sums[:, c]) for c in range(3)), pa.array(digests, pa.string()),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                ], schema=schema)
                runs.rows, start = runs.rows + n, start + n
                if runs.full():
                    yield from written()
        if runs is not None:
            yield from written()

    schema = f"run bigint, place bigint, doc_id {kind}, {counted}, groups_sha256 string, part int, bytes bigint, blob binary"
    tokenized = materialize(rows.mapInArrow(tokenize, schema), "alignment")
    # as many rows as there are parts
    held = {r["part"]: r["bytes"] for r in tokenized.where("blob IS NOT NULL").groupBy("part").agg(F.sum("bytes").alias("bytes")).collect()}
    units = [max(1, -(-held.get(part, 0) // UNIT_BYTES)) for part in range(PARTS)]
    of_part = F.get(F.array(*[F.lit(n) for n in units]), F.col("part"))
    runs = tokenized.where("blob IS NOT NULL").select(
        "part", F.pmod(F.xxhash64("run"), of_part).cast("int").alias("unit"), "run", "blob")

    def count_unit(key: tuple, table: pa.Table) -> pa.Table:
        code = tools().code
        streams = [pairs_of(blob.as_py(), code.place_bits) for blob in table.column("blob")]
        found = np.array(list(merge_counts(streams)), dtype=np.int64).reshape(-1, 2)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "blob": [write_blocks(found[:, 0], found[:, 1])]})

    def count_part(key: tuple, table: pa.Table) -> pa.Table:
        streams = [
            (pair for keys, times in read_blocks(blob.as_py()) for pair in zip(keys.tolist(), times.tolist()))
            for blob in table.column("blob")
        ]
        found = np.array(list(with_maxima(merge_counts(streams), tools().code)), dtype=np.int64).reshape(-1, 3)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "blob": [write_blocks(found[:, 0], found[:, 1] << 1 | found[:, 2])]})

    partial = runs.groupBy("part", "unit").applyInArrow(count_unit, "part int, blob binary")
    counts = materialize(partial.groupBy("part").applyInArrow(count_part, "part int, blob binary"), "pair-counts")
    copies = counts.withColumn("unit", F.explode(F.sequence(F.lit(0), of_part - 1)))

    def give_back(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        code, blocks = tools().code, [b for blob in right.column("blob") for b in read_blocks(blob.as_py())]
        numbers, out = [], []
        if left.num_rows:
            pairs, marked = (np.concatenate(c) for c in zip(*blocks))
            for run, blob in zip(left.column("run").to_pylist(), left.column("blob")):
                shares = contributions(blob.as_py(), code.place_bits, pairs, marked >> 1, marked & 1)
                numbers.append(run)
                out.append(packed(np.concatenate(shares)))
        return pa.table({"run": pa.array(numbers, pa.int64()), "shares": pa.array(out, pa.binary())})

    shares = runs.groupBy("part", "unit").cogroup(copies.groupBy("part", "unit")).applyInArrow(give_back, "run bigint, shares binary")
    found = tokenized.where("blob IS NULL").select("run", "place", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        places = left.column("place").to_numpy()
        sums = np.zeros((2, int(places.max(initial=-1)) + 1), dtype=np.int64)
        for blob in right.column("shares"):
            own, n_best, total = unpacked(blob.as_py()).reshape(3, -1)
            sums[0, own] += n_best
            sums[1, own] += total
        return pa.table({
            "doc_id": left.column("doc_id"), "n_a": left.column("n_a"), "n_b": left.column("n_b"),
            "n_groups": left.column("n_groups"), "n_links": left.column("n_groups"),
            "n_best": pa.array(sums[0, places]), "count_sum": pa.array(sums[1, places]),
            "groups_sha256": left.column("groups_sha256"),
        })

    result = f"doc_id {kind}, {counted}, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return found.groupBy("run").cogroup(shares.groupBy("run")).applyInArrow(add_up, result)
