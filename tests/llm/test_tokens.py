import random

import numpy as np
import public_tokenizers
import pytest
from helpers import ODD_ROWS, documents
from tokenizers import Tokenizer

from retailscope.llm import pieces
from retailscope.llm.common import fresh_path
from retailscope.llm.token_counts import count_tokens
from retailscope.llm.token_shards import permuted, read_layout, read_sequences, write_shards

ODD_TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \nb", "\n a", "don't we'll 'tis", "x <|endoftext|>y <|endoftext|> z",
    "<|endoftext|>", "a\u00a0b \u2003 c", "tab\tand \t tab", "\x1c x \x1c", "日本 語 \U0001f600 ok", "1 2 33 !? -- a", "é ê ß", "\r\n x",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def spun(seed, n):
    draw = random.Random(seed)
    letters = "ab é's \n\t1!?.<|>'Ä  "
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(n)]


def test_pieces_have_the_tokens_of_the_whole(tokenizer):
    for text in ODD_TEXTS + spun(1, 3000):
        cut = pieces.cut(text)
        assert " ".join(cut) == text
        together = sum(len(tokenizer.encode(p if i == 0 else " " + p, add_special_tokens=False)) for i, p in enumerate(cut))
        assert together == len(tokenizer.encode(text, add_special_tokens=False)), repr(text)


def test_counts(spark, tokenizer, monkeypatch):
    rows = ODD_ROWS + [(100 + i, t, "", "") for i, t in enumerate(ODD_TEXTS + spun(2, 200))]
    got = {}
    for r in count_tokens(documents(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append((r["n_bytes"], r["n_tokens"], r["over_limit"]))
    for doc_id, text, *_ in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False))
        assert (len((text or "").encode()), n, n > 512) in got[doc_id], (doc_id, text)
    assert sum(map(len, got.values())) == len(rows)
    assert count_tokens(documents(spark, [])).count() == 0


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "MAX_CACHED", 10)
    once = pieces.EncodedOnce(len, " ")
    cache = pieces.EncodedInBatches(lambda batch: [len(p) for p in batch])
    for i in range(50):
        split = [pieces.cut(f"a{i} b{i} c{i} {'z' * 100}")]
        cache.learn(split)
        assert sum(map(cache.known.__getitem__, split[0][1:])) > 0
        cache.forget_long()
        once.make_room()
        assert once[f"b{i}"] == len(f" b{i}") and once["z" * 100] == 101 and len(once) <= 11 and "z" * 100 not in once
        assert len(cache.known) < 20 and all(len(p) <= pieces.MAX_CACHED_CHARS for p in cache.known)


@pytest.mark.parametrize("domain", [1, 2, 3, 17, 1000, 4097])
def test_permutation(domain):
    slots = permuted(np.arange(domain), domain, 5)
    assert sorted(slots.tolist()) == list(range(domain))
    if domain > 100:
        assert slots.tolist() != permuted(np.arange(domain), domain, 6).tolist()
        assert abs(np.corrcoef(np.arange(domain), slots)[0, 1]) < 0.2


def test_shards_round_trip(spark, tokenizer):
    tokenizer.encode_special_tokens = True
    rows = ODD_ROWS + [(100 + i, t * (1 + i % 7), "", "") for i, t in enumerate(ODD_TEXTS + spun(3, 150))] * 2
    path = fresh_path(spark, "shards-test")
    source = fresh_path(spark, "shards-input")
    documents(spark, rows).repartition(3).write.parquet(source)
    docs = spark.read.parquet(source)
    index = write_shards(docs, path, sequence_tokens=32, shard_bytes=73 * 10).collect()
    layout = read_layout(spark, path)
    order = list(read_sequences(path, layout))
    numbers = [slot for slot, _ in order]
    assert layout.stride == 73 and numbers == sorted(set(numbers)) and numbers[-1] < layout.domain
    for start in (numbers[25], numbers[25] + 1, layout.domain - 1, layout.domain):
        resumed = list(read_sequences(path, layout, start))
        assert [s for s, _ in resumed] == [s for s in numbers if s >= start]
        assert all((t == dict(order)[s]).all() for s, t in resumed) if start == numbers[25] else True
    held = dict(order)
    texts = {}
    for doc_id, text, *_ in rows:
        texts.setdefault(doc_id, set()).add(text or "")
    assert len(index) == len(rows)
    used = []
    for row in index:
        stream = np.concatenate([held[s] for s in row["slots"]])
        own = stream[row["first_token"] : row["first_token"] + row["n_tokens"]].tolist()
        assert own[-1] == 50256 and len(own) == row["n_tokens"]
        wanted = [tokenizer.encode(t, add_special_tokens=False).ids + [50256] for t in texts[row["doc_id"]]]
        assert own in wanted
        used += [(s, p) for s, p in zip(np.repeat(row["slots"], 32)[row["first_token"] :][: row["n_tokens"]].tolist(),
                                         (row["first_token"] + np.arange(row["n_tokens"])) % 32)]
    assert len(used) == len(set(used)), "two documents share a place"
    assert {s for r in index for s in r["slots"]} == set(numbers)
    again = fresh_path(spark, "shards-test")
    write_shards(docs, again, sequence_tokens=32, shard_bytes=73 * 10).collect()
    assert [(s, t.tolist()) for s, t in read_sequences(again, layout)] == [(s, t.tolist()) for s, t in order]


def test_no_documents(spark):
    path = fresh_path(spark, "shards-empty")
    assert write_shards(documents(spark, []), path).count() == 0
    assert list(read_sequences(path, read_layout(spark, path))) == []
