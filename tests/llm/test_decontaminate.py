import hashlib
import random
import re

import numpy as np
import pytest
from helpers import ODD_ROWS, documents, lowered

from retailscope.llm import decontaminate as D
from retailscope.llm.fm_index import FMIndex, suffix_array

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items):
    phrases = {}
    for item_id, text in items:
        words = WORD.findall(lowered(text))
        for i in range(max(1, len(words) - 9) if words else 0):
            phrases.setdefault(tuple(words[i : i + 10]), set()).add(item_id)
    out = []
    for doc_id, text, *_ in docs:
        words, hit, found = WORD.findall(lowered(text)), set(), set()
        for i in range(len(words)):
            for size in {len(p) for p in phrases}:
                window = tuple(words[i : i + size])
                if len(window) == size and window in phrases:
                    hit.update(range(i, i + size))
                    found |= phrases[window]
        names = sorted(str(f) for f in found if f is not None)
        out.append((doc_id, len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def table(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, spans string")


def planted(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice(["the", "of", "Ä", "b2", "cat", "dog", "run", "é1", "zz", "on"])
    items = [(i, " ".join(word() for _ in range(draw.choice([0, 1, 2, 5, 9, 10, 11, 30, 60])))) for i in range(40)]
    items += [(3, items[3][1]), (None, " ".join(["nobody"] * 4)), (99, None), (98, "... !!")]
    docs = []
    for i in range(80):
        words = [word() if draw.random() < 0.8 else f"own{draw.randint(0, 99)}" for _ in range(draw.randint(0, 120))]
        if i % 3 == 0:
            at = draw.randint(0, len(words))
            words[at:at] = items[draw.randrange(40)][1].upper().split()
        docs.append((i, draw.choice([" ", "\n", " - "]).join(words), "", ""))
    return docs + [(200, "nobody nobody nobody nobody nobody", "", "")], items


@pytest.mark.parametrize("block_bytes", [1 << 20, 1500])
@pytest.mark.parametrize("shard", [1 << 20, 200])
def test_same_as_brute_force(spark, monkeypatch, block_bytes, shard):
    docs, items = planted(4)
    docs = docs + [(300 + i, t, "", "") for i, (_, t, *_x) in enumerate(ODD_ROWS)]
    frame = documents(spark, docs)
    if shard == 200:
        texts = [(t or "").encode() for _, t, *_ in docs]
        phrases = D.phrases_of([(None if i is None else str(i), t) for i, t in items])
        whole = D.searched(texts, phrases)
        monkeypatch.setattr(D, "SHARD_WORDS", shard)
        assert D.searched(texts, phrases) == whole
    got = D.contamination(D.decontaminate(frame, table(spark, items), block_bytes=block_bytes)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(docs, items), key=str)


def test_blocks_come_one_at_a_time_and_give_the_result_of_one(spark):
    docs, items = planted(6)
    frame, benchmark = documents(spark, docs + docs[:3]), table(spark, items)
    keep = ("doc_id", "text", "size", "found")
    whole = D.decontaminate(frame, benchmark, keep=keep).collect()
    blocks, one_by_one = D.benchmark_blocks(benchmark, "item_id", "text", 200)
    assert blocks >= 10 and not isinstance(one_by_one, list)
    sizes = [len(p.items) for p in one_by_one]
    assert max(sizes) < 20 and len(sizes) == blocks
    assert sorted(D.decontaminate(frame, benchmark, keep=keep, block_bytes=200).collect(), key=str) == sorted(whole, key=str)


def test_no_benchmark_and_no_documents(spark):
    docs, items = planted(5)
    assert D.contamination(D.decontaminate(documents(spark, docs), table(spark, []))).where("contaminated").count() == 0
    assert D.decontaminate(documents(spark, []), table(spark, items)).count() == 0
    assert D.decontaminate(documents(spark, []), table(spark, items), block_bytes=200).count() == 0


def test_spans_cut_out():
    text = "Keep this. The CAT, sat on; a mat! And é this"
    assert D.without_spans(text, [(2, 7)]) == "Keep this.  mat! And é this"


def test_fm_index_counts_and_places():
    draw = np.random.default_rng(1)
    runs = [draw.integers(1, 4, size=n) for n in (1, 7, 40, 40, 300)]
    runs.append(runs[2])
    sequence = np.concatenate([np.append(r, 0) for r in runs])
    order = suffix_array(sequence)
    assert sorted(order.tolist()) == list(range(len(sequence)))
    index = FMIndex(sequence, 4)
    for size in (1, 2, 3, 5, 10):
        for start in range(0, 120, 7):
            phrase = sequence[start : start + size]
            if (phrase == 0).any() or len(phrase) < size:
                continue
            want = [i for i in range(len(sequence) - size + 1) if (sequence[i : i + size] == phrase).all()]
            low, high = index.search(phrase[None, :].astype(np.int64), np.array([size]))
            assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want
