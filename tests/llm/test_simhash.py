import random

import numpy as np
import pytest
import xxhash
from helpers import ODD_ROWS, components, documents, lowered

from retailscope.llm import simhash as S


def brute_fingerprint(text):
    import re

    words = re.findall("[^\x20\x09-\x0D]+", lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [(i, brute_fingerprint(t)) for i, t, *_ in rows]
    heads = components({f for _, f in prints}, lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for i, f in prints:
        first.setdefault(heads[f], []).append(i)
    smallest = {h: min((i for i in ids if i is not None), default=None) for h, ids in first.items()}
    return [(i, f"{f:016x}", smallest[heads[f]]) for i, f in prints]


def near_texts(seed, n):
    draw = random.Random(seed)
    base = [" ".join("".join(draw.choices("aeinorst", k=5)) for _ in range(400)) for _ in range(6)]
    rows = []
    for i in range(n):
        words = base[draw.randrange(6)].split()
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(400)] = draw.choice(["x", "Yy", "zé"])
        rows.append((i, draw.choice([" ", "\n"]).join(words), "", ""))
    return rows


def test_same_as_brute_force(spark):
    rows = near_texts(1, 150) + [(1000 + i if i else None, t, "", "") for i, (_, t, *_x) in enumerate(ODD_ROWS)]
    got = S.simhash_groups(documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)
    assert len({r["component_id"] for r in got}) < 100


@pytest.mark.parametrize("groups", [4, 5, 6, 8])
@pytest.mark.parametrize("block", [S.BLOCK_ROWS, 8])
def test_no_link_is_lost(spark, monkeypatch, groups, block):
    """Dense balls of fingerprints around a few centres, one of them a third of all, and lone ones."""
    monkeypatch.setattr(S, "group_count", lambda rows, bits: groups)
    monkeypatch.setattr(S, "BLOCK_ROWS", block)
    draw = random.Random(groups)
    centres = [draw.getrandbits(64) for _ in range(5)]
    values = {draw.getrandbits(64) for _ in range(60)} | {0, 1, 2**64 - 1}
    for i in range(240):
        value = centres[0] if i % 3 else centres[draw.randrange(5)]
        for _ in range(draw.randint(0, 5)):
            value ^= 1 << draw.randrange(64)
        values.add(value)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    linked = {}
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in S.links(frame).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    for a, b in found:
        linked.setdefault(a, set()).add(b)
    reach = components(values, lambda a, b: b in linked.get(a, ()) or a in linked.get(b, ()))
    assert reach == components(values, lambda a, b: (a ^ b).bit_count() <= 3)


def test_embedding_bounds_the_distance():
    draw = np.random.default_rng(0)
    a, b = draw.integers(0, 2**63, 500, dtype=np.uint64) * np.uint64(2), draw.integers(0, 2**63, 500, dtype=np.uint64)
    counts = lambda v: [[bin(x >> 2 * s & 3).count("1") for s in range(32)] for x in v.tolist()]
    manhattan = np.abs(np.array(counts(a)) - np.array(counts(b))).sum(axis=1)
    assert np.array_equal(np.bitwise_count(S.embed(a) ^ S.embed(b)), manhattan)
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_jvm_and_numpy_embed_alike(spark):
    from pyspark.sql import functions as F

    values = [0, 1, -1, 2**63 - 1, -(2**63), 123456789123456789, -987654321987654321]
    got = spark.createDataFrame([(v,) for v in values], "fp bigint").select(S.embedding(F.col("fp")).alias("t")).collect()
    want = S.embed(np.array(values, dtype=np.int64).view(np.uint64)).view(np.int64).tolist()
    assert [r["t"] for r in got] == want


def test_masks_cover_all_bits_once():
    for groups in range(4, 11):
        masks = S.group_masks(groups)
        assert sum(masks) == 2**64 - 1 and len(masks) == groups


def test_long_text_in_parts(monkeypatch):
    text = near_texts(3, 1)[0][1].encode()
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "HASHES_AT_ONCE", 7)
    assert S.fingerprint(text) == whole


def test_no_documents(spark):
    assert S.simhash_groups(documents(spark, [])).count() == 0
