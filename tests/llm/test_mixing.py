import hashlib
import math
import random
import re

from helpers import ODD_ROWS, documents

from retailscope.llm.mixing import mix

WORDS = re.compile("[^\x20\x09-\x0D]+")


def brute(rows):
    sizes = [len(WORDS.findall(t or "")) for _, t, _, _ in rows]
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(sizes, rows) if r[3] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    target, open_sources, left = {}, list(sources), sum(sizes)
    while open_sources:
        share = {s: left * weight[s] / sum(weight[o] for o in open_sources) for s in open_sources}
        above = [s for s in open_sources if share[s] > 3 * total[s]]
        if not above:
            target.update(share)
            break
        for s in above:
            target[s] = 3.0 * total[s]
            left -= 3 * total[s]
            open_sources.remove(s)
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    hash_of = lambda r: int(md5(f"{'' if r[0] is None else r[0]}:{md5(r[1] or '')}")[:15], 16)
    out = []
    for s in sources:
        own = sorted(((hash_of(r), n, r[0]) for n, r in zip(sizes, rows) if r[3] == s), key=lambda x: x[0])
        passes = math.floor(target[s] / total[s]) if total[s] else 0
        budget, best, taken = target[s] - passes * total[s], -1, 0
        gap = abs(budget) if total[s] else 0
        for place, (_, n, _) in enumerate(own):
            taken += n
            if total[s] and abs(taken - budget) < gap:
                best, gap = place, abs(taken - budget)
        out += [(i, n, total[s], round(target[s], 6), n * (passes + (place <= best))) for place, (_, n, i) in enumerate(own)]
    return out


def same(spark, rows):
    got = [(r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in mix(documents(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_odd_rows(spark):
    same(spark, ODD_ROWS)


def test_skewed_sources(spark):
    draw = random.Random(1)
    rows = []
    for i in range(600):
        source = "hot" if i % 3 == 0 else draw.choice(["a", "b", "ä", None, "zz"])
        rows.append((i, "w " * draw.choice([0, 1, 5, 50, 400]), "en", source))
    same(spark, rows)


def test_targets_are_met_and_bounded(spark):
    draw = random.Random(2)
    rows = [(i, "w " * draw.randint(1, 40), "en", draw.choice("abcd")) for i in range(2000)]
    got = mix(documents(spark, rows)).collect()
    for source_size, target in {(r["source_size"], r["target"]) for r in got}:
        taken = sum(r["taken"] for r in got if r["source_size"] == source_size)
        assert abs(taken - target) <= 20
    assert all(r["taken"] <= 3 * r["size"] for r in got)


def test_targets_are_met_without_ids_and_with_shared_ones(spark):
    draw = random.Random(5)
    rows = [
        (None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"t{i} " + "w " * draw.randint(1, 9), "en", draw.choice("abc")) for i in range(3000)
    ]
    rows += [(None, "the same row", "en", "b")] * 400 + [(8, "another one", "en", "d")] * 90
    got = mix(documents(spark, rows).repartition(4)).collect()
    for source_size, target in {(r["source_size"], r["target"]) for r in got}:
        taken = sum(r["taken"] for r in got if r["source_size"] == source_size)
        assert abs(taken - target) <= 10
    same(spark, rows)
    kept = mix(documents(spark, rows), keep=("text", "source"))
    assert sorted(r["taken"] for r in kept.collect()) == sorted(r["taken"] for r in got)


def test_one_source_empty_words_and_no_rows(spark):
    same(spark, [(1, None, "", "a"), (2, "", "", "a")])
    same(spark, [(1, "a b c", "", None)])
    assert mix(documents(spark, [])).count() == 0
