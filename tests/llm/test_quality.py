import random

import numpy as np
from helpers import ODD_ROWS, documents, fold

from retailscope.llm.quality import COLUMN_BITS, dual_descent, grams, packed, score_quality, unpacked


def corpus(seed, n):
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(draw.choices("aeinorst", k=draw.randint(2, 9))) for _ in range(draw.randint(5, 60))]
        good = i % 4 != 0
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 8 else [w for w in words for _ in range(4)]
        docs.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(good)))
    return docs, labels


def labels_table(spark, labels):
    return spark.createDataFrame([(i, q, "x") for i, q in labels], "doc_id bigint, quality int, text string")


def test_held_out_accuracy_and_columns(spark):
    docs, labels = corpus(1, 900)
    docs += [(5000 + i, t, "", "") for i, (_, t, *_x) in enumerate(ODD_ROWS)] + [(None, "null id", "", "")]
    labels += [(None, 1), (7, None), (8, 7)]
    got = score_quality(documents(spark, docs), labels_table(spark, labels)).collect()
    assert len(got) == len(docs)
    truth = dict(labels[:900])
    held = [r for r in got if r["doc_id"] in truth and r["doc_id"] not in (7, 8) and r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["predicted"] for r in held) >= 0.97 * len(held) > 100
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in got)


def test_held_out_labels_are_never_used(spark):
    docs, labels = corpus(2, 300)
    turned = [(i, 1 - q if fold(i, 5) == 0 else q) for i, q in labels]
    score = lambda ls: {r["doc_id"]: r["score"] for r in score_quality(documents(spark, docs), labels_table(spark, ls)).collect()}
    assert score(labels) == score(turned)


def test_without_labels_or_documents(spark):
    docs, labels = corpus(3, 30)
    got = score_quality(documents(spark, docs), labels_table(spark, [])).collect()
    assert {r["score"] for r in got} == {0.5}
    one_class = [(i, 1) for i, _ in labels]
    assert {r["score"] for r in score_quality(documents(spark, docs), labels_table(spark, one_class)).collect()} == {0.5}
    assert score_quality(documents(spark, []), labels_table(spark, labels)).count() == 0


def test_grams_are_indicators_of_the_whole_text():
    held = np.zeros(1 << COLUMN_BITS, dtype=bool)
    text = b"ab cd " * 10
    once = grams(text, held).tolist()
    assert once == grams(text + b"ab cd " * 5, held).tolist() and not held.any()
    long = b"q" * (1 << 20) + b"zzzz needle"
    assert set(grams(b"zzzz needle", held)) <= set(grams(long, held))
    assert grams(b"", held).tolist() == []


def test_dual_descent_solves_the_problem():
    draw = np.random.default_rng(0)
    features = [np.flatnonzero(draw.random(12) < 0.4) for _ in range(80)]
    signs = np.array([1.0 if 3 in f else -1.0 for f in features])
    ratios, costs = draw.normal(size=12), np.full(80, 0.5)
    weights = dual_descent(features, signs, ratios, costs)
    rows = np.zeros((80, 13))
    for i, f in enumerate(features):
        rows[i, f] = ratios[f]
        rows[i, 12] = 0.5
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)

    def objective(w):
        return 0.5 * w @ w + (costs * np.maximum(0, 1 - signs * (rows @ w)) ** 2).sum()

    best = objective(weights)
    assert all(best <= objective(weights + 0.02 * draw.normal(size=13)) for _ in range(200))


def test_long_texts_teach_too(spark):
    """One class has only texts over 16 KB, as books against short junk."""
    docs, labels = corpus(4, 200)
    good = dict(labels)
    docs = [(i, " ".join([text] * (1 + 20_000 // len(text))) if good[i] else text, *rest) for i, text, *rest in docs]
    assert all((len(d[1]) > 1 << 14) == bool(good[d[0]]) for d in docs)
    got = score_quality(documents(spark, docs), labels_table(spark, labels)).collect()
    held = [r for r in got if r["held_out"]]
    assert sum(good[r["doc_id"]] == r["predicted"] for r in held) >= 0.95 * len(held) > 20


def test_one_row_of_a_class_is_enough(spark):
    docs, labels = corpus(5, 100)
    good = dict(labels)
    bad = next(i for i, q in labels if not q and fold(i, 5) and i % 8)
    few = [(i, q) for i, q in labels if q or i == bad]
    got = {r["doc_id"]: r["score"] for r in score_quality(documents(spark, docs), labels_table(spark, few)).collect()}
    shouted = [s for i, s in got.items() if not good[i] and i % 8]
    assert max(shouted) < min(s for i, s in got.items() if good[i])


def test_columns_pack_into_bounded_bytes():
    draw = np.random.default_rng(1)
    for n in (0, 1, 4095, 4096, 4097, 1 << COLUMN_BITS):
        columns = np.sort(draw.permutation(1 << COLUMN_BITS)[:n])
        assert unpacked(packed(columns)).tolist() == columns.tolist() and len(packed(columns)) <= 1 << (COLUMN_BITS - 3)
