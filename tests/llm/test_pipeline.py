"""The pipeline against its stages worked out by hand, and its behaviour on odd input."""

import random
from collections import Counter

import corpus_pipeline
from helpers import ODD_ROWS, documents
from test_decontaminate import brute as contaminated
from test_mixing import brute as mixed
from test_simhash import brute as grouped

from retailscope.llm.common import fresh_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs, small):
    out = []
    for _, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, "stage-test")
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_take_effect(spark, small):
    read = spark.read.parquet(f"{small}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in read.select("doc_id", "text", "lang", "source").collect()]
    told, single, clean, mix, tokens = stages(spark, read, small)
    ids = lambda df: Counter(r["doc_id"] for r in df.select("doc_id").collect())

    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert ids(told) == Counter(r[0] for r in rows)
    heads = {component for _, _, component in grouped(rows)}
    rows = [r for r in rows if r[0] in heads]
    assert ids(single) == Counter(r[0] for r in rows) and len(rows) < 200
    bad = {c[0] for c in contaminated(rows, items) if c[5]}
    rows = [r for r in rows if r[0] not in bad]
    assert ids(clean) == Counter(r[0] for r in rows) and bad
    copies = {i: taken // size for i, size, _, _, taken in mixed(rows) if size}
    assert ids(mix) == Counter({i: n for i, n in copies.items() if n})
    assert ids(tokens) == ids(mix)
    for stage in (told, single, clean, mix):
        assert stage.columns == COLUMNS
    assert corpus_pipeline.run(spark, small).count() == tokens.count()


def test_odd_and_empty_input(spark, small):
    for rows in (ODD_ROWS, []):
        path = fresh_path(spark, "odd-input")
        documents(spark, rows).write.parquet(path)
        told, single, *_, tokens = stages(spark, spark.read.parquet(path), small)
        assert tokens.columns == ["doc_id", "n_tokens", "first_token", "slots"]
        assert single.count() <= told.count() <= len(rows)
        ids = [r["doc_id"] for r in single.collect()]
        assert len(ids) == len(set(ids)) and (not rows or {None, 1, 7} <= set(ids))


def test_near_dedup_tells_rows_apart_without_ids(spark, small):
    draw = random.Random(7)
    a, b, c, d, e, g, h, k = (" ".join("".join(draw.choices("aeinorst", k=6)) for _ in range(60)) for _ in range(8))
    rows = [
        (None, a), (None, b), (None, a),  # unlike texts without ids are documents of their own
        (4, c), (4, d),  # so are unlike texts under one id
        (1, e), (9, e.upper()), (9, g),  # one row of 9 heads a group, the other is a near-copy
        (2, h), (None, h.upper()),  # a near-copy without an id
        (7, k), (7, k), (8, k),
    ]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    single = corpus_pipeline.near_dedup(spark, docs, small)
    assert single.columns == COLUMNS
    got = Counter((r["doc_id"], r["text"]) for r in single.collect())
    assert got == Counter([(None, a), (None, b), (4, c), (4, d), (1, e), (9, g), (2, h), (7, k)])
