import hashlib

from helpers import ODD_ROWS, documents

from retailscope.llm.common import fresh_path
from retailscope.llm.exact_dedup import DigestIndex, exact_dedup


def test_odd_rows(spark):
    got = exact_dedup(documents(spark, ODD_ROWS)).collect()
    assert len(got) == len(ODD_ROWS)
    groups = {}
    for doc_id, text, *_ in ODD_ROWS:
        groups.setdefault(text or "", []).append(doc_id)
    want = []
    for doc_id, text, *_ in ODD_ROWS:
        ids = [i for i in groups[text or ""] if i is not None]
        keep = max(ids) if ids else None
        want.append((doc_id, keep, len(groups[text or ""]), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    order = lambda r: (r[4], str(r[0]))
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_empty_table(spark):
    assert exact_dedup(documents(spark, [])).count() == 0


def test_index_persists_and_takes_in_batches(spark):
    path = fresh_path(spark, "index-test")
    first = documents(spark, [(1, "a", "", ""), (2, "a", "", ""), (3, "b", "", "")])
    DigestIndex(spark, path, 4).ingest(first).collect()
    reopened = DigestIndex(spark, path, 64)
    assert reopened.buckets == 4
    second = documents(spark, [(9, "a", "", ""), (10, "c", "", "")])
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in reopened.ingest(second).collect()}
    assert got == {9: (2, False), 10: (10, True)}
    again = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in reopened.ingest(second).collect()}
    assert again == got
    assert reopened.entries().count() == 3


def test_index_is_bucketed_and_read_without_shuffle(spark):
    index = DigestIndex(spark, fresh_path(spark, "index-plan"), 4)
    index.ingest(documents(spark, [(i, str(i), "", "") for i in range(50)])).collect()
    probe = index.entries().select("digest").distinct()
    known = index.entries().select("digest").hint("merge")
    plan = probe.join(known, "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_a_hot_text(spark):
    rows = [(i, "hot" if i % 3 else f"own {i}", "", "") for i in range(3000)]
    got = exact_dedup(documents(spark, rows)).where("group_size > 1").collect()
    assert len(got) == 2000 and {r["keep_id"] for r in got} == {2999} and sum(r["kept"] for r in got) == 1
