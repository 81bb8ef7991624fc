import random
import re
from collections import Counter

import pytest
from helpers import ODD_ROWS, documents, lowered

from retailscope.llm import source_audit
from retailscope.llm.source_audit import audit_sources, words

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, most):
    """Every share of every kept word, dense, in exact integers."""
    docs = [(lang or "", source or "", Counter(WORD.findall(lowered(text)))) for _, text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for d in own for t in d[2])
        kept = [t for t in held if held[t] >= 3]
        counts = {s: sum((d[2] for d in own if d[1] == s), Counter()) for s in {d[1] for d in own}}
        counts[None] = sum((d[2] for d in own), Counter())
        share = {}
        for s, c in counts.items():
            size = sum(c[t] for t in kept) + len(kept)
            share[s] = {t: 1 + 1_000_000_000 * (c[t] + 1) // size for t in kept}
        for s in counts.keys() - {None}:
            parts = {
                "pair": [(sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept), o) for o in counts.keys() - {None, s}],
                "term": [((share[s][t] - share[None][t]) ** 2 // share[None][t], t) for t in kept if counts[s][t] and share[s][t] > share[None][t]],
            }
            for part, found in parts.items():
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                ordered = ordered[:most] if part == "term" else ordered
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ordered, 1)}
    return out


def test_words():
    for text in ["", "Don't STOP naïve-Ünï 12ab_c`d{e}\x7f\x80é日本 x", "\x85a\xa0b", "@A[Z`a{z|"]:
        assert [w.decode() for w in words(text.encode())] == WORD.findall(lowered(text))


@pytest.mark.parametrize("cells,held", [(1 << 20, 400_000), (5, 10)])
def test_against_dense_version(spark, monkeypatch, cells, held):
    monkeypatch.setattr(source_audit, "CELLS", cells)
    monkeypatch.setattr(source_audit, "HELD_TERMS", held)
    draw = random.Random(8)
    vocabulary = ["the", "The", "cat", "Straße", "日本", "x", "émile", "ß", "zz", "dog's", "a1b", "rare", "twice"]
    rows = ODD_ROWS + [
        (100 + i, " ".join(draw.choices(vocabulary, k=draw.randint(0, 30))), draw.choice(["en", "de", None, ""]), draw.choice(["a", "b", "é", None]))
        for i in range(150)
    ] + [(400, "alone words only", "fr", "a"), (401, "solo", "it", "x"), (402, None, "it", "y")]
    got = audit_sources(documents(spark, rows).repartition(3), most=4).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == plain(rows, 4)


def test_no_rows(spark):
    assert audit_sources(documents(spark, [])).count() == 0
