import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import ODD_ROWS, documents
from test_tokens import ODD_TEXTS, spun
from tokenizers import Tokenizer

from retailscope.llm import spill_counts, token_alignment
from retailscope.llm.spill_counts import PairCode, cut_runs, merge_counts, pairs_of, read_blocks, with_maxima, write_blocks
from retailscope.llm.token_alignment import align_tokens, byte_of_letter

STRANGE = [
    "▁ x", "a▁b", "日本語のテキスト。" * 50, "line\n" * 30, "\r\n x\r\n\ry", "tab\t\tx\n\n\n y ", "a\x00b\x1c c", " x　 y",
    "\n", "\t x", " \n x", "<unk> <s> </s> <0x41>", "Å ﬁ \u0085", "x  y\x0b\x0cz", "({\r\n});\r\n",
]


def plain(texts):
    """Every text tokenized whole, ends intersected as sets, pairs counted in one dictionary."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = byte_of_letter()
    pairs, rows = Counter(), []
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        as_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        as_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or not b"".join(as_a) == b"".join(as_b) == (" " + text).encode():
            rows.append(None)
            continue
        ends_a, ends_b = np.cumsum([*map(len, as_a)]).tolist(), np.cumsum([*map(len, as_b)]).tolist()
        place_a, place_b = ({e: i for i, e in enumerate(ends)} for ends in (ends_a, ends_b))
        shared = sorted(place_a.keys() & place_b.keys())
        links = [(ids_a[place_a[e]], ids_b[place_b[e]]) for e in shared]
        groups, x, y = [], 0, 0
        for end in shared:
            to_a, to_b = place_a[end] + 1, place_b[end] + 1
            groups.append(",".join(map(str, ids_a[x:to_a])) + "|" + ",".join(map(str, ids_b[y:to_b])))
            x, y = to_a, to_b
        pairs.update(links)
        rows.append((len(ids_a), len(ids_b), groups, links))
    most = Counter()
    for (_, y), n in pairs.items():
        most[y] = max(most[y], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if r is None else (
            r[0], r[1], len(r[2]), len(r[3]), sum(pairs[p] == most[p[1]] for p in r[3]), sum(pairs[p] for p in r[3]),
            hashlib.sha256(";".join(r[2]).encode()).hexdigest())
        for r in rows
    ]


@pytest.mark.parametrize("small_runs", [False, True])
def test_whole_texts(spark, monkeypatch, small_runs):
    if small_runs:
        monkeypatch.setattr(token_alignment, "UNIT_BYTES", 300)
        monkeypatch.setattr(token_alignment, "RUN_RECORDS", 500)
    draw = random.Random(4)
    prose = [" ".join(draw.choices(["the", "quick", "brown", "façade", "zurück", "x1", "it's", "«non»"], k=40)) for _ in range(200)]
    rows = ODD_ROWS + [(100 + i, t, "", "") for i, t in enumerate(ODD_TEXTS + STRANGE + spun(11, 300) + prose)]
    wanted = sorted(
        (str(r[0]), *w) for r, w in zip(rows, plain([r[1] or "" for r in rows]))
    )
    docs = documents(spark, rows).repartition(5)
    got = align_tokens(docs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == wanted


def test_no_rows(spark):
    assert align_tokens(documents(spark, [])).count() == 0


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(token_alignment, "MAX_PIECES", 20)
    pieces = token_alignment.AlignedPieces(token_alignment.VOCABULARY_A, token_alignment.VOCABULARY_B)
    texts = spun(5, 200) + STRANGE
    wanted = plain(texts)
    for text, w in zip(texts, wanted):
        if text:
            sums, digests, links, _ = pieces.align([text])
            assert (*sums[0], digests[0]) == (*w[:3], w[6]) and len(links) == w[3], repr(text)
        assert len(pieces.number) < 200


def test_runs_merge_to_counts_and_maxima(monkeypatch):
    monkeypatch.setattr(spill_counts, "BLOCK", 7)
    code, draw = PairCode(50, 1000, 4), random.Random(3)
    seen, streams = Counter(), [[] for _ in range(4)]
    for _ in range(9):
        records = [(draw.randint(0, 49), draw.choice([0, 1, 999]), draw.randint(0, 20)) for _ in range(200)]
        seen.update((s, p) for s, p, _ in records)
        keys = np.array([code.of(s, p) << code.place_bits | place for s, p, place in records])
        for part, run in cut_runs(keys, code):
            keys, times = (np.concatenate(c) for c in zip(*read_blocks(run)))
            assert (np.diff(keys) > 0).all() and write_blocks(keys, times) == run
            streams[part].append(run)
    found, order = {}, []
    for part, runs in enumerate(streams):
        for pair, n, best in with_maxima(merge_counts([pairs_of(r, code.place_bits) for r in runs]), code):
            assert code.first_of(part) <= pair < code.first_of(part + 1)
            order.append(pair)
            found[pair] = (n, best)
    assert order == sorted(set(order))
    most = {s: max(n for (t, _), n in seen.items() if t == s) for s, _ in seen}
    assert found == {code.of(s, p): (n, n == most[s]) for (s, p), n in seen.items()}
