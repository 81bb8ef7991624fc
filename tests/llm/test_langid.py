import random

import numpy as np
import pyarrow as pa
from helpers import ODD_ROWS, documents, fold

from retailscope.llm import langid as L
from retailscope.llm.queries import QUERIES


def texts(seed, n, letters):
    draw = random.Random(seed)
    return [" ".join("".join(draw.choices(letters, k=draw.randint(2, 8))) for _ in range(draw.randint(8, 60))) for _ in range(n)]


def test_odd_rows_and_und(spark):
    training = documents(spark, [(i, t, "xx", "") for i, t in enumerate(texts(1, 30, "abcd"))] + [(99, "no label", None, "")])
    rows = ODD_ROWS + [(50, "ª", "", ""), (51, "...", "", ""), (52, "漢字", "", "")]
    got = L.identify_languages(documents(spark, rows), training).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    want = {i: "xx" if any(c.isalpha() for c in t or "") else "und" for i, t, *_ in rows}
    assert {r["doc_id"]: r["lang_pred"] for r in got} == want


def test_held_out_accuracy_on_the_given_table(spark, small):
    got = QUERIES["op9_language_id"](spark, small).join(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in got)


def test_long_texts_count_whole(monkeypatch):
    table, letters = L.tables()
    text = texts(2, 1, "abcdefgh")[0] * 20
    whole = L.bundles([text, "x"], table, letters)
    monkeypatch.setattr(L, "CHARS_AT_ONCE", 17)
    assert np.array_equal(L.bundles([text, "x"], table, letters), whole)


def test_bundle_is_the_sum_of_bound_permuted_letters():
    table, letters = L.tables()
    symbols = [0, *(table[ord(c)] for c in "to"), 0, *(table[ord(c)] for c in "be"), 0]
    want = np.zeros(L.DIMENSIONS)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        x, y, z = letters.of(np.array([a, b, c]))
        want += np.roll(x, 2).astype(int) * np.roll(y, 1) * z
    assert np.array_equal(L.bundles(["to ... BE"], table, letters)[0], want)


def test_letters_of_all_scripts_have_vectors_of_their_own(spark):
    table, letters = L.tables()
    points = [ord(c) for c in "aßéβвشアの漢字한"] + list(range(0x4E00, 0x4E00 + 500))
    drawn = letters.of(table[points]).astype(int)
    alike = drawn @ drawn.T - L.DIMENSIONS * np.eye(len(points))
    assert np.abs(alike).max() < L.DIMENSIONS / 4
    assert np.array_equal(L.LetterVectors().of(table[points[::-1]])[::-1], drawn), "a vector follows from its letter alone"
    scripts = {"el": "αβγδεζηθικλμ", "ru": "абвгдежзиклм", "ar": "ابتثجحخدذرزس", "zh": "的一是不了人我在有他这中", "ko": "가나다라마바사아자차카타"}
    rows = [(i * 10 + j, t, lang, "") for i, (lang, own) in enumerate(scripts.items()) for j, t in enumerate(texts(i, 10, own))]
    asked = [(i * 10 + j, t, lang, "") for i, (lang, own) in enumerate(scripts.items()) for j, t in enumerate(texts(i + 50, 10, own))]
    got = L.identify_languages(documents(spark, asked), documents(spark, rows)).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {r[0]: r[2] for r in asked}


def test_score_and_label_equal_a_plain_version(spark):
    """Cosines of letter products counted n-gram by n-gram, one text after another."""
    table, letters = L.tables()

    def vector(text):
        symbols = [0]
        for char in text:
            symbol = int(table[ord(char)])
            if symbol or symbols[-1]:
                symbols.append(symbol)
        symbols += [0] if symbols[-1] else []
        out = np.zeros(L.DIMENSIONS)
        for gram in zip(symbols, symbols[1:], symbols[2:]):
            x, y, z = letters.of(np.array(gram)).astype(int)
            out += np.roll(x, 2) * np.roll(y, 1) * z
        return out

    training = [(i, t, lang, "") for i, (t, lang) in enumerate(zip(texts(7, 12, "abcdeé") + texts(8, 12, "defgß"), ["fr"] * 12 + ["de"] * 12))]
    asked = [(i, t, "", "") for i, t in enumerate(texts(9, 8, "abcdefg") + ["a", "Δ", "", "x1y ...z"])]
    prototypes = {lang: sum(vector(t) for _, t, own, _ in training if own == lang) for lang in ("de", "fr")}
    got = {r["doc_id"]: r for r in L.identify_languages(documents(spark, asked), documents(spark, training)).collect()}
    for i, text, *_ in asked:
        own = vector(text)
        cosines = {k: own @ p / np.linalg.norm(p) / (np.linalg.norm(own) or 1) for k, p in prototypes.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert got[i]["lang_pred"] == (best if own.any() else "und")
        assert abs(got[i]["score"] - max(0, cosines[best])) < 1e-6


def test_only_the_most_frequent_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 2)
    rows = documents(spark, [(i, t, ("aa", "bb", "cc")[min(i // 4, 2)], "") for i, t in enumerate(texts(4, 9, "abcdefg"))])
    assert list(L.fit_prototypes(rows.select("lang", "text"))) == ["aa", "bb"]


def test_prototypes_do_not_depend_on_partitions(spark):
    rows = documents(spark, [(i, t, "ab"[i % 2], "") for i, t in enumerate(texts(4, 40, "abcdefg"))])
    one, many = (L.fit_prototypes(rows.select("lang", "text").repartition(n)) for n in (1, 5))
    assert list(one) == list(many) and all(np.array_equal(one[k], many[k]) for k in one)


def test_no_training_and_no_documents(spark):
    docs = documents(spark, ODD_ROWS)
    assert {r["lang_pred"] for r in L.identify_languages(docs, docs.limit(0)).collect()} == {"und"}
    assert L.identify_languages(documents(spark, []), docs).count() == 0


def test_long_columns_are_judged_in_parts(monkeypatch):
    from retailscope.llm import langid

    sizes, whole = [], langid.bundles
    monkeypatch.setattr(langid, "bundles", lambda texts, *rest: sizes.append(len(texts)) or whole(texts, *rest))
    judged = {}
    monkeypatch.setattr(langid.F, "arrow_udf", lambda f, schema: lambda *columns: judged.setdefault("f", f))
    langid.predict(None, {"a": np.ones(langid.DIMENSIONS), "b": -np.ones(langid.DIMENSIONS)})
    texts = pa.array([f"word{i % 7} and {i % 3}" for i in range(1500)] + ["", "12"])
    got = judged["f"](texts)
    assert max(sizes) <= langid.JUDGED_AT_ONCE and sum(sizes) == len(got) == 1502
    assert got[:10].to_pylist() == judged["f"](texts[:10]).to_pylist() and got[-1].as_py()["lang_pred"] == "und"
    assert len(judged["f"](texts[:0])) == 0
