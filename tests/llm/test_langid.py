import itertools
import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from flowquarry.llm import langid

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute(word, pieces, probability):
    """Sum over all segmentations, one by one."""
    text, total = langid.MARK + word, np.zeros(probability.shape[1])
    for cuts in itertools.product([False, True], repeat=len(text) - 1):
        parts, start = [], 0
        for i, cut in enumerate((*cuts, True), 1):
            if cut:
                parts.append(text[start:i])
                start = i
        p = np.ones(probability.shape[1])
        for x in parts:
            if x in pieces:
                p = p * probability[pieces[x]]
            elif len(x) == 1:
                p = p * langid.UNKNOWN
            else:
                p = p * 0
        total = total + p
    return total


def test_lattice_holds_all_pieces():
    pieces, rnd = langid.vocabulary(MODEL), random.Random(5)
    words = ["".join(rnd.choices("aeinrstßи的", k=rnd.randint(0, 30))) for _ in range(200)]
    lattice = langid.Lattice.of(words, langid.piece_index(MODEL))
    got = sorted(zip(lattice.word.tolist(), lattice.start.tolist(), lattice.end.tolist(), lattice.piece.tolist(), strict=True))
    want = []
    for w, word in enumerate(words):
        text = langid.MARK + word
        for a in range(len(text)):
            for b in range(a + 1, len(text) + 1):
                if text[a:b] in pieces or b == a + 1:
                    want.append((w, a, b, pieces.get(text[a:b], -1)))
    assert got == sorted(want) and (np.diff(lattice.end) >= 0).all()


def test_forward_sums_all_segmentations():
    pieces, rnd = langid.vocabulary(MODEL), np.random.default_rng(1)
    probability = rnd.random((len(pieces), 2)) / len(pieces)
    model = langid.Model(MODEL, ["a", "b"], probability)
    words = ["the", "straße", "ing", "x", "жук", "çatal"]
    got = model.word_scores(words)[0]
    for word, row in zip(words, got, strict=True):
        assert np.allclose(row, np.log(np.maximum(brute(word, pieces, probability), 1e-300)))


def test_long_pieces_and_long_runs_are_scored_whole():
    import math

    pieces, rnd = langid.vocabulary(MODEL), np.random.default_rng(2)
    assert "▁international" in pieces
    probability = rnd.random((len(pieces), 2)) / len(pieces)
    model = langid.Model(MODEL, ["a", "b"], probability)

    def exact(word):  # all segmentations, without a window or a cut; floats hold up to about 100 characters
        text, out = langid.MARK + word, []
        for x in range(2):
            alpha = [1.0]
            for e in range(1, len(text) + 1):
                weight = lambda a: probability[pieces[text[a:e]], x] if text[a:e] in pieces else langid.UNKNOWN * (e - a == 1)  # noqa: B023, E731
                alpha.append(math.fsum(alpha[a] * weight(a) for a in range(e)))
            out.append(math.log(alpha[-1]))
        return out

    for word in ("international", "internationalthestraße" * 3, "жүкžinternational的" * 3, "и" * 41):
        assert np.allclose(model.word_scores(["the", word])[0][1], exact(word))
    assert np.allclose(model.long_score("internationally"), model.word_scores(["internationally"])[0][0])
    assert langid.runs("Ab" * 100) == ["ab" * 100] and np.isfinite(model.long_score("和" * 5000)).all()


def test_long_runs_are_learned_whole():
    pieces, index, rnd = langid.vocabulary(MODEL), langid.piece_index(MODEL), np.random.default_rng(3)
    p = rnd.random((len(pieces), 1)) / len(pieces)
    words = ["the", "internationale", "жук", "straßeninternationalthe"]
    lattice, count = langid.Lattice.of(words, index), np.array([3.0, 1.0, 2.0, 5.0])
    assert np.allclose(lattice.expected(p, count), lattice.expected_by_logarithms(p, count))
    # Every character of a run of 3,000 letters lies in one piece of each segmentation, or in none.
    long = "international" * 200 + "ing" * 133 + "x"
    use = langid.Lattice.of([long], index).expected_by_logarithms(p, np.ones(1))
    covered = sum(use[i] * len(x) for x, i in pieces.items() if use[i])
    assert np.isfinite(use).all() and abs(covered - len(long) - 1) < 1
    # A piece across the fortieth character counts, as any other.
    head, tail = "q" * 35, max((x for x in pieces if not x.startswith(langid.MARK)), key=lambda x: (len(x), x))
    assert len(tail) > 6 and langid.Lattice.of([head + tail], index).expected_by_logarithms(p, np.ones(1))[pieces[tail]] > 0


def test_texts_without_spaces(spark):
    rnd = random.Random(7)
    letters = {"aa": "日本語文字列処理", "bb": "แผ่นดินไทยภาษา".replace("่", "").replace("ิ", "")}
    rows = [(i, "".join(rnd.choice(letters[k]) for _ in range(500)), k) for i in range(120) for k in [("aa", "bb")[i % 2]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.predict(docs, langid.train(docs, MODEL)).join(docs, "doc_id").where("held_out").collect()
    assert len(found) > 10 and all(r.lang == r.lang_pred for r in found)


def test_training_raises_likelihood():
    counts = {"xx": {"abab": 50, "abcab": 20, "cab": 5}}
    word = list(counts["xx"])
    weight = np.array(list(counts["xx"].values()))
    scores = [float(langid.fit(counts, MODEL, rounds=k).word_scores(word)[0][:, 0] @ weight) for k in (1, 2, 4)]
    assert scores[0] < scores[1] <= scores[2] + 1e-6


WORDS = {"en": "the and with house river stone under".split(), "de": "der und mit haus fluss stein unter".split(), "fr": "le et avec maison rivière pierre sous".split()}


def table(spark, n=240):
    rnd = random.Random(4)
    rows = []
    for i in range(n):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, " ".join(rnd.choice(WORDS[lang]) for _ in range(20)), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy_and_fold(spark):
    docs = table(spark)
    found = langid.predict(docs, langid.train(docs, MODEL)).join(docs, "doc_id")
    held = found.where("held_out").collect()
    assert len(held) > 20 and all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in held)
    assert found.where(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)).count() == 0


def test_held_out_labels_are_not_learned(spark):
    docs = table(spark)
    wrong = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    model = langid.train(wrong, MODEL)
    assert "zz" not in model.languages and np.array_equal(model.probability, langid.train(docs, MODEL).probability)


def test_edge_rows(spark, edge_docs, empty_docs):
    model = langid.train(table(spark), MODEL)
    rows = {(r.doc_id, r.lang_pred == langid.UND) for r in langid.predict(edge_docs, model).collect()}
    und = {r.doc_id for r in edge_docs.collect() if not any(map(str.isalpha, r.text or ""))}
    assert {i for i, u in rows if u} == und
    assert langid.predict(empty_docs, model).count() == 0
    nothing = langid.train(empty_docs, MODEL)
    assert {r.lang_pred for r in langid.predict(edge_docs, nothing).collect()} == {langid.UND}
    carried = langid.predict(edge_docs, model, carry=True).select("row.*")
    assert carried.columns == edge_docs.columns and carried.count() == edge_docs.count()
