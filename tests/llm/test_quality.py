import random
import re
from collections import Counter

import numpy as np

from flowquarry.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n, again = len(words), len(covered)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, again, n < 10 or 100 * again > 20 * n


def test_counts_equal_brute_force(spark):
    rnd = random.Random(7)
    texts = [" ".join(rnd.choice("a b c d# e| \n \n\n f\tg <x>".split(" ")) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = quality.fit([])
    for r in quality.judge(docs, model).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert r.kept == (not r.base_failed)


def test_equal_mixes_of_unequal_windows_are_told_apart(monkeypatch):
    monkeypatch.setattr(quality.np, "argsort", np.argsort)
    ids = np.array([1, 2, 3, 4, 5, 9, 1, 2, 3, 4, 5, 8])
    assert quality.repeated(ids, np.array([0, 12])).tolist() == [10]
    assert quality.repeated(ids, np.array([0, 6, 12])).tolist() == [0, 0]


def test_classifier_separates_and_is_calibrated(spark):
    rnd = random.Random(8)
    good = lambda: " ".join(rnd.choice("stone river house under light walked".split()) for _ in range(40))
    bad = lambda: " ".join(rnd.choice("### %%% BUY!! $$$ NOW!! |x|".split()) + str(rnd.randint(0, 9)) for _ in range(40))
    rows = [(i, good() if i % 3 else bad(), int(i % 3 > 0)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, q int").drop("q")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows[:200]] + [(5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    for r in quality.judge(docs, model).collect():
        assert (r.probability >= 0.5) == bool(rows[r.doc_id][2])
    assert quality.train(docs, labels).weights.tolist() == model.weights.tolist()


def test_edge_rows(edge_docs, empty_docs):
    model = quality.fit([])
    got = {r.doc_id: r.n_words for r in quality.judge(edge_docs, model).collect()}
    assert got == {r.doc_id: brute(r.text)[0] for r in edge_docs.collect()}
    assert quality.judge(empty_docs, model).count() == 0
    assert quality.judge(edge_docs, model, carry=True).select("row.*").columns == edge_docs.columns


def bucket(gram):
    """The bucket of one n-gram, in plain numbers."""
    h, most = 0, (1 << 64) - 1
    for c in gram:
        h = (h + ord(c) + 1) * 0x9E3779B97F4A7C15 & most
    return (((h ^ h >> 29) * 0xD6E8FEB86659FD93 & most) >> 40) % quality.BUCKETS


def test_word_scores_equal_brute_force():
    rnd = random.Random(13)
    weights = np.array([rnd.uniform(-1, 1) for _ in range(quality.BUCKETS)])
    model = quality.Classifier(weights, np.zeros(2 * quality.BUCKETS), 0.0, 1.0, 0.0)
    words = ["".join(rnd.choices("abcß好😀#", k=rnd.randint(1, 12))) for _ in range(300)] + ["", "x"]
    for word, got in zip(words, model.word_scores(words), strict=True):
        raw = f"<{word}>"
        grams = [raw[i : i + k] for k in quality.GRAMS for i in range(len(raw) - k + 1)]
        assert abs(got - weights[quality.own_bucket(word)] - sum(weights[bucket(x)] for x in grams) / len(grams)) < 1e-9
        assert got == model.word_scores([word])[0]  # whatever words stand beside it


def test_long_words_count_to_their_end(spark):
    rnd = random.Random(9)
    weights = np.array([rnd.uniform(-1, 1) for _ in range(quality.BUCKETS)])
    model = quality.Classifier(weights, np.zeros(2 * quality.BUCKETS), 0.0, 1.0, 0.0)
    head = "".join(chr(rnd.randint(0x4E00, 0x4FFF)) for _ in range(64))
    own = lambda w: weights[quality.zlib.crc32(b"w" + w.encode()) % quality.BUCKETS]
    one, two = head + "好" * 200, head + "bad" * 200
    a, b = model.word_scores([one, two])
    assert abs((a - own(one)) - (b - own(two))) > 0.01  # the n-grams differ, not only the whole word
    for n in (65, 99_999, 100_000, 100_001, 250_003):  # chunks lose and repeat no n-gram
        word = "".join(rnd.choices("abcdefgh好", k=n))
        raw = f"<{word}>"
        grams = [raw[i : i + k] for k in quality.GRAMS for i in range(len(raw) - k + 1)]
        mean = sum(weights[bucket(x)] for x in grams) / len(grams)
        assert abs(model.word_scores(["short", word, "words"])[1] - own(word) - mean) < 1e-9


def test_training_reads_long_words_to_their_end():
    rnd = random.Random(10)
    for length in (200, 110_000):
        head = "".join(rnd.choices("abcdef", k=64))
        made = lambda y: head + "".join(rnd.choices("uvw" if y else "xyz", k=length))  # noqa: B023, E731
        model = quality.fit([({made(i % 3 > 0): 1}, quality.pair_counts([]), int(i % 3 > 0)) for i in range(24)])
        good, bad = model.probability(model.word_scores([made(1), made(0)]))
        assert good > 0.5 > bad


def test_word_order_counts():
    """Two texts of the same words differ by their bigrams and borders only; scoring equals brute force."""
    rnd = random.Random(11)
    good = ["stone", "river", "house", "under", "light", "walked"] * 4
    rows = []
    for i in range(120):
        words = list(good) if i % 2 else rnd.sample(good, len(good))
        rows.append((dict(Counter(words)), quality.pair_counts(words), i % 2))
    model = quality.fit(rows)
    texts = [good, rnd.sample(good, len(good)), [], ["one"], ["stone", "river"]]
    flat = [w for x in texts for w in x]
    bounds = np.cumsum([0, *map(len, texts)])
    scores = model.pair_scores(quality.hashes(flat), bounds)
    for words, score in zip(texts, scores, strict=True):
        pairs = quality.pair_counts(words)
        assert abs(score - sum(model.pairs[b] * n for b, n in zip(*pairs)) / max(len(words) - 1, 1)) < 1e-12
    share = model.word_scores(good).mean()
    assert model.probability(share + scores[0]) > 0.5 > model.probability(share + scores[1])
    assert set(quality.pair_counts(["ab", "cd"])[0]) & set(quality.pair_counts(["xab", "cdx"])[0])  # the border's n-gram is shared
