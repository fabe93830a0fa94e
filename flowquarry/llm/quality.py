"""Quality rules: counts by rule, and a calibrated logistic regression on hashed n-grams.

The features of a text are the mean over its words of a hashed word feature and hashed
character n-gram features, and the mean over its pairs of neighbouring words of a hashed word
bigram and a hashed character n-gram over the border between them. The model is linear, so a
word's share of the score is one number, made once for each distinct word and kept in a table
with the word's hashes; scoring a batch is a lookup, a mix of neighbours' hashes and a sum.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordTable, carrying, lean, released, slices, small_batches, sums, with_text

#: Bound of the labelled rows that the classifier is fitted on.
TRAIN_ROWS = 2000
BUCKETS = 1 << 18
GRAMS = (2, 3, 4)
#: Characters on either side of a border between words that its n-gram holds.
BORDER = 2
#: Characters whose n-grams are made at a time. A longer word is read in chunks of so many.
CHUNK_CHARS = 100_000
ROUNDS, PENALTY = 60, 1e-4
#: Every this many-th row of the sample is left out of the fit and calibrates its scores.
CALIBRATE_EVERY = 4
#: Fixed thresholds: words of a text, percent of repeated words, probability of good quality.
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_PROBABILITY = 10, 20, 0.5
WINDOW = 5
SYMBOLS = "#*$%&|<>"
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double"
_BLANKS = "\t\x0b\x0c\r"


def words_of(text: str) -> list[str]:
    """Runs of characters other than the space and U+0009 to U+000D."""
    for blank in _BLANKS:
        if blank in text:
            text = text.replace(blank, " ")
    return list(filter(None, text.replace("\n", " ").split(" ")))


def duplicate_lines(text: str) -> int:
    """Lines that hold a word and equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def repeated(ids: np.ndarray, bounds: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """For each text, its words in windows of ``width`` words that it has twice or more.

    ids: word numbers of all texts, one text after the other. Windows are sorted by a 64-bit
    mix of text and words; neighbours count as equal only if all their words are.
    """
    n = len(ids)
    out = np.zeros(len(bounds) - 1, dtype=np.int64)
    if n < width:
        return out
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    start = np.flatnonzero(text[: n - width + 1] == text[width - 1 :])
    if not len(start):
        return out
    mix = text[start].astype(np.uint64)
    for j in range(width):
        mix = (mix ^ (mix >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[start + j].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(mix, kind="stable")
    near = np.flatnonzero(mix[order[1:]] == mix[order[:-1]])
    if not len(near):
        return out
    cover = np.zeros(n + 1, dtype=np.int64)
    a, b = start[order[near]], start[order[near + 1]]
    same = text[a] == text[b]
    for j in range(width):
        same &= ids[a + j] == ids[b + j]
    if not same.all():  # two windows share a mix: compare the words themselves
        rows = np.column_stack([text[start], *(ids[start + j] for j in range(width))])
        _, kind, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        twice = start[count[kind.ravel()] > 1]
    else:
        twice = np.unique(np.concatenate([a, b]))
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + width, -1)
    return sums((np.cumsum(cover)[:n] > 0).astype(np.int64), bounds)


def own_bucket(word: str) -> int:
    return zlib.crc32(b"w" + word.encode()) % BUCKETS


def grams_of(raw: str) -> list[np.ndarray]:
    """Buckets of the character n-grams at each place of a string, an array for each n."""
    code = np.frombuffer(raw.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    out, h = [], np.zeros(len(code), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        h = (h[: len(code) - n + 1] + code[n - 1 :] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        if n in GRAMS:
            mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
            out.append((mixed >> np.uint64(40)).astype(np.int64) % BUCKETS)
        if n >= len(code):
            break
    return out


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' character n-grams, and the word that each belongs to; a word's stand by n, then by place."""
    size = np.array([len(w) + 2 for w in words], dtype=np.int64)
    word = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(word))
    buckets, owners = [], []
    for n, made in zip(GRAMS, grams_of("".join([f"<{w}>" for w in words])), strict=False):
        whole = left[: len(made)] >= n  # n-grams that don't reach into the next word
        buckets.append(made[whole])
        owners.append(word[: len(made)][whole])
    return np.concatenate(buckets), np.concatenate(owners)


def gram_counts(word: str) -> np.ndarray:
    """How often each bucket stands among a long word's n-grams: totals over chunks that overlap."""
    raw, out = f"<{word}>", np.zeros(BUCKETS, dtype=np.int64)
    for i in range(0, len(raw), CHUNK_CHARS):
        for made in grams_of(raw[i : i + CHUNK_CHARS + max(GRAMS) - 1]):
            out += np.bincount(made[:CHUNK_CHARS], minlength=BUCKETS)
    return out


def hashes(words: list[str]) -> np.ndarray:
    """For each word, hashes of the word, its first and its last characters."""
    crc = zlib.crc32
    made = [(crc(raw), crc(w[:BORDER].encode()), crc(w[-BORDER:].encode())) for w in words for raw in [w.encode()]]
    return np.array(made, dtype=np.uint64).reshape(-1, 3)


def pair_buckets(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the word bigram and of the border of each word (a row of hashes) and the next one."""
    mix = lambda a, b: ((a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40)).astype(np.int64) % BUCKETS
    return mix(own[:-1, 0], own[1:, 0]), mix(own[:-1, 2], own[1:, 1])


def groups(words: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of groups of at most CHUNK_CHARS characters; a longer word is a group by itself."""
    start = held = 0
    for i, word in enumerate(words):
        if i > start and held + len(word) > CHUNK_CHARS:
            yield start, i
            start, held = i, 0
        held += len(word)
    if start < len(words):
        yield start, len(words)


@dataclass
class Classifier:
    """Weights by bucket of words and of pairs, intercept, and the calibration line from score to log-odds."""

    weights: np.ndarray
    pairs: np.ndarray
    intercept: float
    slope: float
    shift: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A word's share: its own weight plus the mean weight of its n-grams."""
        out = np.empty(len(words))
        for start, stop in groups(words):
            if len(words[start]) > CHUNK_CHARS:
                counts = gram_counts(words[start])
                out[start] = self.weights[own_bucket(words[start])] + self.weights @ counts / counts.sum()
            else:
                bucket, owner = features(words[start:stop])
                total, n = (np.bincount(owner, weights=x, minlength=stop - start) for x in (self.weights[bucket], None))
                out[start:stop] = self.weights[[own_bucket(w) for w in words[start:stop]]] + total / n
        return out

    def pair_scores(self, own: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Mean over the pairs of neighbouring words of each text; own: hashes of all words, text after text."""
        pairs = np.maximum(np.diff(bounds) - 1, 0)
        if not pairs.any():
            return np.zeros(len(pairs))
        bigram, border = pair_buckets(own)
        made = np.r_[self.pairs[bigram] + self.pairs[BUCKETS + border], 0.0]
        made[bounds[1:][bounds[1:] > 0] - 1] = 0.0  # a text's last word has no next one
        return sums(made, bounds) / np.maximum(pairs, 1)

    def probability(self, mean_share: np.ndarray) -> np.ndarray:
        odds = self.slope * (mean_share + self.intercept) + self.shift
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -60, 60)))


def fit(rows: list[tuple[dict[str, int], tuple[np.ndarray, np.ndarray], int]]) -> Classifier:
    """Fit on (word counts, pair buckets and their counts, quality) rows by accelerated gradient steps; calibrate on rows left out."""
    near = [p for c, p, _ in rows if c]
    rows = [(c, y) for c, _, y in rows if c]
    labels = np.array([y for _, y in rows], dtype=np.float64)
    if not len(rows) or labels.min() == labels.max():  # nothing to tell apart: the base rate decides
        rate = float(labels.mean()) if len(rows) else 1.0
        return Classifier(np.zeros(BUCKETS), np.zeros(2 * BUCKETS), 0.0, 1.0, 30.0 if rate >= 0.5 else -30.0)
    names = sorted({w for c, _ in rows for w in c})
    number = {w: i for i, w in enumerate(names)}
    doc = np.concatenate([np.full(len(c), i, dtype=np.int32) for i, (c, _) in enumerate(rows)])
    word = np.fromiter((number[w] for c, _ in rows for w in c), dtype=np.int64, count=len(doc))
    use = np.fromiter((n / total for c, _ in rows for total in [sum(c.values())] for n in c.values()), dtype=np.float64, count=len(doc))
    buckets, weights, owners = [], [], []
    for start, stop in groups(names):  # bounded memory: buckets as 32-bit numbers
        own = [own_bucket(w) for w in names[start:stop]]
        if len(names[start]) > CHUNK_CHARS:
            counts = gram_counts(names[start])
            some = np.flatnonzero(counts)
            found, of = some, np.zeros(len(some), dtype=np.int64)
            share = counts[some] / counts.sum()
        else:
            found, of = features(names[start:stop])
            share = 1.0 / np.bincount(of)[of]
        buckets.append(np.concatenate([own, found]).astype(np.int32))
        weights.append(np.concatenate([np.ones(len(own)), share]).astype(np.float32))
        owners.append((np.concatenate([np.arange(len(own)), of]) + start).astype(np.int32))
    bucket, weight, of = np.concatenate(buckets), np.concatenate(weights), np.concatenate(owners)
    del buckets, weights, owners
    # Pairs: text, bucket, share of the text's pairs.
    pair_doc = np.repeat(np.arange(len(near), dtype=np.int32), [len(p) for p, _ in near])
    pair = np.concatenate([p for p, _ in near]).astype(np.int32)
    pair_use = np.concatenate([2 * n / max(n.sum(), 1) for _, n in near]).astype(np.float32)
    held = np.arange(len(rows)) % CALIBRATE_EVERY == 0
    train = ~held if 0 < labels[held].mean() < 1 and 0 < labels[~held].mean() < 1 else np.ones(len(rows), bool)
    balance = np.where(labels == 1, 0.5 / max(labels[train].mean(), 1e-9), 0.5 / max(1 - labels[train].mean(), 1e-9)) * train / train.sum()

    def scores(theta: np.ndarray, intercept: float) -> np.ndarray:
        share = np.bincount(of, weights=theta[:BUCKETS][bucket] * weight, minlength=len(names))
        by_pair = np.bincount(pair_doc, weights=theta[BUCKETS:][pair] * pair_use, minlength=len(rows))
        return np.bincount(doc, weights=share[word] * use, minlength=len(rows)) + by_pair + intercept

    theta, ahead, b, b_ahead, rate = np.zeros(3 * BUCKETS), np.zeros(3 * BUCKETS), 0.0, 0.0, 60.0
    for step in range(ROUNDS):
        error = (1 / (1 + np.exp(-np.clip(scores(ahead, b_ahead), -60, 60))) - labels) * balance
        share = np.bincount(word, weights=use * error[doc], minlength=len(names))
        gradient = np.concatenate([np.bincount(bucket, weights=weight * share[of], minlength=BUCKETS), np.bincount(pair, weights=pair_use * error[pair_doc], minlength=2 * BUCKETS)]) + PENALTY * ahead
        new, new_b = ahead - rate * gradient, b_ahead - error.sum()
        speed = step / (step + 3)
        ahead, b_ahead = new + speed * (new - theta), new_b + speed * (new_b - b)
        theta, b = new, new_b
    # Platt's line on the rows left out, by Newton's method, with its softened targets.
    some = held if train.sum() < len(rows) else train
    s, y = scores(theta, b)[some], labels[some]
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    line = np.array([1.0, 0.0])
    x = np.column_stack([s, np.ones(len(s))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -60, 60)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, x.T @ (p - target))
        line -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return Classifier(theta[:BUCKETS], theta[BUCKETS:], float(b), float(max(line[0], 1e-3)), float(line[1]))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS) -> Classifier:
    """Fit on a bounded sample of labelled rows, chosen by a hash of doc_id.

    A doc_id labelled twice counts with its highest quality; null labels are left out. What reaches
    the driver is the word counts of at most about ``max_rows`` texts.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    total = known.count()
    share = min(1.0, max_rows / max(total, 1))
    point = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    chosen = known.where(point < share)
    sample = docs.where((point < share) & F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                lists = list(map(words_of, part.column("text").to_pylist()))
                made = [Counter(x) for x in lists]
                near = [pair_counts(x) for x in lists]
                known = [part.column(c).cast(pa.int64()) for c in ("doc_id", "quality")]
                yield pa.RecordBatch.from_arrays([*known, pa.array(list(map(list, made)), pa.list_(pa.string())), *(pa.array(x, pa.list_(pa.int32())) for x in ([list(c.values()) for c in made], [p for p, _ in near], [n for _, n in near]))], ["doc_id", "quality", "words", "counts", "pairs", "uses"])

    rows = sample.mapInArrow(released(count), "doc_id long, quality long, words array<string>, counts array<int>, pairs array<int>, uses array<int>").toArrow().sort_by("doc_id")
    names: dict[str, str] = {}  # equal words share one object
    made = []
    for batch in rows.to_batches(max_chunksize=100):
        for q, w, n, p, m in zip(*(batch.column(c).to_pylist() for c in ("quality", "words", "counts", "pairs", "uses")), strict=True):
            made.append((dict(zip([names.setdefault(x, x) for x in w], n, strict=True)), (np.array(p, dtype=np.int32), np.array(m, dtype=np.int32)), int(q > 0)))
    del rows
    return lean(fit, made)


def pair_counts(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's bigrams and, after them, its borders, and how often each stands there."""
    if len(words) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bigram, border = pair_buckets(hashes(words))
    return np.unique(np.concatenate([bigram, BUCKETS + border]), return_counts=True)


def judge(docs: DataFrame, model: Classifier, carry: bool = False) -> DataFrame:
    """Counts and verdict for every whole text.

    Output, a row for each input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, probability. Null and empty texts have no words and fail
    the base rules. Repeated rows give repeated rows, other columns are ignored, an empty table
    gives an empty result; a text at a threshold passes it. No text is cut. With ``carry`` a
    column ``row`` holds all of the input's columns.
    """

    def fill(words: list[str]) -> list[np.ndarray]:
        chars = np.array([(len(w), sum(map(w.count, SYMBOLS)) if not w.isalnum() else 0) for w in words], dtype=np.int64).reshape(-1, 2)
        return [chars, model.word_scores(words), hashes(words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(fill)
        for batch in map(with_text, batches):
            for part in slices(batch):
                texts = [x or "" for x in part.column("text").to_pylist()]
                ids, bounds = table.numbers(list(map(words_of, texts)))
                n = np.diff(bounds)
                chars = sums(table.values[0][ids], bounds)
                probability = model.probability(sums(table.values[1][ids], bounds) / np.maximum(n, 1) + model.pair_scores(table.values[2][ids], bounds))
                again = repeated(ids, bounds)
                failed = (n < MIN_WORDS) | (100 * again > MAX_REPEAT_PERCENT * n)
                columns = [part.column("doc_id").cast(pa.int64()), *(pa.array(x, pa.int64()) for x in (n, chars[:, 0], chars[:, 1], list(map(duplicate_lines, texts)), again)), pa.array(failed), pa.array(~failed & (probability >= MIN_PROBABILITY)), pa.array(probability)]
                yield pa.RecordBatch.from_arrays(columns + ([part.column("row")] if carry else []), [x.split()[0] for x in SCHEMA.split(", ")] + (["row"] if carry else []))

    small_batches(docs)
    if carry:
        rows, schema = carrying(docs, SCHEMA, docs["doc_id"])
        return rows.mapInArrow(released(run), schema)
    return docs.select("doc_id", "text").mapInArrow(released(run), SCHEMA)
