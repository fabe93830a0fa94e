"""Language identification with segmentation-marginalised unigrams.

Every language has probabilities for the pieces of one fixed public vocabulary. A word's
probability is the sum over all its segmentations into pieces, made by a forward pass; a
text's is the product over its words. Training counts pieces by expectation maximisation
over the same lattices. Words repeat, so a word's log-probabilities are kept in a table.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordTable, carrying, lean, released, slices, small_batches, sums, with_text

#: Bounds of what the model is fitted on: documents of each language, and languages, the most frequent ones.
#: All words of these documents count.
TRAIN_DOCS, MAX_LANGUAGES = 1000, 500
ROUNDS = 4
SMOOTH = 0.05
#: Up to this length a run's sums fit in plain floating-point numbers; longer runs' sums are held as logarithms
#: (training) or scaled (scoring). Both give the same sums over all segmentations of the whole run.
PLAIN_CHARS = 40
#: Characters whose lattices are made at a time in training.
BLOCK_CHARS = 100_000
#: Probability of a character that has no piece, the same in each language.
UNKNOWN = 1e-6
UND = "und"
MARK = "▁"
_RUNS = re.compile(r"[^\W\d_]+")
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def runs(text: str) -> list[str]:
    """Lower-case runs of letters, whole."""
    return _RUNS.findall(text.lower())


@functools.lru_cache(1)
def vocabulary(model: str) -> dict[str, int]:
    """Numbers of the pieces that can occur in a marked lower-case word."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    names = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    good = sorted(x for x in names if x.removeprefix(MARK).isalpha() or x == MARK)
    return {x: i for i, x in enumerate(good)}


@functools.lru_cache(1)
def longest_piece(model: str) -> int:
    return max(map(len, vocabulary(model)))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)


class PieceIndex:
    """The vocabulary by 64-bit hashes of its pieces; a bitmap of hashes turns most strings down."""

    BITS = 22
    _FACTOR, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

    def __init__(self, pieces: dict[str, int]):
        self.longest = max(map(len, pieces))
        by_hash = {}
        for x, i in pieces.items():
            h = np.zeros(1, dtype=np.uint64)
            for code in code_points(x):
                h = self.extended(h, code)
            by_hash[int(self.finished(h)[0])] = i
        if len(by_hash) < len(pieces):
            raise ValueError("two pieces share a hash")
        self.hashes = np.array(sorted(by_hash), dtype=np.uint64)
        self.numbers = np.array([by_hash[int(h)] for h in self.hashes], dtype=np.int64)
        self.bitmap = np.zeros(1 << self.BITS, dtype=bool)
        self.bitmap[self._place(self.hashes)] = True

    def extended(self, h: np.ndarray, code: np.ndarray) -> np.ndarray:
        return (h + code + np.uint64(1)) * self._FACTOR

    def finished(self, h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> np.uint64(32))) * self._ODD

    def _place(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of pieces, -1 where there is none."""
        h = self.finished(h)
        out = np.full(len(h), -1, dtype=np.int64)
        some = np.flatnonzero(self.bitmap[self._place(h)])
        at = np.minimum(np.searchsorted(self.hashes, h[some]), len(self.hashes) - 1)
        same = self.hashes[at] == h[some]
        out[some[same]] = self.numbers[at[same]]
        return out


@functools.lru_cache(1)
def piece_index(model: str) -> PieceIndex:
    return PieceIndex(vocabulary(model))


@dataclass
class Lattice:
    """Edges of all words, in the order of their ends: word, start, end, piece (-1: no piece)."""

    length: np.ndarray
    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray

    @classmethod
    def of(cls, words: list[str], index: PieceIndex) -> Lattice:
        """All pieces at all places of the words; all strings of one length are looked up at a time."""
        code = code_points("".join([MARK + w for w in words]))
        length = np.array([len(w) + 1 for w in words], dtype=np.int64)
        word = np.repeat(np.arange(len(words)), length)
        start = np.arange(len(code)) - (np.cumsum(length) - length)[word]
        left = length[word] - start
        at, h, found = np.arange(len(code)), np.zeros(len(code), dtype=np.uint64), []
        for n in range(1, index.longest + 1):
            if n > 1:
                more = left[at] >= n
                at, h = at[more], h[more]
            h = index.extended(h, code[at + n - 1])
            piece = index.find(h)
            keep = slice(None) if n == 1 else piece >= 0
            found.append((word[at[keep]], start[at[keep]], start[at[keep]] + n, piece[keep]))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)]
        order = np.argsort(columns[2], kind="stable")
        return cls(length, *(x[order] for x in columns))

    def forward(self, probability: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums over all segmentations of each prefix, and each edge's probability; a column a language."""
        weight = np.concatenate([probability, np.full((1, probability.shape[1]), UNKNOWN)])[self.piece]  # -1: the last row
        alpha = np.zeros((len(self.length), int(self.length.max(initial=0)) + 1, probability.shape[1]))
        alpha[:, 0] = 1.0
        bounds = np.searchsorted(self.end, np.arange(alpha.shape[1] + 1))
        for e in range(1, alpha.shape[1]):
            s = slice(bounds[e], bounds[e + 1])
            step = alpha[self.word[s], self.start[s]] * weight[s]
            for x in range(step.shape[1]):
                alpha[:, e, x] = np.bincount(self.word[s], weights=step[:, x], minlength=len(self.length))
        return alpha, weight

    def expected(self, probability: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (one language) given the words' counts."""
        alpha, weight = self.forward(probability)
        beta = np.zeros(alpha.shape[:2])
        beta[np.arange(len(self.length)), self.length] = 1.0
        order = np.argsort(self.start, kind="stable")[::-1]
        starts = self.start[order]
        for a in range(alpha.shape[1] - 1, -1, -1):
            lo, hi = np.searchsorted(-starts, [-a, -a + 1])
            e = order[lo:hi]
            beta[:, a] += np.bincount(self.word[e], weights=weight[e, 0] * beta[self.word[e], self.end[e]], minlength=len(self.length))
        whole = alpha[np.arange(len(self.length)), self.length, 0]
        use = count[self.word] * alpha[self.word, self.start, 0] * weight[:, 0] * beta[self.word, self.end] / np.maximum(whole[self.word], 1e-300)
        return self._by_piece(use, len(probability))

    def expected_by_logarithms(self, probability: np.ndarray, count: np.ndarray) -> np.ndarray:
        """``expected`` for words of any length: a prefix's sum is held relative to the one before it."""
        n, longest = len(self.length), int(self.length.max(initial=0))
        weight = np.where(self.piece >= 0, probability[self.piece, 0], UNKNOWN)
        alpha, beta = np.zeros((n, longest + 1)), np.zeros((n, longest + 1))
        bounds = np.searchsorted(self.end, np.arange(longest + 2))
        for e in range(1, longest + 1):
            s = slice(bounds[e], bounds[e + 1])
            word, near = self.word[s], alpha[:, e - 1]
            total = np.bincount(word, weights=np.exp(alpha[word, self.start[s]] - near[word]) * weight[s], minlength=n)
            alpha[:, e] = near + np.log(np.where(self.length >= e, total, 1.0))
        order = np.argsort(self.start, kind="stable")
        bounds = np.searchsorted(self.start[order], np.arange(longest + 2))
        for a in range(longest - 1, -1, -1):
            s = order[bounds[a] : bounds[a + 1]]
            word, near = self.word[s], beta[:, a + 1]
            total = np.bincount(word, weights=np.exp(beta[word, self.end[s]] - near[word]) * weight[s], minlength=n)
            beta[:, a] = np.where(self.length > a, near + np.log(np.where(self.length > a, total, 1.0)), 0.0)
        whole = alpha[np.arange(n), self.length]
        use = count[self.word] * weight * np.exp(alpha[self.word, self.start] + beta[self.word, self.end] - whole[self.word])
        return self._by_piece(use, len(probability))

    def _by_piece(self, use: np.ndarray, pieces: int) -> np.ndarray:
        known = self.piece >= 0
        return np.bincount(self.piece[known], weights=use[known], minlength=pieces)


@dataclass
class Model:
    """languages and log-ready probabilities: a row a piece of the vocabulary, a column a language."""

    vocabulary_model: str
    languages: list[str]
    probability: np.ndarray

    def word_scores(self, words: list[str]) -> list[np.ndarray]:
        """Log-probabilities of words; they are handled in blocks, so memory is bounded."""
        if max(map(len, words), default=0) > PLAIN_CHARS:
            made = np.empty((len(words), len(self.languages)))
            short = [i for i, w in enumerate(words) if len(w) <= PLAIN_CHARS]
            made[short] = self.word_scores([words[i] for i in short])[0]
            for i, w in enumerate(words):
                if len(w) > PLAIN_CHARS:
                    made[i] = self.long_score(w)
            return [made]
        index, out = piece_index(self.vocabulary_model), []
        for i in range(0, len(words), 4000):
            lattice = Lattice.of(words[i : i + 4000], index)
            alpha, _ = lattice.forward(self.probability)
            out.append(np.log(np.maximum(alpha[np.arange(len(lattice.length)), lattice.length], 1e-300)))
        return [np.concatenate(out) if out else np.zeros((0, len(self.languages)))]

    def long_score(self, word: str) -> np.ndarray:
        """Log-probabilities of a word of any length: the sums of the last prefixes, scaled, are held."""
        get, text = vocabulary(self.vocabulary_model).get, MARK + word
        longest = longest_piece(self.vocabulary_model)
        held = np.zeros((longest + 1, len(self.languages)))
        held[0], log = 1.0, np.zeros(len(self.languages))
        for e in range(1, len(text) + 1):
            starts, used = [], []
            for a in range(max(0, e - longest), e):
                p = get(text[a:e])
                if p is not None:
                    starts.append(a % len(held))
                    used.append(p)
            total = (held[starts] * self.probability[used]).sum(axis=0)
            if not used or used[-1] != get(text[e - 1]):  # the character has no piece
                total += held[(e - 1) % len(held)] * UNKNOWN
            held[e % len(held)] = total
            held /= total
            log += np.log(total)
        return log


def lattices(words: list[str], model: str) -> Iterator[tuple[slice, Lattice]]:
    """Lattices of the words in blocks of bounded size; the words stand by length, so a block's are alike."""
    index = piece_index(model)
    start = held = 0
    for i, word in enumerate(words):
        if i > start and (held + len(word) > BLOCK_CHARS or len(word) > PLAIN_CHARS >= len(words[start])):
            yield slice(start, i), Lattice.of(words[start:i], index)
            start, held = i, 0
        held += len(word)
    if start < len(words):
        yield slice(start, len(words)), Lattice.of(words[start:], index)


def fit(counts: dict[str, dict[str, int]], vocabulary_model: str, rounds: int = ROUNDS) -> Model:
    """Piece probabilities of each language from its words' counts."""
    pieces, languages = vocabulary(vocabulary_model), sorted(counts)
    table = np.zeros((len(pieces), len(languages)))
    for column, language in enumerate(languages):
        words = sorted(counts[language], key=lambda w: (len(w), w))
        count = np.array([counts[language][w] for w in words], dtype=np.float64)
        blocks = list(lattices(words, vocabulary_model))
        p = np.full((len(pieces), 1), 1.0 / len(pieces))
        for _ in range(rounds):
            use = np.full(len(pieces), SMOOTH)
            for some, lattice in blocks:
                plain = lattice.length.max() <= PLAIN_CHARS + 1
                use += (lattice.expected if plain else lattice.expected_by_logarithms)(p, count[some])
            p = (use / use.sum())[:, None]
        table[:, column] = p[:, 0]
    return Model(vocabulary_model, languages, table)


def train(docs: DataFrame, vocabulary_model: str, max_docs: int = TRAIN_DOCS, max_languages: int = MAX_LANGUAGES) -> Model:
    """Fit on documents with text and lang outside the held-out fold.

    A bounded sample is read: about ``max_docs`` documents of each of the ``max_languages`` most
    frequent languages, chosen by a hash of doc_id. All their words count. Counting is distributed;
    what reaches the driver is the sample's distinct words.
    """
    seen = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r[0]: r[1] for r in seen.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()}
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, max_docs / n))]) if sizes else F.create_map(F.lit(""), F.lit(0.0))
    point = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    sample = seen.where((point < share[F.col("lang")]) & F.col("text").isNotNull()).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                by: dict[str, Counter] = {}
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True):
                    by.setdefault(lang, Counter()).update(runs(text))
                rows = [(lang, w, n) for lang, c in by.items() for w, n in c.items()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], ["lang", "word", "n"])

    words = sample.mapInArrow(released(count), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, dict[str, int]] = {}
    for batch in words.to_batches(max_chunksize=10_000):
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts.setdefault(lang, {})[word] = n
    del words
    return lean(fit, counts, vocabulary_model)


def predict(docs: DataFrame, model: Model, carry: bool = False) -> DataFrame:
    """Language of every whole text.

    Output, a row for each input row: doc_id, held_out, lang_pred, score (the language's posterior
    probability under equal priors). Texts that are null, empty or without a letter, and every text
    when nothing could be learned, are ``und`` with score 0. On equal scores the first language in
    alphabetical order wins. Repeated rows give repeated rows, other columns are ignored, an empty
    table gives an empty result; neither lang, source nor doc_id is looked at. With ``carry`` a
    column ``row`` holds all of the input's columns.
    """
    languages = model.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTable(model.word_scores)
        for batch in map(with_text, batches):
            for part in slices(batch):
                lists = [runs(x or "") for x in part.column("text").to_pylist()]
                n = np.array(list(map(len, lists)), dtype=np.int64)
                long = [(i, w) for i, x in enumerate(lists) if max(map(len, x), default=0) > PLAIN_CHARS for w in x if len(w) > PLAIN_CHARS]
                for i in {i for i, _ in long}:  # long runs hardly repeat, so the table needn't hold them
                    lists[i] = [w for w in lists[i] if len(w) <= PLAIN_CHARS]
                ids, bounds = words.numbers(lists)
                if languages:
                    total = sums(words.values[0][ids], bounds)
                    for i, w in long:
                        total[i] += model.long_score(w)
                    best = total.argmax(axis=1)
                    score = 1.0 / np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -700.0)).sum(axis=1)
                    lang = [languages[k] if m else UND for k, m in zip(best, n, strict=True)]
                    score = np.where(n > 0, score, 0.0)
                else:
                    lang, score = [UND] * len(n), np.zeros(len(n))
                columns = [part.column("doc_id").cast(pa.int64()), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns + ([part.column("row")] if carry else []), ["doc_id", "held_out", "lang_pred", "score"] + (["row"] if carry else []))

    small_batches(docs)
    fold = docs["doc_id"], held_out(docs["doc_id"]).alias("held_out")
    if carry:
        rows, schema = carrying(docs, SCHEMA, *fold)
        return rows.mapInArrow(released(run), schema)
    return docs.select(*fold, "text").mapInArrow(released(run), SCHEMA)
