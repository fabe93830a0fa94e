"""Packing into windows of equal capacity by Karmarkar-Karp multiway differencing.

Each Arrow task tokenizes its documents and packs them in groups of bounded size, so nothing
is shuffled and no group grows with the input. In a group, every document is an item (one
longer than a window first gives off whole windows). A partial partition holds k loads;
differencing always merges the two partitions whose largest and smallest loads differ most,
the largest loads of one with the smallest of the other, until one near-equal partition is
left. If a window exceeds the capacity, the group gets one window more and is differenced again,
as long as no more than MAX_PADDING of the windows stays empty. What exceeds the capacity even
then is cut off and laid into windows with room, so most documents stay whole.
"""

from __future__ import annotations

import functools
import heapq
import operator
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import released, slices, small_batches

CAPACITY = 2048
#: Windows in a group: the unit of differencing. Memory of a task is bounded by it.
GROUP_WINDOWS = 128
#: Share of a group's windows that may be padding.
MAX_PADDING = 0.02
END_ID = 1
#: Words kept with their ids, half of them the older half.
CACHE, CACHE_CHARS, RUNS = 1_600_000, 48, 800_000
#: The same where they don't outlive a task.
FEW_WORDS, FEW_RUNS = 300_000, 200_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Partition items into k windows with near-equal sums; returns item numbers by window.

    Loads of a partial partition are kept relative to its smallest and sparse: the missing
    windows have load 0. Ties go to the item that comes first, so the result is fixed.
    """
    if k == 1:
        return [list(range(len(sizes)))]
    # (minus spread, number, loads in falling order as (load, items)); loads not listed are 0.
    heap: list[tuple[int, int, list[tuple[int, list[int]]]]] = [(-n, i, [(n, [i])]) for i, n in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # The largest of a meet the smallest of b: b, padded with zeros to k, in rising order.
        free = k - len(b)
        merged = a[:free]
        for j in range(free, len(a)):
            load, items = b[k - 1 - j]
            merged.append((a[j][0] + load, a[j][1] + items))
        for j in range(max(free, len(a)), k):
            merged.append(b[k - 1 - j])
        merged.sort(key=operator.itemgetter(0), reverse=True)
        if len(merged) == k and (low := merged[-1][0]):
            merged = [(x - low, items) for x, items in merged]
        spread = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        heapq.heappush(heap, (-spread, number, merged))
        number += 1
    found = [items for _, items in heap[0][2]] if heap else []
    return found + [[] for _ in range(k - len(found))]


def pack_group(sizes: list[int], capacity: int = CAPACITY) -> tuple[list[list[tuple[int, int, int]]], bool]:
    """Windows of pieces (item, start, length), and whether their padding is within MAX_PADDING.

    The items' lengths stay below the capacity. Whole items are differenced into the least number
    of windows, then into one more each time a window's capacity is exceeded. Only when another
    window would be too much padding are items cut.
    """
    total = sum(sizes)
    least = max(1, -(-total // capacity))
    most = int(total / (capacity * (1 - MAX_PADDING)))
    for k in range(least, max(least, most) + 1):
        parts = difference(sizes, k)
        if all(sum(sizes[i] for i in items) <= capacity for items in parts):
            return [[(i, 0, sizes[i]) for i in items] for items in parts if items], least <= most
    return _cut(parts, sizes, capacity), least <= most


def _cut(parts: list[list[int]], sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of which what exceeds the capacity is cut off and laid into those with most room."""
    windows: list[list[tuple[int, int, int]]] = []
    over: list[tuple[int, int, int]] = []
    room: list[tuple[int, int]] = []
    for items in parts:
        pieces, used = [], 0
        for i in sorted(items, key=lambda i: (-sizes[i], i)):
            fits = min(sizes[i], capacity - used)
            if fits:
                pieces.append((i, 0, fits))
                used += fits
            if fits < sizes[i]:
                over.append((i, fits, sizes[i] - fits))
        if used < capacity:
            room.append((used - capacity, len(windows)))
        windows.append(pieces)
    heapq.heapify(room)
    for i, start, length in sorted(over, key=lambda x: (-x[2], x[0])):
        while length:
            free, w = room[0]
            fits = min(length, -free)
            windows[w].append((i, start, fits))
            start, length = start + fits, length - fits
            if fits < -free:
                heapq.heapreplace(room, (free + fits, w))
            else:
                heapq.heappop(room)
    return [x for x in windows if x]


def powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Cut a window's pieces into windows whose lengths are powers of two, which need no padding."""
    out, left = [], sum(n for *_, n in pieces)
    queue = list(reversed(pieces))
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        window = []
        while size:
            i, start, n = queue.pop()
            fits = min(n, size)
            window.append((i, start, fits))
            size -= fits
            if fits < n:
                queue.append((i, start + fits, n - fits))
        out.append(window)
    return out


class WordIds:
    """Token ids of whole texts, one space- or line-separated word at a time.

    The tokenizer drops white space and no token crosses it, so a text's ids are its words'
    ids side by side; common words are encoded once. Most words are a run of letters and a run
    of other signs, which the tokenizer's pre-tokenization parts: of those each run is kept
    too, in lower case as its normalization makes it, and goes to its model directly. All
    other words take the tokenizer's whole way.
    """

    _RUNS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")
    #: The printable stand-in of each byte in byte-level vocabularies.
    _KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]

    def __init__(self, path: str, words: int = CACHE, runs: int = RUNS):
        from tokenizers import Tokenizer

        self.most_words, self.most_runs = words, runs
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        other = [b for b in range(256) if b not in set(self._KEPT)]
        self.signs = {b: chr(b) for b in self._KEPT} | {b: chr(256 + i) for i, b in enumerate(other)}
        # Added tokens that could lie in a word of that form; of others none can.
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values() if self._RUNS.fullmatch(t.content))
        self.cache = _Known(self.made, {"": b""})
        self.older: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {"": b""}
        self.older_runs: dict[str, bytes] = {}

    def _run(self, run: str) -> bytes:
        ids = self.runs.get(run)
        if ids is None:
            ids = self.older_runs.get(run)
            if ids is not None:
                self.runs[run] = ids
                return ids
            signs = run if run.isascii() else "".join([self.signs[b] for b in run.encode()])
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(signs)])
            if len(self.runs) >= self.most_runs // 2:
                self.runs, self.older_runs = {"": b""}, self.runs
            self.runs[run] = ids
        return ids

    def made(self, word: str) -> bytes | None:
        """A new word's ids; None where the tokenizer has to be asked."""
        ids = self.older.get(word)
        if ids is None:
            if len(word) > CACHE_CHARS or not (m := self._RUNS.fullmatch(word)) or self.special and any(x in word for x in self.special):
                return None
            letters, signs = m.groups()
            ids = self._run(letters.lower()) + (self._run(signs) if signs else b"")
        return ids

    def texts(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) >= self.most_words // 2:
            self.cache, self.older = _Known(self.made, {"": b""}), self.cache
        ids_of = self.cache.__getitem__
        lists = [x.replace("\n", " ").split(" ") for x in texts]
        found = [list(map(ids_of, words)) for words in lists]
        if asked := self.cache.unknown:
            self.cache.unknown = {}
            whole = list(asked)
            for word, x in zip(whole, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False), strict=True):
                asked[word] = b"".join([i.to_bytes(4, "little") for i in x.ids])
            for words, got in zip(lists, found, strict=True):
                if None in got:
                    got[:] = [asked[w] if x is None else x for w, x in zip(words, got, strict=True)]
            self.cache.update((w, x) for w, x in asked.items() if len(w) <= CACHE_CHARS)
        return list(map(b"".join, found))


class _Known(dict):
    """Words' ids by word. What it doesn't hold it makes; words for the tokenizer give None and gather in ``unknown``."""

    def __init__(self, make: Callable[[str], bytes | None], known: dict[str, bytes]):
        super().__init__(known)
        self.make, self.unknown = make, {}

    def __missing__(self, word: str) -> bytes | None:
        ids = self.make(word)
        if ids is None:
            self.unknown[word] = None
        else:
            self[word] = ids
        return ids


@functools.lru_cache(1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class Packer:
    """Takes documents one by one and gives rows of pieces, group by group."""

    def __init__(self, first: int, capacity: int, group_windows: int):
        # Half of the padding that is allowed is left for the first number of windows.
        self.sequence, self.capacity, self.limit = first, capacity, int(group_windows * capacity * (1 - MAX_PADDING / 2))
        self.items: list[tuple[int | None, int, bytes, int]] = []  # doc_id, start, ids, doc_tokens
        self.held = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        n, at = len(ids) // 4, 0
        while n - at >= self.capacity:
            piece = ids[4 * at : 4 * (at + self.capacity)]
            yield doc_id, at, self.capacity, zlib.crc32(piece), n, self.sequence, 0
            self.sequence += 1
            at += self.capacity
        if at < n:
            if self.held + n - at > self.limit:
                yield from self.close()
            self.items.append((doc_id, at, ids[4 * at :], n))
            self.held += n - at

    def close(self) -> Iterator[tuple]:
        """Pack what is held. A task's last group may be too small for little padding: then its last windows are cut into powers of two."""
        windows, padded = pack_group([len(x[2]) // 4 for x in self.items], self.capacity)
        if not padded:
            short = [x for x in windows if sum(n for *_, n in x) < self.capacity]
            windows = [x for x in windows if sum(n for *_, n in x) == self.capacity] + self._levelled([p for x in short for p in x])
        for pieces in windows:
            offset = 0
            for i, start, length in pieces:
                doc_id, first, ids, n = self.items[i]
                yield doc_id, first + start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, self.sequence, offset
                offset += length
            self.sequence += 1
        self.items, self.held = [], 0

    def _levelled(self, pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
        """Windows with room, filled from the first on; the rest of them as powers of two."""
        out, window, used = [], [], 0
        for i, start, length in pieces:
            while length:
                fits = min(length, self.capacity - used)
                window.append((i, start, fits))
                used, start, length = used + fits, start + fits, length - fits
                if used == self.capacity:
                    out.append(window)
                    window, used = [], 0
        return out + powers(window)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group_windows: int = GROUP_WINDOWS, lasting: bool = True) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` (a power of two) tokens.

    Output, a row for each piece: doc_id, start (tokens of its document before it), length,
    ids_crc32 (of its ids as unsigned little-endian 32-bit numbers), doc_tokens, sequence_id,
    offset (in the sequence, gapless from 0). A document's ids are the tokenizer's without
    special tokens, then id 1. Each id lies in exactly one piece. A document longer than a sequence
    gives off full ones first. At most MAX_PADDING of a group is padding; a task's last group, if it
    is too small for that, is cut into powers of two, which need none. Null and empty texts are one token long.
    Repeated rows are packed each by itself, a null doc_id stays null, other columns are
    ignored, an empty table gives an empty result. sequence_id is the task's number times
    2^40 plus a running number, so a repeated task gives the same rows. With ``lasting`` a worker
    keeps its words' ids from task to task; otherwise each task has fewer of them and drops them at
    its end, for jobs whose other stages need the memory. Results don't depend on that.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer) if lasting else WordIds(tokenizer, FEW_WORDS, FEW_RUNS)
        context = TaskContext.get()
        packer = Packer((context.partitionId() if context else 0) << 40, capacity, group_windows)
        end = END_ID.to_bytes(4, "little")

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], _FIELDS)

        for batch in batches:
            for part in slices(batch):
                texts = [x or "" for x in part.column("text").to_pylist()]
                rows = [row for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.texts(texts), strict=True) for row in packer.add(doc_id, ids + end)]
                if rows:
                    yield batch_of(rows)
        if rows := list(packer.close()):
            yield batch_of(rows)

    small_batches(docs)
    return docs.select("doc_id", "text").mapInArrow(released(run), SCHEMA)
