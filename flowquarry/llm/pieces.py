"""SentencePiece encoding and decoding with a table of each prefix's last token.

In merge-type tokenization the encoding of a text's prefix ends in one token that the
prefix alone decides, and a sequence of tokens is an encoding exactly when every two
neighbours are: no merge across their border would have come before the merges that made
them. So the table needs one pass: at each position an automaton lists the vocabulary's
tokens that end there, and the one whose left neighbour (the last token where it starts)
is compatible with it is the prefix's last token. Ids are read off from the end.

A text falls into chunks that no token crosses (white space opens a chunk, a character
without a token is a chunk of its own), so chunks are encoded apart and common ones once.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, small_batches

SPACE = "▁"
#: Chunks kept with their ids, half of them the older half; longer ones are always encoded anew.
CACHE, CACHE_CHARS = 1_200_000, 48
#: Results of compatibility tests that are kept.
PAIRS = 500_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PrefixTable:
    """Encoder and decoder for one merge-type SentencePiece model with byte fallback."""

    def __init__(self, model: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i) for i in range(size)]
        self.names = names
        self.bytes = {int(names[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = sp.unk_id()
        # Merges come in the order of scores; a single character is there before any merge.
        plain = [i for i in range(size) if not special[i]]
        self.rank = {names[i]: (-1 if len(names[i]) == 1 else -sp.get_score(i)) for i in plain}
        self.id_of = {names[i]: i for i in plain}
        self.halves: dict[str, tuple[str, str] | None] = {}
        tokens = ahocorasick.Automaton()
        for name in sorted(self.rank, key=len):
            self.halves[name] = self._last_merge(name) if len(name) > 1 else None
            if len(name) == 1 or self.halves[name]:
                tokens.add_word(name, name)
        tokens.make_automaton()
        self.tokens = tokens
        self.cache: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.fits: dict[tuple[str, str], bool] = {}

    def _last_merge(self, name: str) -> tuple[str, str] | None:
        """The two tokens whose merge makes this one; None if merging its characters never does."""
        for cut in range(1, len(name)):
            a, b = name[:cut], name[cut:]
            if self._made(a) and self._made(b) and self.compatible(a, b, below=self.rank[name]):
                return a, b
        return None

    def _made(self, name: str) -> bool:
        return name in self.rank and (len(name) == 1 or self.halves.get(name) is not None)

    def compatible(self, a: str, b: str, below: float = float("inf")) -> bool:
        """Whether the border of a and b stays when their characters are merged.

        Merges are undone latest first. As long as both sides stand as whole tokens, a token
        joining them with a merge before the one that changed a side would have taken the
        border away. On equal ranks the left place is merged first.
        """
        rank, halves = self.rank, self.halves
        # (rank, place): the merge next in time that changes what stands at the border.
        limit = (below, 1)
        while True:
            joint = rank.get(a + b)
            if joint is not None and (joint, 1) < limit:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = (ra, 0), halves[a][1]
            else:
                limit, b = (rb, 2), halves[b][0]

    def _tested(self, left: str, name: str) -> bool:
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        fit = self.fits[left, name] = self.compatible(left, name)
        return fit

    def encode_chunk(self, text: str) -> list[int]:
        """Ids of a text that already has its spaces marked."""
        last: list[str | None] = [None] * (len(text) + 1)
        ends: dict[int, list[str]] = {}
        for end, name in self.tokens.iter(text):
            ends.setdefault(end, []).append(name)
        fits = self.fits
        for end, names in ends.items():
            for name in names:
                before = end + 1 - len(name)
                left = last[before] if before else None
                if left is not None:
                    fit = fits.get((left, name))
                    if fit is None:
                        fit = self._tested(left, name)
                    if not fit:
                        continue
                last[end + 1] = name
                break
            # Otherwise the character has no token; its bytes stand for it and nothing merges with it.
        out: list[int] = []
        at = len(text)
        while at:
            name = last[at]
            if name is None:
                at -= 1
                out.extend(self.bytes.get(b, self.unknown) for b in reversed(text[at].encode()))
            else:
                out.append(self.id_of[name])
                at -= len(name)
        out.reverse()
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: tokens side by side, marks as spaces, bytes read as UTF-8, the first space gone."""
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run = bytearray()
            out.append(self.names[i].replace(SPACE, " "))
        if run:
            out.append(run.decode(errors="replace"))
        text = "".join(out)
        return text[1:] if ids and self.names[ids[0]].startswith(SPACE) else text

    def _found(self, text: str) -> list[tuple[str, str]]:
        """Comma-joined ids and decoded text of each chunk of a text."""
        if not text:
            return []
        keys = self._chunks.findall(SPACE + text.replace(" ", SPACE))
        found = list(map(self.cache.get, keys))
        if None in found:
            for i, key in enumerate(keys):
                if found[i] is None:
                    found[i] = self.older.get(key) or self.cache.get(key) or self._encoded(key)
                    if len(key) <= CACHE_CHARS:
                        self.cache[key] = found[i]
            if len(self.cache) >= CACHE // 2:
                self.cache, self.older = {}, self.cache
        return found

    def _encoded(self, key: str) -> tuple[str, str]:
        ids = self.encode_chunk(key)
        return ",".join(map(str, ids)), " " * self.names[ids[0]].startswith(SPACE) + self.decode(ids)

    @functools.cached_property
    def _chunks(self) -> re.Pattern:
        return re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids joined by commas, SHA-256 of the decoded text."""
        parts = self._found(text)
        ids = ",".join([x for x, _ in parts])
        decoded = "".join([x for _, x in parts])[1:]
        return ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        ids = ",".join(x for x, _ in self._found(text))
        return list(map(int, ids.split(","))) if ids else []


@functools.lru_cache(1)
def prefix_table(model: str) -> PrefixTable:
    """One table a Python worker: its cache then serves all tasks of the worker."""
    return PrefixTable(model)


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """Encode and decode every whole text.

    Output: doc_id, n_tokens, ids_sha256, decoded_sha256, a row for each input row. Null and
    empty texts have no ids: n_tokens 0 and the digests of an empty string. Repeated rows give
    repeated rows, a null doc_id stays null, other columns are ignored, an empty table gives
    an empty result. A text without spaces is one chunk, encoded in time linear in its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = prefix_table(model)
        for batch in batches:
            for part in slices(batch):
                made = [encoder.digest(x or "") for x in part.column("text").to_pylist()]
                n, ids, decoded = map(list, zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    small_batches(docs)
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
