"""Set-similarity self-join on word shingles with token-combination prefixes.

Tokens (shingle hashes) have one global order, rare before frequent. Of a set with n tokens,
at most n - t are missing in a similar set (t: least overlap), so similar sets share tokens in
short prefixes of that order. A rare token of a prefix is a signature by itself. Frequent
tokens fall into classes, and a pair of tokens of a class is a signature; a prefix is extended
until, whatever is missing, a rare token or two tokens of a class are shared:
sum over rare tokens of 1 + sum over classes of (tokens - 1) > n - t. Sets that share a
signature are candidates; their full token sets decide.

Sets meet in the size band of the smaller one. There it gives the signatures of the prefix
that any partner of its size or more needs; the larger one gives, for each band that can hold
a smaller partner, those of the longer prefix that the band's smallest size needs. The band
also fixes the scheme: the order of tokens and the number of classes. Counting tokens is the
costly part, so in the schemes of large sets only tokens with small hashes are counted and
ordered by count, and the others come later, by hash. Small sets give all their tokens. Any
order that two sets share is right, so this changes no result. Tokens that are nearly
everywhere (found from all sets) aren't gathered; they count as most frequent.

Equal sets are one class before the join. A bucket of sets with one signature doesn't emit all
its pairs: its members are first compared with its first member. Buckets that hold several
components then form families, and a family's sets are compared in blocks of bounded size
that emit only links between components. A candidate pair is dropped without its token sets
if bitmaps of the parities of hashed tokens differ in more bits than similar sets differ in
tokens.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordTable, dropped, released, shared_folder, slices, small_batches
from .graphs import components

SHINGLE_WORDS, MIN_PERCENT = 4, 85
#: Share of the hash range whose tokens are counted.
COUNTED = 0.3
#: Tokens in more sets than this are frequent.
RARE = 32
#: Tokens in more than this share of all sets aren't gathered; a task reports those above the second share of its sets.
EVERYWHERE, REPORTED = 0.005, 0.002
#: Tokens that every task may be told of.
EVERYWHERE_TOKENS = 100_000
#: Schemes: least size of a band, classes of frequent tokens, whether all tokens are ordered by count.
SCHEMES = ((1, 1, True), (32, 16, True), (512, 16, False), (1024, 64, False), (8192, 512, False))
SMALL = 512
#: A band's sizes lie within this share of its largest.
BAND = 0.92
#: Sets and tokens that a block of a family holds, about.
BLOCK_SETS, BLOCK_TOKENS = 4096, 2_000_000
#: Entries that one index group holds on average, and the least number of groups.
GROUP_ENTRIES, MIN_GROUPS = 1_000_000, 32
#: Ids of dropped documents that may be broadcast.
BROADCAST_IDS = 4_000_000
#: Bytes of token sets that one step of an Arrow function handles.
SLICE_BYTES = 6_000_000
_CUT = int(COUNTED * 2**64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
SETS = "doc_id long, n int, key binary, low binary, bits array<long>"
#: Bits of a set's parity bitmap, and of the one folded from it for the first comparison.
BITS, FOLDED = 1024, 256


def finished(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case; other letters stay as they are."""
    return text.encode().lower().split()


def _word_hashes(words: list[bytes]) -> list[np.ndarray]:
    import xxhash

    return [np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))]


def word_table() -> WordTable:
    return WordTable(_word_hashes, 120_000)


def token_sets(texts: list[str], table: WordTable, width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, an empty one none."""
    ids, bounds = table.numbers(list(map(words_of, texts)))
    hashes = table.values[0][ids]
    spread = np.zeros(max(len(hashes) - width + 1, 0), dtype=np.uint64)
    for j in range(width):
        spread += hashes[j : j + len(spread)] * _ODD[j]
    spread = finished(spread)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(spread[a : b - width + 1]))
        elif b > a:
            whole = np.full(1, b - a, dtype=np.uint64)
            for h in range(a, b):
                whole = finished(whole * _ODD[4] + hashes[h : h + 1] * _ODD[5])
            out.append(whole)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def least_overlap(a: int, b: int, percent: int = MIN_PERCENT) -> int:
    """Tokens that similar sets of these sizes share at least."""
    return -(-percent * (a + b) // (100 + percent))


def smallest_partner(n: int, percent: int = MIN_PERCENT) -> int:
    return -(-percent * n // 100)


@functools.cache
def _band_starts(least: int) -> list[int]:
    """Least sizes of the bands, up to beyond ``least``."""
    starts = [1]
    while starts[-1] <= least:
        starts.append(max(starts[-1] + 1, int(starts[-1] / BAND) + 1))
    return starts


def bands(n: int, percent: int = MIN_PERCENT) -> list[tuple[int, int, int]]:
    """Bands of a set's partners that aren't larger: least size (which names the band), scheme, longest prefix for them."""
    starts = _band_starts(1 << max(4, n.bit_length()))
    low = smallest_partner(n, percent)
    out = []
    for i in range(bisect.bisect_right(starts, low) - 1, bisect.bisect_right(starts, n)):
        scheme = bisect.bisect_right(SCHEMES, starts[i], key=lambda x: x[0]) - 1
        out.append((starts[i], scheme, n - least_overlap(max(low, starts[i]), n, percent) + 1))
    return out


def gathered(s: np.ndarray, percent: int = MIN_PERCENT) -> np.ndarray:
    """The tokens, smallest hashes first, that a set's prefixes can hold."""
    n = len(s)
    if not n:
        return s
    found = bands(n, percent)
    if found[0][0] < SMALL:
        return s
    longest = found[0][2] + max(SCHEMES[scheme][1] for _, scheme, _ in found)
    return s[: max(int(np.searchsorted(s, np.uint64(_CUT))), longest)]


def parities(s: np.ndarray) -> np.ndarray:
    """For each bit, the parity of the number of tokens that fall on it, packed in 64-bit numbers."""
    odd = np.bincount((s & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def folded(bits: pa.Array) -> pa.Array:
    """Bitmaps of FOLDED bits: bits that meet in one are added up."""
    whole = np.asarray(bits.flatten()).reshape(len(bits), BITS // FOLDED, FOLDED // 64)
    small = np.bitwise_xor.reduce(whole, axis=1)
    return pa.FixedSizeListArray.from_arrays(pa.array(small.ravel()), FOLDED // 64).cast(pa.list_(pa.int64()))


def _sets(percent: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = word_table()
    for batch in batches:
        for part in slices(batch):
            sets = token_sets([x or "" for x in part.column("text").to_pylist()], table, width)
            low = [gathered(x, percent).tobytes() for x in sets]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array(keys, pa.binary()), pa.array(low, pa.binary()), pa.array(list(map(parities, sets)), pa.list_(pa.int64()))], ["doc_id", "n", "key", "low", "bits"])


def _joined(batch: pa.RecordBatch | pa.Table, column: str, kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of byte strings, and each row's count of them."""
    values = batch.column(column)
    size = np.asarray(pc.binary_length(values), dtype=np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(values.to_pylist()), dtype=kind), size


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, "low", SLICE_BYTES)


def _everywhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens in a good share of a task's sets, with their number of sets there."""
    found, sets = [], 0
    for batch in _cut(batches):
        tokens, _ = _joined(batch, "low")
        sets += batch.num_rows
        token, count = np.unique(tokens, return_counts=True)
        often = count >= max(2, REPORTED * batch.num_rows)
        found.append((token[often], count[often]))
    if found:
        token, where = np.unique(np.concatenate([t for t, _ in found]), return_inverse=True)
        count = np.bincount(where, weights=np.concatenate([c for _, c in found])).astype(np.int64)
        often = count >= max(2, REPORTED * sets)
        yield pa.RecordBatch.from_arrays([pa.array(token[often].view(np.int64)), pa.array(count[often])], ["token", "sets"])


def _parts(numbers: np.ndarray, parts: int) -> np.ndarray:
    return (finished(numbers ^ _ODD[2]) % np.uint64(parts)).astype(np.int32)


def _dealt(part: np.ndarray, columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    """One row of byte strings for each part."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, int)
    ends = np.r_[starts[1:], len(part)] if len(part) else starts
    rows = [[c[order[a:b]].tobytes() for a, b in zip(starts, ends, strict=True)] for c in columns]
    yield pa.RecordBatch.from_arrays([pa.array(part[starts], pa.int32()), *(pa.array(r, pa.binary()) for r in rows)], ["part", *names])


def _index(everywhere: np.ndarray, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut(batches):
        tokens, size = _joined(batch, "low")
        reps = np.repeat(np.asarray(batch.column("rep")), size)
        gathered = ~np.isin(tokens, everywhere)
        tokens, reps = tokens[gathered], reps[gathered]
        # A part's tokens stand set by set: each set's id is written once, with its number of tokens.
        part = _parts(tokens, parts)
        order = np.argsort(part, kind="stable")
        part, tokens, reps = part[order], tokens[order], reps[order]
        starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (reps[1:] != reps[:-1])]) if len(part) else np.zeros(0, int)
        runs = np.diff(np.r_[starts, len(part)]).astype(np.int32)
        by_run = next(_dealt(part[starts], [reps[starts], runs], ["reps", "runs"]))
        by_token = next(_dealt(part, [tokens], ["tokens"]))
        yield pa.RecordBatch.from_arrays([by_run.column("part"), by_token.column("tokens"), by_run.column("reps"), by_run.column("runs")], ["part", "tokens", "reps", "runs"])


def _counted(parts: int, group: pa.Table) -> pa.Table:
    """Counts of a group's tokens, dealt back to the sets; single tokens of the counted range are left out."""
    tokens, _ = _joined(group, "tokens")
    reps = np.repeat(_joined(group, "reps", np.int64)[0], _joined(group, "runs", np.int32)[0])
    order = np.argsort(tokens, kind="stable")
    tokens, reps = tokens[order], reps[order]
    starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.zeros(0, int)
    count = np.diff(np.r_[starts, len(tokens)])
    count = np.repeat(count, count).astype(np.int32)
    used = (count > 1) | (tokens >= np.uint64(_CUT))
    tokens, reps, count = tokens[used], reps[used], count[used]
    return pa.Table.from_batches(list(_dealt(_parts(reps.view(np.uint64), parts), [reps, tokens, count], ["reps", "tokens", "counts"])))


def _described(everywhere: np.ndarray, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set's size, its number of gathered tokens in the counted range, and its tokens that are everywhere."""
    for batch in _cut(batches):
        tokens, size = _joined(batch, "low")
        ends = np.cumsum(size)
        counted, often = tokens < np.uint64(_CUT), np.isin(tokens, everywhere)
        total = np.r_[0, np.cumsum(counted & ~often)]
        own = [tokens[a:b][often[a:b]].tobytes() for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True)]
        reps = np.asarray(batch.column("rep"))
        yield pa.RecordBatch.from_arrays([pa.array(_parts(reps.view(np.uint64), parts), pa.int32()), pa.array(reps), batch.column("n"), pa.array(total[ends] - total[ends - size]), pa.array(own, pa.binary()), folded(batch.column("bits"))], ["part", "rep", "n", "counted", "often", "bits"])


def signatures_of(n: int, single: int, tokens: np.ndarray, counts: np.ndarray, percent: int = MIN_PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set of n tokens, and whether it is the larger partner by them.

    tokens, counts: its gathered tokens but for ``single`` counted ones that no other set has and
    that so come first in any order.
    """
    made, larger = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=bool)]
    found = bands(n, percent)
    prefixes = [(*x, True) for x in found] + [(*found[-1][:2], n - least_overlap(n, n, percent) + 1, False)]
    late = tokens >= np.uint64(_CUT)
    orders: dict[int, tuple] = {}
    for band, scheme, needed, probing in prefixes:
        need = needed - single
        if need <= 0 or not len(tokens):
            continue
        if scheme not in orders:
            _, classes, by_count = SCHEMES[scheme]
            order = np.lexsort((tokens, counts)) if by_count else np.lexsort((tokens, np.where(late, 0, counts), late))
            rare = counts[order] <= RARE
            kind = np.where(rare, -1, (finished(tokens[order] ^ _ODD[3]) % np.uint64(classes)).astype(np.int64))
            first = np.zeros(len(tokens), dtype=bool)
            first[np.unique(kind, return_index=True)[1]] = True
            orders[scheme] = tokens[order], counts[order], rare, kind, np.cumsum(rare | ~first)
        token, count, rare, kind, gain = orders[scheme]
        end = int(np.searchsorted(gain, need)) + 1
        seed = np.uint64(band * int(_ODD[1]) % 2**64)
        here = [finished(token[:end][rare[:end] & (count[:end] > 1)] ^ seed)]
        often, of = token[:end][~rare[:end]], kind[:end][~rare[:end]]
        order = np.lexsort((often, of))
        often, of = often[order], of[order]
        for a, b in _runs(of):
            if b - a > 1:
                x, y = np.triu_indices(b - a, 1)
                here.append(finished(finished(often[a + x] ^ seed) * _ODD[0] + often[a + y]))
        made += here
        larger.append(np.full(sum(map(len, here)), probing))
    return np.concatenate(made), np.concatenate(larger)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(values):
        cuts = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]).tolist()
        yield from zip(cuts[:-1], cuts[1:], strict=True)


def _signed(percent: int, counted: pa.Table, described: pa.Table) -> pa.Table:
    """Signatures of a group's sets."""
    reps, _ = _joined(counted, "reps", np.int64)
    tokens, _ = _joined(counted, "tokens")
    counts, _ = _joined(counted, "counts", np.int32)
    counts = counts.astype(np.int64)
    order = np.argsort(reps, kind="stable")
    reps, tokens, counts = reps[order], tokens[order], counts[order]
    shared = np.r_[0, np.cumsum(tokens < np.uint64(_CUT))]
    made: list[np.ndarray] = []
    larger: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    ids, ns = np.asarray(described.column("rep")), np.asarray(described.column("n"))
    totals, often = np.asarray(described.column("counted")), described.column("often").to_pylist()
    starts, ends = np.searchsorted(reps, ids), np.searchsorted(reps, ids, side="right")
    single = totals - (shared[ends] - shared[starts])
    longest = ns - (-(-percent * ns.astype(np.int64) // 100)) + 1
    for i in np.flatnonzero(single < longest).tolist():
        own = np.frombuffer(often[i], dtype=np.uint64)
        some = slice(starts[i], ends[i])
        s, probing = signatures_of(int(ns[i]), int(single[i]), np.concatenate([tokens[some], own]), np.concatenate([counts[some], np.full(len(own), 1 << 40)]), percent)
        made.append(s)
        larger.append(probing)
        owner.append(np.full(len(s), i))
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    of = join(owner, np.int64)
    own = described.select(["rep", "n", "bits"]).take(pa.array(of))
    columns = [pa.array(join(made, np.uint64).view(np.int64)), own.column("rep"), own.column("n"), own.column("bits"), pa.array(join(larger, bool))]
    return pa.table(columns, names=["signature", "rep", "n", "bits", "larger"])


def _full(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = word_table()
    for batch in batches:
        for part in slices(batch):
            sets = token_sets(part.column("text").to_pylist(), table, width)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["rep", "tokens"])


def near_components(docs: DataFrame, percent: int = MIN_PERCENT, width: int = SHINGLE_WORDS, folder: str | None = None) -> DataFrame:
    """Components of documents whose sets of ``width``-word shingles have a Jaccard similarity of percent / 100.

    Input: doc_id, text. Output, a row for each input row: doc_id, n_shingles, component_id
    (smallest doc_id reachable by links, itself included). Null and empty texts and texts
    without a word have no shingles and link with nothing; a text of fewer words than a shingle
    is one shingle. Repeated rows have one component; rows with one doc_id but unlike sets link
    each by its own text. A null doc_id links with nothing and has a null component. Other
    columns are ignored; an empty table gives an empty result.
    """
    small_batches(docs)
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    docs.select("doc_id", "text").mapInArrow(released(functools.partial(_sets, percent, width)), SETS).write.parquet(f"{folder}/sets")
    sets = read("sets")
    own_key = F.coalesce("key", F.lit(b""))
    if not sets.where("doc_id is not null").groupBy("doc_id").agg(F.min(own_key).alias("a"), F.max(own_key).alias("b")).where("a <> b").isEmpty():
        dropped(spark, f"{folder}/sets")
        return _by_row(docs, percent, width, folder)
    sets.where("n > 0 and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("low").alias("low"), F.first("bits").alias("bits")).write.parquet(f"{folder}/reps")
    sets.select("doc_id", "n", "key").write.parquet(f"{folder}/keys")
    dropped(spark, f"{folder}/sets")
    reps = read("reps")
    count, entries = reps.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("low") / 8), F.lit(0))).first()
    parts = max(MIN_GROUPS, int(entries) // GROUP_ENTRIES)
    # The most frequent ones up to a bound; those beyond it are gathered like any other token.
    often = reps.select("low").mapInArrow(released(_everywhere), "token long, sets long").groupBy("token").agg(F.sum("sets").alias("sets")).where(F.col("sets") >= max(RARE + 1, EVERYWHERE * count))
    often = often.orderBy(F.desc("sets"), "token").limit(EVERYWHERE_TOKENS)
    everywhere = np.sort(np.array([r["token"] for r in often.select("token").collect()], dtype=np.int64).view(np.uint64))
    index = reps.select("rep", "low").mapInArrow(released(functools.partial(_index, everywhere, parts)), "part int, tokens binary, reps binary, runs binary")
    counted = index.groupBy("part").applyInArrow(lambda group: _counted(parts, group), "part int, reps binary, tokens binary, counts binary")
    described = reps.select("rep", "n", "low", "bits").mapInArrow(released(functools.partial(_described, everywhere, parts)), "part int, rep long, n int, counted long, often binary, bits array<long>")
    counted.groupBy("part").cogroup(described.groupBy("part")).applyInArrow(lambda one, two: _signed(percent, one, two), "signature long, rep long, n int, bits array<long>, larger boolean").write.parquet(f"{folder}/signatures")

    signed = read("signatures")
    first = signed.where("not larger").groupBy("signature").agg(F.min(F.struct("n", "rep", "bits")).alias("first"))
    first.select("signature", F.col("first.rep").alias("a"), F.col("first.n").alias("a_n"), F.col("first.bits").alias("a_bits")).write.parquet(f"{folder}/firsts")
    after = F.struct("n", "rep") > F.struct(F.col("a_n").alias("n"), F.col("a").alias("rep"))
    pairs = signed.where("larger").join(read("firsts"), "signature").where(after & _may_link("a", "", percent, FOLDED)).select("a", F.col("rep").alias("b")).distinct()
    links = _verified(docs, pairs, percent, width, f"{folder}/round1")
    joined = components(links, f"{folder}/graph1")
    # Families: sets that buckets join whose members aren't in one component by now.
    left = signed.select("signature", "rep", "larger").join(joined, F.col("rep") == F.col("node"), "left").select("signature", "rep", "larger", F.coalesce("component", "rep").alias("component"))
    mixed = left.groupBy("signature").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.bool_or(~F.col("larger")).alias("some"), F.min("rep").alias("a")).where("least <> most and some").select("signature", "a")
    signed.select("signature", "rep").join(mixed, "signature").select("a", F.col("rep").alias("b")).distinct().write.parquet(f"{folder}/open")
    if not read("open").isEmpty():
        families = components(read("open"), f"{folder}/families").select(F.col("node").alias("rep"), F.col("component").alias("family"))
        texts = docs.select("doc_id", "text").join(families.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
        full = texts.mapInArrow(released(functools.partial(_full, width)), "rep long, tokens array<long>")
        full.join(families, "rep").join(reps.select("rep", F.col("bits")), "rep").write.parquet(f"{folder}/members")
        links = links.unionByName(_within(spark, folder, percent, joined, links))
        joined = components(links, f"{folder}/graph4")
    classes = reps.select("key", "rep").join(joined, F.col("rep") == F.col("node"), "left").select("key", F.coalesce("component", "rep").alias("component_id"))
    classes.write.parquet(f"{folder}/classes")
    own = read("keys").join(read("classes"), "key", "left")
    own.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")).write.parquet(f"{folder}/result")
    for name in ("keys", "reps", "signatures", "firsts", "open", "families", "members", "blocks2", "blocks3", "links2", "links3", "round1", "graph1", "graph2", "graph4", "classes"):
        dropped(spark, f"{folder}/{name}")
    return read("result")


def _within(spark: SparkSession, folder: str, percent: int, joined: DataFrame, links: DataFrame) -> DataFrame:
    """Links that join the components of each family, from members: rep, tokens, family, bits.

    A family is dealt into blocks of bounded size. At first each block meets the first one,
    which is linear and all there is to do for a family of one block. Where a larger family
    still has several components, the members outside its largest one meet all others, block
    by block, so that no pair of members in different components goes without a comparison.
    A block emits links that join components, fewer than it has members.
    """
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    size = F.size("tokens")
    parts = lambda: F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum(size) / BLOCK_TOKENS), F.lit(1)).cast("int")
    number = F.pmod(F.xxhash64("rep"), "parts").cast("int")
    labelled = lambda labels: read("members").join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    own = labelled(joined)
    dealt = own.groupBy("family").agg(parts().alias("parts"))
    every = F.when(F.col("part") > 0, F.array("part")).when(F.col("parts") > 1, F.sequence(F.lit(1), F.col("parts") - 1)).otherwise(F.array(F.lit(0)))
    met = own.join(dealt, "family").withColumn("part", number).select("family", F.explode(every).alias("one"), F.lit(0).alias("two"), F.lit(True).alias("left"), "rep", "component", "bits", "tokens")
    _joining(met, percent).write.parquet(f"{folder}/links2")
    found = read("links2")
    large = dealt.where("parts > 1").select("family")
    if large.isEmpty():
        return found
    own = labelled(components(links.unionByName(found), f"{folder}/graph2")).join(large, "family", "left_semi")
    counts = own.groupBy("family", "component").agg(F.count("*").alias("members"))
    most = counts.groupBy("family").agg(F.max(F.struct("members", "component")).alias("most"), F.count("*").alias("kinds")).where("kinds > 1").select("family", F.col("most.component").alias("main"))
    own.join(most, "family").withColumn("apart", F.col("component") != F.col("main")).drop("main").write.parquet(f"{folder}/blocks3")
    own = read("blocks3")
    dealt = own.groupBy("family", "apart").agg(parts().alias("parts")).groupBy("family").agg(F.max(F.when(F.col("apart"), F.col("parts"))).alias("few"), F.max(F.when(~F.col("apart"), F.col("parts"))).alias("many"))
    part = F.when(F.col("apart"), F.pmod(F.xxhash64("rep"), "few")).otherwise(F.col("few") + F.pmod(F.xxhash64("rep"), "many")).cast("int")
    # Pairs of blocks (one, two), one of members apart and not after two: a member of block k meets as one and as two.
    as_one = F.transform(F.sequence(F.col("part"), F.col("few") + F.col("many") - 1), lambda x: F.struct(F.col("part").alias("one"), x.cast("int").alias("two"), F.lit(True).alias("left")))
    last = F.when(F.col("apart"), F.col("part") - 1).otherwise(F.col("few") - 1).cast("int")
    as_two = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda x: F.struct(x.alias("one"), F.col("part").alias("two"), F.lit(False).alias("left"))))
    places = F.concat(F.when(F.col("apart"), as_one).otherwise(F.slice(as_one, 1, 0)), F.coalesce(as_two, F.slice(as_one, 1, 0)))
    met = own.join(dealt, "family").withColumn("part", part).select("family", F.explode(places).alias("place"), "rep", "component", "bits", "tokens").select("family", "place.*", "rep", "component", "bits", "tokens")
    _joining(met, percent).write.parquet(f"{folder}/links3")
    return found.unionByName(read("links3"))


def _joining(met: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of each pair of blocks that join components: members on the left meet all."""
    return met.groupBy("family", "one", "two").applyInArrow(lambda group: _block_links(percent, group), "a long, b long")


def _block_links(percent: int, group: pa.Table) -> pa.Table:
    reps = np.asarray(group.column("rep"))
    kinds, kind = np.unique(np.asarray(group.column("component")), return_inverse=True)
    bits = np.asarray(group.column("bits").combine_chunks().flatten()).view(np.uint64).reshape(len(reps), BITS // 64)
    tokens = group.column("tokens").combine_chunks()
    values, ends = np.asarray(tokens.flatten()), np.cumsum(np.asarray(pc.list_value_length(tokens), dtype=np.int64))
    n = np.diff(np.r_[0, ends])
    left = np.asarray(group.column("left"))
    parent, kind_of = list(range(len(kinds))), kind.tolist()
    set_of = lambda i: values[ends[i] - n[i] : ends[i]]

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    a, b = [], []
    place = np.arange(len(reps))
    mine = np.flatnonzero(left)
    for start in range(0, len(mine), 64):
        some = mine[start : start + 64]
        roots = np.array([root(i) for i in range(len(kinds))])[kind]
        both = n[some][:, None] + n[None, :]
        differ = np.bitwise_count(bits[some][:, None, :] ^ bits[None, :, :]).sum(axis=2, dtype=np.int64)
        overlap = -(-percent * both // (100 + percent))
        may = (differ <= both - 2 * overlap) & (100 * np.minimum(n[some][:, None], n[None, :]) >= percent * np.maximum(n[some][:, None], n[None, :]))
        may &= (roots[some][:, None] != roots[None, :]) & (~left[None, :] | (some[:, None] < place[None, :]))
        x, y = np.nonzero(may)
        for k in np.argsort(differ[x, y], kind="stable").tolist():
            i, j = int(some[x[k]]), int(y[k])
            one, two = root(kind_of[i]), root(kind_of[j])
            if one != two:
                shared = len(np.intersect1d(set_of(i), set_of(j), assume_unique=True))
                if 100 * shared >= percent * (n[i] + n[j] - shared):
                    parent[max(one, two)] = min(one, two)
                    a.append(int(reps[i]))
                    b.append(int(reps[j]))
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _numbered(docs: DataFrame, path: str) -> DataFrame:
    """docs as a column ``row`` beside a number of each row, null where doc_id is; written, so numbers stay."""
    number = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id()).alias("number")
    docs.select(number, F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _by_row(docs: DataFrame, percent: int, width: int, folder: str) -> DataFrame:
    """near_components where a doc_id has unlike sets: rows are linked by numbers of their own."""
    spark = docs.sparkSession
    rows = _numbered(docs.select("doc_id", "text"), f"{folder}/numbered")
    found = near_components(rows.select(F.col("number").alias("doc_id"), "row.text"), percent, width, f"{folder}/rows").withColumnRenamed("doc_id", "number")
    own = found.join(rows.select("number", "row.doc_id"), "number", "left")
    least = own.groupBy("component_id").agg(F.min("doc_id").alias("least"))
    own.join(least, "component_id", "left").select("doc_id", "n_shingles", F.col("least").alias("component_id")).write.parquet(f"{folder}/result")
    for name in ("numbered", "rows"):
        dropped(spark, f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/result")


def first_of_groups(docs: DataFrame, percent: int = MIN_PERCENT, width: int = SHINGLE_WORDS) -> DataFrame:
    """docs without the documents that have a component's smaller doc_id before them; all columns stay.

    Documents without a word and rows with a null doc_id stay. Of rows with one doc_id, one of each
    component stays, and one of those without a word.
    """
    again = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if not again.isEmpty():
        folder = shared_folder(docs.sparkSession)
        rows = _numbered(docs, f"{folder}/numbered")
        found = near_components(rows.select(F.col("number").alias("doc_id"), "row.text"), percent, width, f"{folder}/rows")
        own = found.where("doc_id is not null").withColumnRenamed("doc_id", "number").join(rows.select("number", F.col("row.doc_id").alias("id")), "number")
        some = F.col("n_shingles") > 0
        group = F.struct(some.alias("some"), F.when(some, F.col("component_id")).otherwise(F.col("id")).alias("of"))
        first = own.groupBy(group.alias("group")).agg(F.min(F.struct("id", "number")).alias("first")).select("first.number")
        return rows.join(first, "number", "left_semi").select("row.*").unionByName(rows.where("number is null").select("row.*"))
    found = near_components(docs, percent, width)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    # Ids are broadcast up to a counted bound, so that texts stay where they are; beyond it both sides are shuffled.
    near = lambda ids: F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids
    return docs.join(near(gone), "doc_id", "left_anti").select(*docs.columns)


def _may_link(small: str, large: str, percent: int, bits: int) -> Column:
    """Whether sizes and bitmaps allow a link; columns n and bits, with a prefix, of the smaller and the larger set."""
    column = lambda side, name: F.col(f"{side}_{name}" if side else name)
    a, b = column(small, "n"), column(large, "n")
    differ = sum((F.bit_count(column(small, "bits")[i].bitwiseXOR(column(large, "bits")[i])) for i in range(bits // 64)), F.lit(0))
    overlap = F.ceil((a + b) * percent / F.lit(100.0 + percent) - 1e-9)
    return (a * 100 >= b * percent) & (differ <= a + b - 2 * overlap)


def _verified(docs: DataFrame, pairs: DataFrame, percent: int, width: int, folder: str) -> DataFrame:
    """Those of the candidate pairs (a, b) whose full token sets are similar."""
    spark = docs.sparkSession
    pairs.write.parquet(f"{folder}/pairs")
    pairs = spark.read.parquet(f"{folder}/pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    texts.mapInArrow(released(functools.partial(_full, width)), "rep long, tokens array<long>").write.parquet(f"{folder}/full")
    full = spark.read.parquet(f"{folder}/full")
    left = full.select(F.col("rep").alias("a"), F.col("tokens").alias("a_tokens"))
    right = full.select(F.col("rep").alias("b"), F.col("tokens").alias("b_tokens"))
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    all_ = F.size("a_tokens") + F.size("b_tokens") - both
    pairs.join(left, "a").join(right, "b").where(both * 100 >= all_ * percent).select("a", "b").write.parquet(f"{folder}/links")
    dropped(spark, f"{folder}/full")
    return spark.read.parquet(f"{folder}/links")
