import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

from flowquarry.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_word_ids_equal_library():
    words, library, rnd = packing.WordIds(PATH), Tokenizer.from_file(PATH), random.Random(2)
    parts = ["a", "B", "é", "é", " ", "\n", "  ", "\t", "'s", "'ll", "1", "23", "!?", "<|endoftext|>", "́", "\xa0", "İ", "Σ", "ς", "\x1c", "😀", "Thing,", "ÉCOLE."]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(4000)]
    for text, raw in zip(texts, words.texts(texts), strict=True):
        assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == library.encode(text, add_special_tokens=False).ids


def test_difference_partitions_all_items_evenly():
    rnd = random.Random(1)
    for _ in range(500):
        k, sizes = rnd.randint(1, 9), [rnd.randint(1, 100) for _ in range(rnd.randint(0, 40))]
        found = packing.difference(sizes, k)
        assert len(found) == k and sorted(i for x in found for i in x) == list(range(len(sizes)))
    sums = [sum([rnd.randint(1, 100) for _ in range(200)][i] for i in x) for x in packing.difference([50] * 40, 8)]
    assert len(sums) == 8
    even = packing.difference([8, 7, 6, 5, 4], 2)
    assert abs(sum([8, 7, 6, 5, 4][i] for i in even[0]) - 15) <= 1


def test_window_count_rises_when_capacity_is_exceeded():
    sizes = [40] * 300  # three items fill a window of 128 to 120: 94 windows would do for the tokens, 100 for the items
    assert -(-sum(sizes) // 128) == 94
    windows, padded = packing.pack_group(sizes, 128)
    assert padded and len(windows) == 95 and all(sum(n for *_, n in w) <= 128 for w in windows)  # a further one would be over MAX_PADDING
    sizes = [rnd_size for seed in range(40) for rnd_size in random.Random(seed).choices(range(1, 60), k=100)]
    windows, padded = packing.pack_group(sizes, 2048)
    assert padded and len(windows) > -(-sum(sizes) // 2048) - 1 and all(len({i for i, *_ in w}) == len(w) for w in windows)
    risen = 0
    for seed in range(60):
        rnd = random.Random(seed)
        sizes = [rnd.randint(1, 900) for _ in range(500)]
        least = -(-sum(sizes) // 2048)
        windows, padded = packing.pack_group(sizes, 2048)
        assert padded and sum(n for w in windows for *_, n in w) == sum(sizes) and all(sum(n for *_, n in w) <= 2048 for w in windows)
        assert len(windows) * 2048 * (1 - packing.MAX_PADDING) <= sum(sizes)
        risen += len(windows) > least
    assert risen > 30


def test_small_groups_are_cut_into_windows_without_padding():
    rnd = random.Random(5)
    for _ in range(300):
        sizes = [rnd.randint(1, 127) for _ in range(rnd.randint(1, 20))]
        windows, padded = packing.pack_group(sizes, 128)
        assert sum(n for w in windows for *_, n in w) == sum(sizes)
        assert padded or len(windows) == -(-sum(sizes) // 128)


def test_little_padding_and_mostly_whole_documents():
    rnd, packer, rows, docs = random.Random(8), packing.Packer(0, 2048, 128), [], {}
    for i in range(4000):
        docs[i] = min(20_000, int(rnd.lognormvariate(6, 1.2)) + 1)
        rows += packer.add(i, bytes(4 * docs[i]))
    rows += packer.close()
    loads, pieces = defaultdict(int), defaultdict(int)
    for doc_id, _, length, _, _, sequence, _ in rows:
        loads[sequence] += length
        pieces[doc_id] += 1
    padding = sum(2048 - x for x in loads.values() if x & (x - 1))
    assert padding <= packing.MAX_PADDING * sum(docs.values())
    short = [i for i, n in docs.items() if n < 2048]
    assert sum(pieces[i] == 1 for i in short) >= 0.9 * len(short)


def check(rows, docs, library, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *ids[at : at + p.length]))
            at += p.length
        assert at == len(ids)
    return [sum(p.length for p in x) for x in by_sequence.values()]


def test_pieces_hold_each_id_once(spark):
    library, rnd = Tokenizer.from_file(PATH), random.Random(3)
    docs = [(i, " ".join(rnd.choice(["alpha", "beta", "Gamma,", "ñandú"]) for _ in range(rnd.choice([0, 1, 7, 90, 700])))) for i in range(60)] + [(900, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    loads = check(packing.pack_documents(df, PATH, 64, 4).collect(), docs, library, 64)
    assert sum(64 - x for x in loads if x & (x - 1)) <= 0.03 * sum(loads)


def test_edge_rows(edge_docs, empty_docs):
    rows = packing.pack_documents(edge_docs, PATH).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in edge_docs.collect()}
    assert packing.pack_documents(empty_docs, PATH).count() == 0
