import random
from collections import defaultdict

import numpy as np
import pytest

from flowquarry.llm import graphs, jaccard
from flowquarry.llm.graphs import components, forest


def brute(rows, percent, width):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(words[j : j + width]) for j in range(len(words) - width + 1)) if len(words) >= width else frozenset([tuple(words)] if words else [])
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(rnd, n):
    """Texts with copies, near copies of every grade, short ones, and passages that many share."""
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 4)))
    passage = [word() for _ in range(12)]
    base, out = [word() for _ in range(60)], []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.35:
            text = list(base)
            for _ in range(rnd.randint(0, 4)):
                text[rnd.randrange(len(text))] = word()
        elif kind < 0.5:
            text = passage[: rnd.randint(1, 12)] + [word() for _ in range(rnd.randint(0, 3))]
        elif kind < 0.6 and out:
            text = rnd.choice(out)[1].split()
        else:
            text = [word() for _ in range(rnd.randint(0, 90))]
            if rnd.random() < 0.5:
                text += passage
        out.append((i, " ".join(text)))
    return out


@pytest.mark.parametrize(("seed", "percent", "width"), [(1, 85, 4), (2, 80, 5)])
def test_equals_brute_force(spark, seed, percent, width, monkeypatch):
    rows = corpus(random.Random(seed), 400)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_components(spark.createDataFrame(rows, "doc_id long, text string"), percent, width).collect()}
    assert got == brute(rows, percent, width)


def test_frequent_tokens_and_large_set_schemes(spark, monkeypatch):
    """With low bounds every scheme, token pair and the tokens that are everywhere come into use."""
    rows = corpus(random.Random(3), 300)
    sets = [np.unique(np.random.default_rng(i).integers(0, 2**63, 700).astype(np.uint64)) for i in range(2)]
    for s in sets:  # a set's signatures don't depend on the order of its tokens
        counts = np.where(s % np.uint64(3) == 0, 100, 2)
        turn = np.random.default_rng(9).permutation(len(s))
        a, b = jaccard.signatures_of(len(s), 0, s, counts), jaccard.signatures_of(len(s), 0, s[turn], counts[turn])
        assert sorted(zip(*a, strict=True)) == sorted(zip(*b, strict=True))
    got = {r.doc_id: r.component_id for r in jaccard.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: c for i, (_, c) in brute(rows, 85, 4).items()}


def variants(rnd, n, words, least, most):
    """Texts that change some words of one text: similar in pairs here and there, alike in their prefixes."""
    base = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rnd.randint(least, most)):
            text[rnd.randrange(words)] = f"x{rnd.randrange(40)}"
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [4096, 40])
def test_families_near_the_threshold(spark, monkeypatch, block):
    """Families of one block, and of many blocks whose members apart meet all others."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    rnd = random.Random(21)
    rows = variants(rnd, 260, 120, 1, 4) + [(1000 + i, text.replace("w", "v")) for i, text in variants(rnd, 150, 60, 0, 3)]
    got = {r.doc_id: r.component_id for r in jaccard.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {i: c for i, (_, c) in brute(rows, 85, 4).items()}
    assert got == want and 5 < len(set(want.values())) < len(rows)


def test_thousands_of_sets_with_one_prefix(spark):
    """A family of 2,000 sets gives links, not pairs."""
    rows = variants(random.Random(22), 2000, 150, 2, 5)
    got = {r.doc_id: r.component_id for r in jaccard.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: c for i, (_, c) in brute(rows, 85, 4).items()}


def test_blocks_emit_fewer_links_than_members():
    import pyarrow as pa

    base = np.arange(1, 201, dtype=np.int64) * 7919
    sets = [np.r_[base, np.arange(3, dtype=np.int64) + 10**9 + 10 * i] for i in range(300)]
    bits = [jaccard.parities(x.view(np.uint64)) for x in sets]
    group = pa.table({"rep": pa.array(range(300)), "component": pa.array(range(300)), "bits": pa.array(bits, pa.list_(pa.int64())), "tokens": pa.array(sets, pa.list_(pa.int64())), "left": pa.array([True] * 300)})
    assert jaccard._block_links(85, group).num_rows == 299


def test_similar_sets_share_a_signature():
    rnd = np.random.default_rng(4)
    for n in (2, 5, 31, 40, 130, 530, 1100, 1500):
        for _ in range(12):
            universe = np.unique(rnd.integers(0, 2**63, 3 * n).astype(np.uint64) * np.uint64(2))
            common = universe[:n]
            missing = int(rnd.integers(0, max(1, n * 15 // 185) + 1))
            x = np.sort(np.concatenate([common[missing:], universe[n : n + missing // 2]]))
            y = np.sort(common)
            both = len(np.intersect1d(x, y))
            if 100 * both < 85 * (len(x) + len(y) - both):
                continue
            count = {int(t): int(rnd.choice([2, 20, 40, 5000])) for t in universe}
            found = []
            for s in (x, y):
                t = jaccard.gathered(s)
                c = np.array([count[int(v)] for v in t])
                found.append(jaccard.signatures_of(len(s), 0, t, c))
            small, large = (found[0], found[1]) if len(x) <= len(y) else (found[1], found[0])
            if n > 1 and not np.array_equal(x, y):
                assert set(small[0][~small[1]]) & set(large[0][large[1]])


def test_first_of_groups_keeps_columns_and_one_of_each(spark, edge_docs, empty_docs):
    kept = jaccard.first_of_groups(edge_docs, 80, 5)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 10 in ids and 11 not in ids and None in ids and 0 in ids
    assert jaccard.near_components(empty_docs).count() == 0 and jaccard.first_of_groups(empty_docs).count() == 0


def test_rows_with_one_id_and_unlike_texts(spark):
    rnd = random.Random(11)
    text = lambda: ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(200)]
    a, b, c, d = (text() for _ in range(4))
    near = lambda x: " ".join([*x[:-1], "other"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (7, near(a)), (7, " ".join(c)), (8, " ".join(d)), (8, near(d)), (8, ""), (8, " "), (9, ""), (None, "x"), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.near_components(docs).collect())
    assert [(i, x) for i, _, x in got] == [(0, None), (0, None), (1, 1), (1, 1), (2, 1), (3, 1), (7, 1), (7, 7), *[(8, 8)] * 4, (9, 9)]
    assert [n for _, n, _ in got] == [1, 1, 197, 197, 197, 197, 197, 197, 0, 0, 197, 197, 0]
    kept = [tuple(r) for r in jaccard.first_of_groups(docs).collect()]
    assert sum(i is None for i, _ in kept) == 2 and {x for i, x in kept if i == 1} == {" ".join(a), " ".join(b)}
    assert sorted((i, len(t.split())) for i, t in kept if i) == [(1, 200), (1, 200), (7, 200), (8, 0), (8, 200), (9, 0)]
    assert (7, " ".join(c)) in kept


def test_edge_rows(edge_docs):
    got = defaultdict(list)
    for r in jaccard.near_components(edge_docs).collect():
        got[r.doc_id].append((r.n_shingles, r.component_id))
    assert got[0] == [(0, 0)] and got[2] == [(0, 2)] and got[3] == [(1, 3), (1, 3)] and got[11] == [(4, 10)] and got[None][0][1] is None


@pytest.mark.parametrize("edges", [1_000_000, 200])
def test_components_of_long_chains_and_stars(spark, monkeypatch, edges):
    monkeypatch.setattr(graphs, "TASK_EDGES", edges)
    rnd = random.Random(6)
    ids = list(range(-200, 1300))
    rnd.shuffle(ids)
    pairs = [(a, b) for a, b in zip(ids[:700], ids[1:700], strict=False)] + [(ids[800], x) for x in ids[801:1200]] + [(5_000, 5_000)]
    df = spark.createDataFrame(pairs, "a long, b long").repartition(16)
    got = {r.node: r.component for r in components(df).collect()}
    assert set(got) == set(ids[:700]) | set(ids[800:1200])
    assert {got[x] for x in ids[:700]} == {min(ids[:700])} and {got[x] for x in ids[800:1200]} == {min(ids[800:1200])}
    nodes, roots = forest(np.array([3, 9, 4]), np.array([2, 4, 9]))
    assert dict(zip(nodes.tolist(), roots.tolist(), strict=True)) == {2: 2, 3: 2, 4: 4, 9: 4}


