import duckdb

from flowquarry.llm import licenses

FILLER = "many other words stand around it in this text and go on and on "
GPL = licenses.NOTICES["GPL-3.0"][1]


def texts():
    out = [FILLER * 9 + t + " " + FILLER * 9 for v in licenses.NOTICES.values() for t in v]
    words = GPL.split()
    return [*out, *[t.upper().replace(" ", "\n\t") for t in out], FILLER + " ".join(words[: len(words) * 9 // 10]), FILLER + " ".join(words[: len(words) // 2]), "MIT License", FILLER * 30]


def test_finds_all_notices_and_equals_sql(spark):
    rows = list(enumerate(texts()))
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {tuple(r) for r in found.select("doc_id", "license", "n_places", "containment").collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert got == set(con.execute(f"SELECT doc_id, license, n_places, containment FROM ({licenses.oracle()})").fetchall())
    names = [k for k, v in licenses.NOTICES.items() for _ in v]
    for i, name in enumerate(names * 2):
        assert (i, name) in {(d, x) for d, x, *_ in got}
    tail = {d for d, *_ in got if d >= 2 * len(names)}
    assert tail == {2 * len(names)}  # nine tenths of a notice count, half of it doesn't


def test_repeats_long_texts_and_clashing_ids(spark):
    long = FILLER * 40 + (GPL + " " + FILLER * 3) * 30 + FILLER * 400
    mit = licenses.NOTICES["MIT"][3]
    rows = [(1, long), (1, long), (2, GPL), (2, mit + " " + FILLER), (3, FILLER), (None, GPL)]
    got = {(r.doc_id, r.license): r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (1, "GPL-3.0") in got and got[1, "GPL-3.0"].n_places >= 30 and got[1, "GPL-3.0"].containment == 1
    assert {k for i, k in got if i == 2} >= {"GPL-3.0", "MIT"} and not {i for i, _ in got} & {3, None}
    once = licenses.scan_licenses(spark.createDataFrame(rows[1:2], "doc_id long, text string")).collect()
    assert {(r.license, r.n_places) for r in once} == {(k, r.n_places) for (i, k), r in got.items() if i == 1}


def test_recall_of_altered_notices(spark):
    """Against the exact SQL over notices with words changed here and there."""
    import random

    rnd, rows = random.Random(3), []
    all_ = [t for v in licenses.NOTICES.values() for t in v]
    for i in range(700):
        words = rnd.choice(all_).split()
        for _ in range(rnd.choice([0, 1, 1, 2, 3])):
            words[rnd.randrange(len(words))] = "changed"
        rows.append((i, " ".join([*FILLER.split()[: rnd.randint(0, 12)], *words, FILLER])))
    got = {tuple(r) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "license", "n_places", "containment").collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = set(con.execute(f"SELECT doc_id, license, n_places, containment FROM ({licenses.oracle()})").fetchall())
    assert len(want) > 150 and got <= want and len(got & want) >= 0.99 * len(want)


def test_native_and_edge_rows(spark, edge_docs, empty_docs):
    found = licenses.scan_licenses(edge_docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert found.count() == 0 and licenses.scan_licenses(empty_docs).count() == 0
