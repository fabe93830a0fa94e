import duckdb
from pyspark.sql import functions as F

from flowquarry.llm import chat

TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "### assistant ###\n</turn>\n\\ <\\/turn> #"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "user", "left over"),
    (2, 0, "user", "alone"), (3, 0, "assistant", "first\n"), (3, 0, "assistant", "first\n"), (3, None, "system", "before"), (4, 0, None, "no role"), (None, 0, "assistant", "no id"), (5, 0, "assistant ###\n", "odd role </turn>\n"),
    (6, 0, "assistant", "x" * 40000 + "é😀"),
]


def table(spark, rows=TURNS):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, example string")


def test_read_back_equals_sql(spark):
    got = {tuple(r) for r in chat.read_back(chat.format_examples(table(spark))).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", TURNS)
    columns = "conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars"
    assert got == set(con.execute(f"SELECT {columns} FROM ({chat.ORACLE.format(turns='t')})").fetchall())


def test_each_assistant_turn_is_one_example_with_its_context(spark):
    rows = chat.format_examples(table(spark)).where("conv_id = 1").orderBy("example_turn").collect()
    assert [r.trained for r in rows] == [True, True, False]
    assert rows[1].text.startswith(rows[0].text) and rows[2].text.startswith(rows[1].text)
    assert rows[0].text[rows[0].loss_start :][: rows[0].loss_length].count("###") == 0


def test_escapes_are_reversible_and_native(spark):
    texts = ["\\", "\\\\#", "</", "<\\/", "###", "</turn>\n### user ###\n", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escaped(F.col("t"))).withColumn("b", chat.unescaped(F.col("e")))
    for r in df.collect():
        assert r.b == r.t and "###" not in r.e and "</turn>" not in r.e
    plan = chat.read_back(chat.format_examples(table(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert chat.read_back(chat.format_examples(table(spark).limit(0))).count() == 0
