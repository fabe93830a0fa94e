"""Live bindings in every order of arrival."""

import itertools
from datetime import datetime, timedelta

from flowquarry import schemas
from flowquarry.streaming import live

NOW = datetime.now().replace(microsecond=0)



def run(spark, tmp_path, arrivals):
    inbox = tmp_path / "in"
    rows = [(NOW + timedelta(seconds=s), kind, key, mac, "") for key, events in arrivals.items() for kind, mac, s in events]
    spark.createDataFrame(rows, schemas.DHCP_EVENTS).coalesce(1).write.parquet(str(inbox))
    stream = live.live_leases(spark.readStream.schema(schemas.DHCP_EVENTS).parquet(str(inbox)), timedelta(days=1), expire=False)
    q = stream.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return {r.key: (r.candidate, r.closed) for r in spark.read.parquet(str(tmp_path / "out")).collect()}


def test_rules(spark, tmp_path):
    arrivals = {
        "open": [(10, "A", 0)], "renewed": [(10, "A", 0), (11, "A", 9)], "released": [(10, "A", 0), (12, "A", 3)], "tie": [(10, "A", 0), (12, "A", 0)], "reopened too early": [(10, "A", 0), (12, "A", 3), (10, "A", 3)], "reopened": [(10, "A", 0), (12, "A", 3), (10, "A", 4)],
        "handover": [(10, "A", 0), (12, "A", 3), (10, "B", 3)], "handover other order": [(10, "A", 0), (10, "B", 3), (12, "A", 3)], "stale release": [(10, "A", 0), (10, "B", 3), (12, "A", 5)], "older open": [(10, "B", 5), (10, "A", 0)], "late older open of a closed one": [(10, "A", 5), (12, "A", 6), (10, "A", 1)], "release of nothing": [(12, "A", 0)],
    }
    got = run(spark, tmp_path, arrivals)
    assert got == {"open": ("A", False), "renewed": ("A", False), "released": ("A", True), "tie": ("A", True), "reopened too early": ("A", True), "reopened": ("A", False), "handover": ("B", False), "handover other order": ("B", False), "stale release": ("B", False), "older open": ("B", False), "late older open of a closed one": ("A", True)}


def test_newest_wins_in_every_order(spark, tmp_path):
    events = [(10, "A", 0), (11, "A", 4), (10, "B", 7), (12, "B", 9)]
    arrivals = {str(i): list(order) for i, order in enumerate(itertools.permutations(events)) if order.index(events[3]) > order.index(events[2])}
    assert set(run(spark, tmp_path, arrivals).values()) == {("B", True)}
