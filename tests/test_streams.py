"""Calls and incidents that come in as streams: no pair is left out, however long an incident lasts or however late its row comes."""

import random
from datetime import datetime, timedelta

import __spark_entry__
from opslake.operators import correlation
from opslake.streaming import jobs

CALLS = "call_id int, vendor string, start_ts timestamp_ntz, end_ts timestamp_ntz"
OUTAGES = "incident_number int, vendor string, opened_at timestamp_ntz, ended_at timestamp_ntz"


def made(r, n, lengths):
    begin = [datetime(2023, 12, 20) + timedelta(minutes=r.choice([r.randrange(80_000), 1440 * r.randrange(56)])) for _ in range(n)]
    return [(k, r.choice(["Acme", "BETA", "beta", None]), b, r.choice([b + timedelta(minutes=r.choice(lengths)), None] if k % 9 == 0 else [b + timedelta(minutes=r.choice(lengths))])) for k, b in enumerate(begin)]


def meet(c, i):
    hour = timedelta(hours=1)
    return None not in (c[1], i[1], c[3], i[3]) and c[1].upper() == i[1].upper() and i[2] <= c[3] + hour and i[3] >= c[2] - hour


def test_each_pair_comes_with_the_later_row(spark, tmp_path):
    r = random.Random(6)
    # Some end before they begin, some last for months.
    calls, outages = made(r, 250, [0, 7, 3000, 40_000, -500]), made(r, 250, [0, 30, 9000, 60_000, 300_000, -500])
    for side, rows, schema in (("calls", calls, CALLS), ("outages", outages, OUTAGES)):
        for n in (0, 1):
            for _ in range(2):  # a batch may come twice
                jobs.landed(f"{tmp_path}/{side}")(spark.createDataFrame([x for x in rows if x[0] % 2 == n], schema), n)
    for kind in ("timestamp_ntz", "timestamp"):
        read = lambda side, kind=kind: spark.read.parquet(f"{tmp_path}/{side}").selectExpr("* except (start_ts, end_ts)" if side == "calls" else "* except (opened_at, ended_at)", *[f"cast({x} as {kind}) as {x}" for x in (("start_ts", "end_ts") if side == "calls" else ("opened_at", "ended_at"))])
        got = lambda *since, read=read: sorted(map(tuple, jobs.new_pairs(read("calls"), read("outages"), since=since or (-1, -1)).collect()))
        want = [(c[0], i[0]) for c in calls for i in outages if meet(c, i)]
        assert got() == sorted(want) and len(want) > 3000
        assert got(0, 0) == sorted(x for x in want if x[0] % 2 or x[1] % 2)
        assert got(0, 1) == sorted(x for x in want if x[0] % 2)
        assert got(1, 1) == []


def test_long_blocks_give_the_same_pairs(spark):
    r = random.Random(7)
    calls, outages = made(r, 120, [0, 7, 3000, 40_000]), made(r, 120, [0, 9000, 300_000])
    c = spark.createDataFrame(calls, "call_id int, _vendor string, _from timestamp_ntz, _to timestamp_ntz")
    i = spark.createDataFrame(outages, "incident_number int, _ivendor string, _opened timestamp_ntz, _ended timestamp_ntz")
    got = [sorted(map(tuple, correlation.met(c, i, days).select("call_id", "incident_number").collect())) for days in (1, 3, 16, 1000)]
    want = sorted((x[0], y[0]) for x in calls for y in outages if None not in (x[1], y[1], x[3], y[3]) and x[1] == y[1] and y[2] <= x[3] and y[3] >= x[2])
    assert got == [want] * 4 and len(want) > 300


def test_calls_meet_incidents_of_more_than_15_days(spark, tmp_path):
    day = lambda n: datetime(2000, 1, 1) + timedelta(days=n)
    lineitem = [(5, 10, 3, 1, 20.0, 1.0, 0.1, 0.0, "A", "O", day(d)) for d in (0, 14, 16, 29, 32)]
    lineitem = [(k, *x[1:]) for k, x in enumerate(lineitem)]
    # Order 50 isn't resolved: it counts for 30 days. Both have vendor 3.
    orders = [(50, 3, "O", 1.0, day(0), "1-URGENT"), (51, 3, "O", 1.0, day(0), "1-URGENT")]
    spark.createDataFrame(lineitem, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    got = __spark_entry__.queries()["stream_call_incidents"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(1, 50), (1, 51), (11, 50), (21, 50), (31, 50)]
