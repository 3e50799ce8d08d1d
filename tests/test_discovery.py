"""Discovery rules on the worked example, on their limits, and clusters by similarity against all pairs."""

import random
import re

from pyspark.sql import functions as F

from opslake.operators import discovery
from opslake.operators.components import components

TALLY = "source string, host string, sourcetype string, json_app string, content_app string, n long"


def tally(spark, *rows):
    return spark.createDataFrame([(*r[:3], r[3] if len(r) > 4 else None, None, r[-1]) for r in rows], TALLY)


def test_worked_example(spark):
    sources = {r"/var/log/myapp/application.log": 15000, "/opt/payment-service/logs/payment.log": 8500, r"C:\Program Files\OrderSystem\logs\orders.log": 12000, "/var/log/nginx/access.log": 50000, "/app/inventory-api/logs/inventory.log": 6700}
    types = {"myapp:application": 15000, "payment_service_logs": 8500, "order_system": 12000, "access_combined": 50000, "inventory_api_json": 6700}
    hosts = {"myapp-prod-01.company.com": 15000, "payment-server-01": 8500, "order-api-prod-02": 12000, "nginx-lb-01": 50000, "inventory-app-01": 6700}
    rows = [(s, None, None, n) for s, n in sources.items()] + [(None, h, None, n) for h, n in hosts.items()] + [(None, None, t, n) for t, n in types.items()]
    got = {r["app"]: (r["confidence"], r["event_count"], r["methods"]) for r in discovery.merge(discovery.discover(tally(spark, *rows))).collect()}
    assert got == {
        "payment": (64, 25500, ["host", "source", "sourcetype"]), "inventory": (64, 20100, ["host", "source", "sourcetype"]), "order": (51, 24000, ["host", "sourcetype"]), "combined": (38, 50000, ["sourcetype"]),
        "nginx": (38, 50000, ["host"]), "application": (38, 15000, ["source"]), "orders": (38, 12000, ["source"]),
    }
    ranked = [r["app"] for r in discovery.ranked(discovery.merge(discovery.discover(tally(spark, *rows))), 51).collect()]
    assert ranked == ["payment", "inventory", "order"]


def test_limits(spark):
    rows = [("/opt/tiny/x", f"cart-{k:02}.corp", None, 1) for k in range(24)] + [(None, None, f"t{k}_json", "Shop-Service", 8) for k in range(3)] + [(None, None, "a_json", "Few", 10), (None, None, "x-y", "Text", 500), (None, None, None, None)]
    found = discovery.discover(tally(spark, *[r if len(r) > 4 else (*r[:3], r[-1]) for r in rows]))
    got = sorted((r["app"], r["method"], r["event_count"], len(r["sourcetypes"])) for r in found.collect())
    assert got == [("cart", "host", 1, 0)] * 24 + [("shop", "json", 24, 3)]
    assert discovery.discover(tally(spark, *rows), ("json",)).first()["evidence"] == ["[json] t0_json, t1_json, t2_json"]
    # A name of an environment says nothing, and later patterns aren't tried.
    names = spark.createDataFrame([("prd-billing1",), ("web-01-cart",), ("db7ledger",), ("",), (None,)], "h string").select(discovery.host_name(F.col("h"))).collect()
    assert [r[0] for r in names] == [None, None, "ledger", None, None]


def test_clusters_take_the_first_pattern_in_any_case(spark):
    grouped = spark.createDataFrame([("app=cart [Shop] x", 60), ("[basket] MODULE: pay", 70), ("a.b.cInvoice", 80), ("nothing", 90), (None, 90)], "example string, event_count long")
    got = {r["app"]: r["event_count"] for r in discovery.from_clusters(grouped).collect()}
    assert got == {"cart": 60, "pay": 70, "a.b.cinvoice": 80}


def test_similar_clusters_find_the_pairs(spark):
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    texts = []
    for _ in range(60):
        base = r.sample(words, r.randint(6, 20))
        for _ in range(r.randint(1, 5)):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(words)
            texts.append(" ".join(w))
    texts = sorted(set(texts)) + ["", "the the the"]
    shapes = spark.createDataFrame([(t,) for t in texts], "template string")
    sets = {t: {w for w in re.split(r"[^\w<>]+", t) if w} for t in texts}
    want = {(a, b) for a in texts for b in texts if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b])}
    links = {(x["a"], x["b"]) for x in discovery.similar(shapes).collect()}
    assert links <= want
    label = {x["id"]: x["component"] for x in components(shapes.select(F.col("template").alias("id")), discovery.similar(shapes)).collect()}
    assert len(want) > 60
    assert sum(label[a] == label[b] for a, b in want) >= 0.9 * len(want)
    parent = {t: t for t in texts}
    for _ in texts:
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert label == parent
    events = spark.createDataFrame([(f"user {k} logged in from host {k % 7}",) for k in range(60)] + [(f"user {k} logged in from the host {k}",) for k in range(5)] + [(None,)], "message string")
    got = discovery.similar_clusters(events, "message").collect()
    assert [(x["template"], x["event_count"], x["shapes"]) for x in got] == [("user <n> logged in from host <n>", 65, 2)]
    assert discovery.similar_clusters(events.limit(0), "message").count() == 0
