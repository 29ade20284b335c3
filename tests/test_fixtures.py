"""Payload contract of the three topics (value domains, links between topics)."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiclake.sources.fixtures import records


def test_order_domains(spark, sf):
    o = records(spark, sf, "orders").select("data.*")
    assert {r.currency for r in o.select("currency").distinct().collect()} <= {"BRL", "USD", "EUR"}
    assert {r.method for r in o.select("method").distinct().collect()} == {"Card", "Pix", "Boleto"}
    assert {r.status for r in o.select("status").distinct().collect()} <= {"succeeded", "pending", "failed"}
    assert {r.card_brand for r in o.select("card_brand").distinct().collect()} <= {"Visa", "MasterCard", "Elo"}
    assert o.where(~F.col("card_last4").rlike("^[0-9]{4}$")).count() == 0
    assert o.where(F.col("country") != "BR").count() == 0
    assert o.where(~F.col("ip_address").rlike(r"^10\.0\.[0-9]{1,3}\.[0-9]{1,3}$")).count() == 0
    exact = F.round(F.col("amount").cast("decimal(18,2)") * F.lit("0.9").cast("decimal(2,1)"), 2).cast("double")
    assert o.where(F.col("net_amount") != exact).count() == 0
    assert o.where(~F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3}$")).count() == 0


def test_gps_domains_and_link_to_orders(spark, sf):
    g = records(spark, sf, "gps").select("data.*")
    r = g.agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon"), F.min("speed_kph"), F.max("speed_kph"),
              F.min("accuracy_m"), F.max("accuracy_m")).first()
    assert -23.6 <= r[0] <= r[1] <= -23.5 and -46.7 <= r[2] <= r[3] <= -46.6
    assert 10 <= r[4] <= r[5] <= 60 and 5.0 <= r[6] <= r[7] <= 50.0
    o = records(spark, sf, "orders").select("data.order_key")
    assert g.join(o, g.order_id == o.order_key, "left_anti").count() == 0


def test_events_point_at_order_payments(spark, sf):
    e = records(spark, sf, "events").select("data.payment_id", "data.event.event_name")
    names = {r.event_name for r in e.select("event_name").distinct().collect()}
    assert names <= {"created", "authorized", "captured", "succeeded", "refunded"}
    o = records(spark, sf, "orders").select("data.payment_id")
    assert e.join(o, "payment_id", "left_anti").count() == 0
