import random
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.sources import normalize

MSG_FIELDS = "timestamp double, receipt_timestamp double, exchange string, symbol string"


def test_random_trade_messages_follow_the_definition(spark):
    r = random.Random(31)
    sent = []
    for k in range(40):
        price, amount = Decimal(r.randint(1, 10**7)) / 1000, Decimal(r.randint(1, 10**6)) / 10**4
        sent.append((float(1_600_000_000 + 97 * k), float(1_600_000_001 + 97 * k), "VENUE", f"S{k % 3}", r.choice(["buy", "sell"]), str(price), str(amount), r.choice([None, f"id{k}"])))
    msgs = spark.createDataFrame(sent, f"{MSG_FIELDS}, side string, price string, amount string, id string")
    got = normalize.normalize_trades(msgs).withColumn("seconds", F.unix_micros("timestamp") / 1_000_000).collect()
    rows = {x.seconds: x for x in got}
    assert len(rows) == len(sent)
    for t, _, venue, symbol, side, price, amount, name in sent:
        x = rows[t]
        assert (x.exchange, x.symbol, x.side, x.trade_id) == (venue, symbol, side, name)
        assert (x.price, x.quantity, x.notional) == (float(price), float(amount), float(price) * float(amount))


def test_trade_message_zero_timestamp_is_null(spark):
    msgs = spark.createDataFrame(
        [(0.0, 1.0, "EX", "BTC", "sell", "1", "1", None)],
        f"{MSG_FIELDS}, side string, price string, amount string, id string",
    )
    row = normalize.normalize_trades(msgs).first()
    assert row["timestamp"] is None
    assert row["trade_id"] is None


BOOK_SIDE = T.MapType(T.StringType(), T.StringType())
BOOK = T.StructType([T.StructField("bid", BOOK_SIDE), T.StructField("ask", BOOK_SIDE)])


def _book_msgs(spark, payload, field="book"):
    schema = T.StructType(
        [
            T.StructField("timestamp", T.DoubleType()),
            T.StructField("receipt_timestamp", T.DoubleType()),
            T.StructField("exchange", T.StringType()),
            T.StructField("symbol", T.StringType()),
            T.StructField(field, BOOK),
        ]
    )
    return spark.createDataFrame([(1710000000.0, 1710000000.5, "EX", "BTC", payload)], schema)


def test_random_books_equal_a_plain_top_k(spark):
    r = random.Random(32)
    for depth in (3, 12):
        size = lambda: str(r.randint(1, 900) / 8)
        book = {"bid": {str(r.randint(1, 400) / 4): size() for _ in range(r.randint(1, 20))}, "ask": {str(100 + r.randint(1, 400) / 4): size() for _ in range(r.randint(1, 20))}}
        row = normalize.normalize_book(_book_msgs(spark, book), depth=depth).first()
        top = {}
        for side, sign in (("bid", -1), ("ask", 1)):
            levels = sorted(((float(p), float(q)) for p, q in book[side].items()), key=lambda x: sign * x[0])[:depth]
            top[side] = levels
            assert row[f"{side}_px"] == [p for p, _ in levels] + [0.0] * (depth - len(levels))
            assert row[f"{side}_sz"] == [q for _, q in levels] + [0.0] * (depth - len(levels))
            for n in (5, 10):
                assert row[f"{side}_depth_{n}"] == sum(q for _, q in levels[:n])
        (bid, b), (ask, a) = top["bid"][0], top["ask"][0]
        middle = (bid + ask) / 2
        assert (row.best_bid, row.best_ask, row.mid_price) == (bid, ask, middle)
        assert abs(row.spread_bps - 10_000 * (ask - bid) / middle) < 1e-9
        assert abs(row.microprice - (b * ask + a * bid) / (a + b)) < 1e-9
        for name, n in (("top1", 1), ("top5", 5), ("top10", 10)):
            x, y = (sum(q for _, q in top[side][:n]) for side in ("bid", "ask"))
            assert abs(row[f"imbalance_{name}"] - (x - y) / (x + y)) < 1e-12


def test_book_depth_truncates_and_one_empty_side(spark):
    bids = {str(100 - i): "1.0" for i in range(15)}
    row = normalize.normalize_book(_book_msgs(spark, {"bid": bids, "ask": {}}), depth=10).first()
    assert row["bid_px"] == [float(100 - i) for i in range(10)]
    assert row["ask_px"] == [0.0] * 10
    assert row["mid_price"] == 0.0 and row["spread_bps"] == 0.0
    assert row["imbalance_top10"] == 1.0


def test_book_delta_payload_fallback(spark):
    row = normalize.normalize_book(_book_msgs(spark, {"bid": {"10": "1"}, "ask": {"11": "2"}}, field="delta"), depth=5).first()
    assert row["best_bid"] == 10.0 and row["best_ask"] == 11.0


def test_funding_falsy_optionals_become_null(spark):
    msgs = spark.createDataFrame(
        [(1.0, 1.0, "EX", "BTC", 0.0, 0.0001, None), (2.0, 2.0, "EX", "BTC", 101.0, 0.0002, 0.0003)],
        f"{MSG_FIELDS}, mark_price double, rate double, predicted_rate double",
    )
    rows = normalize.normalize_funding(msgs).orderBy("timestamp").collect()
    assert rows[0]["mark_price"] is None and rows[0]["predicted_rate"] is None
    assert rows[1]["mark_price"] == 101.0 and rows[1]["predicted_rate"] == 0.0003


def test_liquidation_status_defaults_empty(spark):
    msgs = spark.createDataFrame(
        [(1.0, 1.0, "EX", "BTC", "sell", "10", "2", None, "o-1")],
        f"{MSG_FIELDS}, side string, price string, quantity string, status string, id string",
    )
    row = normalize.normalize_liquidations(msgs).first()
    assert row["status"] == "" and row["order_id"] == "o-1" and row["quantity"] == 2.0


def test_exact_decimal_epoch(spark):
    msgs = spark.createDataFrame([(Decimal("1704067207.179575"),)], "t decimal(20,6)")
    row = msgs.select(F.unix_micros(normalize.epoch_to_ts(F.col("t"))).alias("us")).first()
    assert row["us"] == 1704067207179575
