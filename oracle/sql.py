"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly from the operator definitions, not from the Spark code: the
bars use a per-bar ``lag`` for the trade gap and ``ASOF LEFT JOIN`` for the
previous close, features and labels use plain global windows.  Each builder
returns CTE text; :func:`present_sql` adds the same rounding / typing the Spark
side applies in ``candlewick.functions.present``.
"""

from __future__ import annotations

import math
from datetime import datetime, timezone

from pyspark.sql import types as T

# ----------------------------------------------------------------- presentation


def parse_utc(value: str) -> datetime:
    moment = datetime.fromisoformat(value)
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def fixed_weights(d: float, lags: int) -> list[float]:
    """(-1)^k times the generalised binomial coefficient of d over k."""
    return [(-1) ** k * math.prod(d - j for j in range(k)) / math.factorial(k) for k in range(lags + 1)]


QUANT = 0.7071067811865476
QUANT_SQL = f"CAST('{QUANT!r}' AS DOUBLE)"


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DoubleType):
        return "d"
    if isinstance(dtype, T.TimestampType):
        return "t"
    if isinstance(dtype, T.IntegerType):
        return "i"
    if isinstance(dtype, T.LongType):
        return "l"
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return "a"
    return "s"


def columns_of(schema: T.StructType, names: list[str] | None = None) -> list[tuple[str, str]]:
    fields = {f.name: f for f in schema.fields}
    order = names or [f.name for f in schema.fields]
    return [(n, _kind(fields[n].dataType)) for n in order]


def present_sql(inner: str, columns: list[tuple[str, str]], scaled: tuple[str, ...] = ()) -> str:
    exprs = []
    for name, kind in columns:
        q = f'"{name}"'
        if kind == "d":
            base = f"CAST({q} AS DOUBLE)" + (" * CAST(1000000 AS DOUBLE)" if name in scaled else "")
            exprs.append(f"round({base} * {QUANT_SQL}, 6) / {QUANT_SQL} + CAST(0 AS DOUBLE) AS {q}")
        elif kind == "t":
            exprs.append(f"CAST({q} AS TIMESTAMP) AS {q}")
        elif kind == "i":
            exprs.append(f"CAST({q} AS INTEGER) AS {q}")
        elif kind == "l":
            exprs.append(f"CAST({q} AS BIGINT) AS {q}")
        elif kind == "a":
            exprs.append(q)
        else:
            exprs.append(f"CAST({q} AS VARCHAR) AS {q}")
    return f"SELECT {', '.join(exprs)} FROM (\n{inner}\n) AS q"


class SqlExpr(str):
    """A timestamp given as SQL text (e.g. derived from the data) instead of a literal."""


BOUNDS_CTE = """
bounds AS (
    SELECT date_trunc('day', min(ts)) AS s, date_trunc('day', max(ts)) + INTERVAL 1 DAY AS e FROM events
)"""
DATA_START = SqlExpr("(SELECT s FROM bounds)")
DATA_END = SqlExpr("(SELECT e FROM bounds)")


def shift(value, seconds: int):
    if isinstance(value, SqlExpr):
        return SqlExpr(f"({value} + to_seconds(CAST({int(seconds)} AS BIGINT)))")
    from datetime import timedelta

    return parse_utc(value) + timedelta(seconds=seconds)


def ts_lit(value) -> str:
    if isinstance(value, SqlExpr):
        return str(value)
    dt = parse_utc(value)
    return "TIMESTAMP '" + dt.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3] + "'"


def cond(column: str, start=None, end=None) -> str:
    if start is DATA_START and end is DATA_END:
        # the data range is built to cover every event: the filter is a no-op, and
        # leaving scalar subqueries out of row filters keeps DuckDB's planner fast
        return "TRUE"
    parts = []
    if start:
        parts.append(f"{column} >= {ts_lit(start)}")
    if end:
        parts.append(f"{column} < {ts_lit(end)}")
    return " AND ".join(parts) if parts else "TRUE"


def bucket(column: str, n: int) -> str:
    u = int(n) * 1_000_000
    return f"make_timestamp((epoch_us({column}) // {u}) * {u})"


# ----------------------------------------------------------------- fixtures


def fixtures_ctes(depth: int = 10) -> str:
    """events → trades / book / oi / funding / liquidations (as CTEs)."""
    return f"""
ev AS (
    SELECT event_id, ts, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
    FROM events
),
trades AS (
    SELECT 'SIM' AS exchange, event_type AS symbol, ts AS timestamp, ts AS receipt_ts,
           CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
           value + 1 AS price, k + 1 AS quantity, (value + 1) * (k + 1) AS notional,
           CAST(event_id AS VARCHAR) AS trade_id
    FROM ev
),
book_levels AS (
    SELECT 'SIM' AS exchange, event_type AS symbol, ts AS timestamp,
           list_slice(list_reverse(list_sort(list_transform(range(0, 4 + event_id % 9),
               lambda i : {{'px': value + 1 - CAST(0.01 AS DOUBLE) * (i + 1),
                           'sz': CAST((event_id * (i + 3)) % 17 + 1 AS DOUBLE)}}))), 1, {depth}) AS bids,
           list_slice(list_sort(list_transform(range(0, 4 + event_id % 7),
               lambda i : {{'px': value + 1 + CAST(0.01 AS DOUBLE) * (i + 1),
                           'sz': CAST((event_id * (i + 5)) % 19 + 1 AS DOUBLE)}})), 1, {depth}) AS asks
    FROM ev WHERE event_id % 3 = 0
),
book_arr AS (
    SELECT exchange, symbol, timestamp,
           list_concat(list_transform(bids, lambda x : x.px), list_transform(range({depth} - len(bids)), lambda x : CAST(0 AS DOUBLE))) AS bid_px,
           list_concat(list_transform(bids, lambda x : x.sz), list_transform(range({depth} - len(bids)), lambda x : CAST(0 AS DOUBLE))) AS bid_sz,
           list_concat(list_transform(asks, lambda x : x.px), list_transform(range({depth} - len(asks)), lambda x : CAST(0 AS DOUBLE))) AS ask_px,
           list_concat(list_transform(asks, lambda x : x.sz), list_transform(range({depth} - len(asks)), lambda x : CAST(0 AS DOUBLE))) AS ask_sz
    FROM book_levels
),
book_st AS (
    SELECT *, bid_px[1] AS best_bid, ask_px[1] AS best_ask,
           CASE WHEN bid_px[1] <> 0 AND ask_px[1] <> 0 THEN (bid_px[1] + ask_px[1]) / 2 ELSE CAST(0 AS DOUBLE) END AS mid_price,
           list_sum(list_slice(bid_sz, 1, 5)) AS bid_depth_5, list_sum(list_slice(bid_sz, 1, 10)) AS bid_depth_10,
           list_sum(list_slice(ask_sz, 1, 5)) AS ask_depth_5, list_sum(list_slice(ask_sz, 1, 10)) AS ask_depth_10
    FROM book_arr
),
book AS (
    SELECT exchange, symbol, timestamp, timestamp AS receipt_ts, mid_price, best_bid, best_ask,
           coalesce((best_ask - best_bid) / nullif(mid_price, 0), 0) * 10000 AS spread_bps,
           coalesce((bid_sz[1] * best_ask + ask_sz[1] * best_bid) / nullif(bid_sz[1] + ask_sz[1], 0), 0) AS microprice,
           bid_px, bid_sz, ask_px, ask_sz, bid_depth_5, bid_depth_10, ask_depth_5, ask_depth_10,
           coalesce((bid_sz[1] - ask_sz[1]) / nullif(bid_sz[1] + ask_sz[1], 0), 0) AS imbalance_top1,
           coalesce((bid_depth_5 - ask_depth_5) / nullif(bid_depth_5 + ask_depth_5, 0), 0) AS imbalance_top5,
           coalesce((bid_depth_10 - ask_depth_10) / nullif(bid_depth_10 + ask_depth_10, 0), 0) AS imbalance_top10
    FROM book_st
),
oi AS (
    SELECT 'SIM' AS exchange, event_type AS symbol, ts AS timestamp, ts AS receipt_ts,
           CAST(1000 + user_id AS DOUBLE) AS open_interest
    FROM ev WHERE event_id % 7 = 0
),
funding AS (
    SELECT 'SIM' AS exchange, event_type AS symbol, ts AS timestamp, ts AS receipt_ts,
           CASE WHEN value + 1 <> 0 THEN value + 1 END AS mark_price, (value - 100) / 1000000 AS rate,
           CAST(NULL AS DOUBLE) AS predicted_rate
    FROM ev WHERE event_id % 11 = 0
),
liq AS (
    SELECT ts AS timestamp, ts AS receipt_ts, 'SIM' AS exchange, event_type AS symbol,
           CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
           value + 1 AS price, CAST(event_id % 13 + 1 AS DOUBLE) AS quantity, '' AS status,
           CAST(event_id AS VARCHAR) AS order_id
    FROM ev WHERE event_id % 5 = 0
)"""


def lineitem_trades_cte() -> str:
    return """
trades AS (
    SELECT 'SIM' AS exchange, l_returnflag AS symbol, l_shipdate AS timestamp,
           CASE WHEN (l_orderkey + l_linenumber) % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
           l_extendedprice / l_quantity AS price, l_quantity AS quantity,
           (l_extendedprice / l_quantity) * l_quantity AS notional,
           lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || CAST(l_linenumber AS VARCHAR) AS trade_id
    FROM lineitem
)"""


# ----------------------------------------------------------------- bars


def trade_bars_ctes(n: int, start=None, end=None, p: str = "") -> str:
    return f"""
{p}tr AS (
    SELECT *, {bucket('timestamp', n)} AS bar_time FROM trades WHERE {cond('timestamp', start, end)}
),
{p}tg AS (
    SELECT *, lag(timestamp, 1, timestamp) OVER (PARTITION BY exchange, symbol, bar_time ORDER BY timestamp, trade_id) AS prev_ts
    FROM {p}tr
),
{p}tb AS (
    SELECT exchange, symbol, bar_time,
           arg_min(price, (timestamp, trade_id)) AS open, max(price) AS high, min(price) AS low,
           arg_max(price, (timestamp, trade_id)) AS close,
           sum(quantity) AS volume, sum(notional) AS turnover, count(*) AS trade_count,
           coalesce(sum(quantity) FILTER (WHERE side = 'buy'), 0) AS buy_volume,
           coalesce(sum(quantity) FILTER (WHERE side = 'sell'), 0) AS sell_volume,
           coalesce(sum(notional) FILTER (WHERE side = 'buy'), 0) AS buy_turnover,
           coalesce(sum(notional) FILTER (WHERE side = 'sell'), 0) AS sell_turnover,
           coalesce(sum(sqrt(notional)) FILTER (WHERE side = 'buy'), 0)
             - coalesce(sum(sqrt(notional)) FILTER (WHERE side = 'sell'), 0) AS signed_sqrt_dollar_volume,
           sum(notional) / nullif(sum(quantity), 0) AS vwap,
           CAST(0 AS BIGINT) AS large_trade_count, CAST(0 AS DOUBLE) AS large_trade_volume,
           date_trunc('millisecond', min(timestamp)) AS first_trade_ts,
           date_trunc('millisecond', max(timestamp)) AS last_trade_ts,
           max(epoch_us(timestamp) // 1000 - epoch_us(prev_ts) // 1000) AS max_trade_gap_ms
    FROM {p}tg GROUP BY exchange, symbol, bar_time
)"""


def source_bars_ctes(n: int, start=None, end=None, p: str = "") -> str:
    c = cond("timestamp", start, end)
    b = bucket("timestamp", n)
    return f"""
{p}bb AS (
    SELECT exchange, symbol, {b} AS bar_time, count(*) AS ob_snapshot_count,
           avg(spread_bps) AS avg_spread_bps, avg(mid_price) AS avg_mid_price, avg(microprice) AS avg_microprice,
           avg(bid_sz[1]) AS avg_bid1_size, avg(ask_sz[1]) AS avg_ask1_size,
           avg(bid_depth_5) AS avg_top5_bid_depth, avg(ask_depth_5) AS avg_top5_ask_depth,
           avg(bid_depth_10) AS avg_top10_bid_depth, avg(ask_depth_10) AS avg_top10_ask_depth,
           avg(imbalance_top1) AS avg_imbalance_top1, avg(imbalance_top5) AS avg_imbalance_top5,
           avg(imbalance_top10) AS avg_imbalance_top10
    FROM book WHERE {c} GROUP BY ALL
),
{p}ob AS (
    SELECT exchange, symbol, {b} AS bar_time,
           arg_min(open_interest, timestamp) AS open_interest_open, arg_max(open_interest, timestamp) AS open_interest_close
    FROM oi WHERE {c} GROUP BY ALL
),
{p}fb AS (
    SELECT exchange, symbol, {b} AS bar_time, arg_max(rate, timestamp) AS funding_rate
    FROM funding WHERE {c} GROUP BY ALL
),
{p}lb AS (
    SELECT exchange, symbol, {b} AS bar_time,
           coalesce(sum(quantity) FILTER (WHERE side = 'buy'), 0) AS liq_buy_volume,
           coalesce(sum(quantity) FILTER (WHERE side = 'sell'), 0) AS liq_sell_volume,
           coalesce(sum(price * quantity) FILTER (WHERE side = 'buy'), 0) AS liq_buy_turnover,
           coalesce(sum(price * quantity) FILTER (WHERE side = 'sell'), 0) AS liq_sell_turnover,
           count(*) AS liq_count
    FROM liq WHERE {c} GROUP BY ALL
)"""


BOOK_MEANS = [
    "avg_spread_bps", "avg_mid_price", "avg_microprice", "avg_bid1_size", "avg_ask1_size",
    "avg_top5_bid_depth", "avg_top5_ask_depth", "avg_top10_bid_depth", "avg_top10_ask_depth",
    "avg_imbalance_top1", "avg_imbalance_top5", "avg_imbalance_top10",
]


def bars_ctes(n: int, start=None, end=None, p: str = "", out: str = "bars") -> str:
    """Full bar table for interval ``n`` as CTE ``out`` (grid when both bounds given)."""
    parts = [trade_bars_ctes(n, start, end, p), source_bars_ctes(n, start, end, p)]
    grid = bool(start and end)
    if grid:
        parts.append(f"""
{p}syms AS (SELECT DISTINCT exchange, symbol FROM trades WHERE {cond('timestamp', start, end)}),
{p}grid AS (
    SELECT exchange, symbol, bar_time FROM {p}syms,
        (SELECT unnest(generate_series({ts_lit(start)}, {ts_lit(end)} - to_seconds(CAST({n} AS BIGINT)), to_seconds(CAST({n} AS BIGINT)))) AS bar_time) AS g
    WHERE bar_time < {ts_lit(end)}
),
{p}gp AS (
    SELECT g.exchange, g.symbol, g.bar_time, t.close AS prev_close
    FROM {p}grid g ASOF LEFT JOIN {p}tb t
      ON g.exchange = t.exchange AND g.symbol = t.symbol AND t.bar_time <= g.bar_time
)""")
        src = f"""FROM {p}gp g LEFT JOIN {p}tb t ON g.exchange = t.exchange AND g.symbol = t.symbol AND g.bar_time = t.bar_time"""
        keys = "g.exchange, g.symbol, g.bar_time"
        ohlc = ", ".join(f"coalesce(t.{c}, g.prev_close) AS {c}" for c in ("open", "high", "low", "close"))
        vwap = "coalesce(t.vwap, t.close, g.prev_close) AS vwap"
        complete = "CASE WHEN coalesce(t.trade_count, 0) > 0 OR g.prev_close IS NOT NULL THEN 1 ELSE 0 END AS is_time_bar_complete"
        fts = "coalesce(t.first_trade_ts, g.bar_time) AS first_trade_ts, coalesce(t.last_trade_ts, g.bar_time) AS last_trade_ts"
        where = "WHERE coalesce(t.trade_count, 0) > 0 OR g.prev_close IS NOT NULL"
        lhs = "g"
    else:
        src = f"FROM {p}tb t"
        keys = "t.exchange, t.symbol, t.bar_time"
        ohlc = "t.open, t.high, t.low, t.close"
        vwap = "coalesce(t.vwap, 0) AS vwap"
        complete = "1 AS is_time_bar_complete"
        fts = "t.first_trade_ts, t.last_trade_ts"
        where = ""
        lhs = "t"
    joins = "\n".join(
        f"LEFT JOIN {p}{a} {a} ON {lhs}.exchange = {a}.exchange AND {lhs}.symbol = {a}.symbol AND {lhs}.bar_time = {a}.bar_time"
        for a in ("bb", "ob", "fb", "lb")
    )
    z = "CAST(0 AS DOUBLE)"
    means = ", ".join(f"coalesce(bb.{c}, {z}) AS {c}" for c in BOOK_MEANS)
    parts.append(f"""
{out} AS (
    SELECT {keys}, {n} AS bar_interval_sec, {ohlc},
           coalesce(t.volume, {z}) AS volume, coalesce(t.turnover, {z}) AS turnover,
           coalesce(t.trade_count, 0) AS trade_count,
           coalesce(t.buy_volume, {z}) AS buy_volume, coalesce(t.sell_volume, {z}) AS sell_volume,
           coalesce(t.buy_turnover, {z}) AS buy_turnover, coalesce(t.sell_turnover, {z}) AS sell_turnover,
           coalesce(t.signed_sqrt_dollar_volume, {z}) AS signed_sqrt_dollar_volume,
           {vwap},
           coalesce(t.large_trade_count, 0) AS large_trade_count, coalesce(t.large_trade_volume, {z}) AS large_trade_volume,
           coalesce(bb.ob_snapshot_count, 0) AS ob_snapshot_count,
           {complete},
           CASE WHEN coalesce(bb.ob_snapshot_count, 0) > 0 THEN 1 ELSE 0 END AS has_book_data,
           CASE WHEN ob.bar_time IS NULL THEN 0 ELSE 1 END AS has_open_interest_data,
           CASE WHEN fb.bar_time IS NULL THEN 0 ELSE 1 END AS has_funding_data,
           {means},
           coalesce(ob.open_interest_open, {z}) AS open_interest_open,
           coalesce(ob.open_interest_close, {z}) AS open_interest_close,
           fb.funding_rate AS funding_rate,
           coalesce(lb.liq_buy_volume, {z}) AS liq_buy_volume, coalesce(lb.liq_sell_volume, {z}) AS liq_sell_volume,
           coalesce(lb.liq_buy_turnover, {z}) AS liq_buy_turnover, coalesce(lb.liq_sell_turnover, {z}) AS liq_sell_turnover,
           coalesce(lb.liq_count, 0) AS liq_count,
           {fts},
           coalesce(t.max_trade_gap_ms, 0) AS max_trade_gap_ms
    {src}
    {joins}
    {where}
)""")
    return ",".join(parts)


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)


def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def bucket_expr(column: str, n: int) -> str:
    return bucket(column, n)


# ----------------------------------------------------------------- rollup

SUMS = [
    "volume", "turnover", "trade_count", "buy_volume", "sell_volume", "buy_turnover", "sell_turnover",
    "signed_sqrt_dollar_volume", "large_trade_count", "large_trade_volume", "ob_snapshot_count",
    "liq_buy_volume", "liq_sell_volume", "liq_buy_turnover", "liq_sell_turnover", "liq_count",
]


def rollup_cte(n: int, src: str = "bars", out: str = "roll", start=None, end=None) -> str:
    m = n // 60
    sums = ", ".join(f"sum({c}) AS {c}" for c in SUMS)
    means = ", ".join(
        f"coalesce(sum({c} * ob_snapshot_count) / nullif(sum(ob_snapshot_count), 0), CAST(0 AS DOUBLE)) AS {c}" for c in BOOK_MEANS
    )
    return f"""
{out} AS (
    SELECT exchange, symbol, {n} AS bar_interval_sec, rb AS bar_time,
           arg_min(open, bar_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, bar_time) AS close,
           {sums},
           coalesce(sum(turnover) / nullif(sum(volume), 0), CAST(0 AS DOUBLE)) AS vwap,
           CASE WHEN count(*) = {m} AND min(is_time_bar_complete) = 1 THEN 1 ELSE 0 END AS is_time_bar_complete,
           max(has_book_data) AS has_book_data, max(has_open_interest_data) AS has_open_interest_data,
           max(has_funding_data) AS has_funding_data,
           {means},
           arg_min(open_interest_open, bar_time) AS open_interest_open,
           arg_max(open_interest_close, bar_time) AS open_interest_close,
           arg_max(funding_rate, bar_time) FILTER (WHERE funding_rate IS NOT NULL) AS funding_rate,
           min(first_trade_ts) AS first_trade_ts, max(last_trade_ts) AS last_trade_ts,
           max(max_trade_gap_ms) AS max_trade_gap_ms
    FROM (SELECT *, {bucket('bar_time', n)} AS rb FROM {src}
          WHERE bar_interval_sec = 60 AND {cond('bar_time', start, end)})
    GROUP BY exchange, symbol, rb
)"""


# ----------------------------------------------------------------- features

W = "PARTITION BY exchange, symbol, bar_interval_sec ORDER BY bar_time"


def _past(n: int) -> str:
    return f"({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def _ahead(n: int) -> str:
    return f"({W} ROWS BETWEEN 1 FOLLOWING AND {n} FOLLOWING)"


def _rnull(n_expr: str, need: int, value: str) -> str:
    return f"CASE WHEN {n_expr} < {need} THEN CAST(NULL AS DOUBLE) ELSE coalesce({value}, CAST(0 AS DOUBLE)) END"


def _r0(num: str, den: str) -> str:
    return f"coalesce(({num}) / nullif({den}, 0), CAST(0 AS DOUBLE))"


def features_ctes(n: int, src: str = "bars", out: str = "feat", start=None, end=None, p: str = "f") -> str:
    lo = shift(start, -61 * n) if start else None
    w4 = [round(x, 10) for x in fixed_weights(0.4, 5)]
    w6 = [round(x, 10) for x in fixed_weights(0.6, 5)]

    def frac(ws):
        terms = [f"({dbl(ws[0])} * close)"] + [f"({dbl(ws[k])} * cl{k})" for k in range(1, 6)]
        return " + ".join(terms)

    lags = ", ".join(f"coalesce(lag(close, {k}) OVER ({W}), CAST(0 AS DOUBLE)) AS cl{k}" for k in range(1, 6))

    def sd(c, k):
        return _rnull(f"count({c}) OVER {_past(k)}", 2, f"stddev_samp({c}) OVER {_past(k)}")

    def z(c, k):
        return _rnull(
            f"count({c}) OVER {_past(k)}", 2,
            f"({c} - avg({c}) OVER {_past(k)}) / nullif(stddev_samp({c}) OVER {_past(k)}, 0)",
        )

    def vp(k):
        return _rnull(f"count(volume) OVER {_past(k)}", 1, f"sum(abs(delta_volume)) OVER {_past(k)} / nullif(sum(volume) OVER {_past(k)}, 0)")

    def ac(k):
        return (
            f"CASE WHEN count(ax) OVER {_past(k)} >= 2 AND stddev_samp(ax) OVER {_past(k)} > max(abs(ax)) OVER {_past(k)} * {dbl(1e-13)} "
            f"AND stddev_samp(ay) OVER {_past(k)} > max(abs(ay)) OVER {_past(k)} * {dbl(1e-13)} "
            f"THEN covar_samp(ax, ay) OVER {_past(k)} / (stddev_samp(ax) OVER {_past(k)} * stddev_samp(ay) OVER {_past(k)}) END"
        )

    return f"""
{p}1 AS (
    SELECT *, lag(close) OVER ({W}) AS prev_close, lag(open_interest_close) OVER ({W}) AS prev_oi_close,
           coalesce(lag(has_open_interest_data) OVER ({W}), 0) AS prev_has_oi, {lags}
    FROM {src} WHERE bar_interval_sec = {n} AND {cond('bar_time', lo, end)}
),
{p}2 AS (
    SELECT *,
        CASE WHEN prev_close IS NOT NULL THEN coalesce(ln(CASE WHEN close / nullif(prev_close, 0) > 0 THEN close / nullif(prev_close, 0) END), CAST(0 AS DOUBLE)) END AS log_return,
        {_r0('close - open', 'open')} AS co_return,
        {_r0('high - low', 'close')} AS hl_range,
        CASE WHEN high = low THEN {dbl(0.5)} ELSE (close - low) / (high - low) END AS close_position,
        CASE WHEN prev_close IS NOT NULL THEN {_r0('open - prev_close', 'prev_close')} END AS gap_return,
        {_r0('buy_volume', 'volume')} AS buy_ratio,
        buy_volume - sell_volume AS delta_volume,
        {_r0('volume', 'trade_count')} AS avg_trade_size,
        CAST(NULL AS DOUBLE) AS large_trade_pct,
        {_r0('close - vwap', 'vwap')} AS close_vwap_bias,
        avg_spread_bps AS spread_bps, avg_imbalance_top1 AS imbalance_top1, avg_imbalance_top5 AS imbalance_top5,
        {_r0('avg_top5_bid_depth', 'avg_top5_ask_depth')} AS depth_ratio_5,
        {_r0('avg_microprice - avg_mid_price', 'avg_mid_price')} AS microprice_bias,
        CAST(ob_snapshot_count AS DOUBLE) AS ob_quality,
        CASE WHEN has_open_interest_data = 1 AND prev_has_oi = 1 THEN open_interest_close - prev_oi_close ELSE CAST(0 AS DOUBLE) END AS oi_change,
        CASE WHEN has_open_interest_data = 1 AND prev_has_oi = 1 THEN {_r0('open_interest_close - prev_oi_close', 'prev_oi_close')} ELSE CAST(0 AS DOUBLE) END AS oi_change_pct,
        {_r0('liq_buy_volume - liq_sell_volume', 'liq_buy_volume + liq_sell_volume')} AS liq_imbalance,
        {_r0('liq_count', 'trade_count')} AS liq_intensity,
        {_r0('liq_buy_volume + liq_sell_volume', 'volume')} AS liq_volume_pct,
        CAST(hour(bar_time) AS INTEGER) AS hour_of_day,
        CAST(isodow(bar_time) AS INTEGER) AS day_of_week,
        {frac(w4)} AS frac_diff_0_4,
        {frac(w6)} AS frac_diff_0_6
    FROM {p}1
),
{p}3 AS (
    SELECT *, lag(log_return) OVER ({W}) AS prev_lr FROM {p}2
),
{p}4 AS (
    SELECT *,
        CASE WHEN log_return IS NOT NULL THEN log_return * signed_sqrt_dollar_volume END AS kx,
        CASE WHEN log_return IS NOT NULL THEN signed_sqrt_dollar_volume * signed_sqrt_dollar_volume END AS kxx,
        CASE WHEN log_return IS NOT NULL AND prev_lr IS NOT NULL THEN log_return END AS ax,
        CASE WHEN log_return IS NOT NULL AND prev_lr IS NOT NULL THEN prev_lr END AS ay
    FROM {p}3
),
{p}5 AS (
    SELECT *,
        {sd('log_return', 5)} AS realized_vol_5,
        {sd('log_return', 20)} AS realized_vol_20,
        {sd('log_return', 60)} AS realized_vol_60,
        {z('volume', 20)} AS volume_zscore_20,
        {_rnull(f"count(volume) OVER {_past(5)}", 1, f"avg(volume) OVER {_past(5)} / nullif(avg(volume) OVER {_past(20)}, 0)")} AS volume_ratio_5_20,
        {_rnull(f"count(log_return) OVER {_past(20)}", 1, f"sum(kx) OVER {_past(20)} / nullif(sum(kxx) OVER {_past(20)}, 0)")} AS kyle_lambda_approx,
        {vp(5)} AS vpin_5, {vp(10)} AS vpin_10, {vp(20)} AS vpin_20,
        {z('oi_change', 20)} AS oi_zscore_20,
        {ac(5)} AS autocorrelation_5,
        {ac(20)} AS autocorrelation_20
    FROM {p}4
),
{out} AS (
    SELECT *,
        CASE WHEN realized_vol_5 IS NOT NULL AND realized_vol_20 IS NOT NULL THEN {_r0('realized_vol_5', 'realized_vol_20')} END AS vol_ratio_5_20,
        CASE WHEN log_return IS NOT NULL THEN {_r0('abs(log_return)', 'turnover')} END AS amihud_illiquidity,
        log_return - prev_lr AS price_acceleration
    FROM {p}5 WHERE {cond('bar_time', start, end)}
)"""


# ----------------------------------------------------------------- labels


def labels_ctes(n: int, src: str = "bars", out: str = "lab", start=None, end=None, lookback: int = 60, p: str = "l") -> str:
    lo = shift(start, -lookback * n) if start else None
    hi = shift(end, 60 * n) if end else None
    leads = ", ".join(f"lead(close, {h}) OVER ({W}) AS c{h}" for h in (1, 5, 10, 20, 60))
    rets = ", ".join(f"c{h} / nullif(close, 0) - 1 AS fwd_return_{h}" for h in (1, 5, 10, 20, 60))

    def sgn(c, thr="CAST(0 AS DOUBLE)"):
        return f"CASE WHEN {c} > {thr} THEN 1 WHEN {c} < -{thr} THEN -1 ELSE 0 END"

    def exc(d, pos, neg):
        return f"CASE WHEN {d} > 0 THEN {pos} WHEN {d} < 0 THEN {neg} ELSE CAST(0 AS DOUBLE) END"

    return f"""
{p}1 AS (
    SELECT *, {leads},
        count(*) OVER {_ahead(60)} AS fwd_n,
        max(high) OVER {_ahead(5)} AS h5, min(low) OVER {_ahead(5)} AS l5,
        max(high) OVER {_ahead(10)} AS h10, min(low) OVER {_ahead(10)} AS l10,
        list(high) OVER {_ahead(20)} AS hs, list(low) OVER {_ahead(20)} AS ls
    FROM {src} WHERE bar_interval_sec = {n} AND {cond('bar_time', lo, hi)}
),
{p}2 AS (
    SELECT *, c1 / nullif(close, 0) - 1 AS nbr, {rets} FROM {p}1
),
{p}3 AS (
    SELECT *,
        CASE WHEN count(nbr) OVER {_past(60)} >= 2 THEN stddev_samp(nbr) OVER {_past(60)} END AS hist_vol,
        CASE WHEN count(nbr) OVER ({W} ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) >= 2
             THEN stddev_samp(nbr) OVER ({W} ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) END AS fwd_realized_vol_5
    FROM {p}2
),
{p}4 AS (
    SELECT *,
        {sgn('fwd_return_5')} AS fwd_direction_5,
        {sgn('fwd_return_10')} AS fwd_direction_10,
        coalesce(hist_vol * {dbl(0.5)}, CAST(0 AS DOUBLE)) AS label_threshold_5,
        coalesce(hist_vol * {dbl(0.7)}, CAST(0 AS DOUBLE)) AS label_threshold_10,
        greatest(coalesce(h5 / nullif(close, 0) - 1, CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)) AS fwd_max_up_5,
        greatest(coalesce(1 - l5 / nullif(close, 0), CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)) AS fwd_max_down_5,
        greatest(coalesce(h10 / nullif(close, 0) - 1, CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)) AS up10,
        greatest(coalesce(1 - l10 / nullif(close, 0), CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)) AS down10,
        {_r0('h5 - l5', 'close')} AS fwd_range_5
    FROM {p}3
),
{p}5 AS (
    SELECT *,
        coalesce(list_position(list_transform(hs, lambda h : h >= close * (1 + label_threshold_10)), true), 0) AS up_hit,
        coalesce(list_position(list_transform(ls, lambda x : x <= close * (1 - label_threshold_10)), true), 0) AS down_hit
    FROM {p}4
),
{out} AS (
    SELECT *,
        {sgn('fwd_return_5', 'label_threshold_5')} AS fwd_label_3class_5,
        {sgn('fwd_return_10', 'label_threshold_10')} AS fwd_label_3class_10,
        {exc('fwd_direction_5', 'fwd_max_down_5', 'fwd_max_up_5')} AS mae_5,
        {exc('fwd_direction_10', 'down10', 'up10')} AS mae_10,
        {exc('fwd_direction_5', 'fwd_max_up_5', 'fwd_max_down_5')} AS mfe_5,
        {exc('fwd_direction_10', 'up10', 'down10')} AS mfe_10,
        CASE WHEN up_hit > 0 AND (down_hit = 0 OR up_hit <= down_hit) THEN 1
             WHEN down_hit > 0 AND (up_hit = 0 OR down_hit < up_hit) THEN -1 ELSE 0 END AS triple_barrier_signal,
        CASE WHEN fwd_n = 60 AND c60 IS NOT NULL THEN 1 ELSE 0 END AS is_valid
    FROM {p}5 WHERE {cond('bar_time', start, end)}
)"""
