"""Registered queries: one per operator of the inventory, each with its oracle.

Every query reads the driver's tables (``events``, ``lineitem``) and runs the
library operators over the whole data; time ranges come from the data itself
(whole days covering all events) or, for the range operators, from offsets of
that range.  ``SPARK`` maps a name to ``(spark, sf_dir) -> DataFrame``;
``ORACLE`` maps the same name to DuckDB SQL (absent = rows-only check).
Results go through ``present`` (Spark) / ``present_sql`` (DuckDB) so doubles
and timestamps compare exactly.
"""

from __future__ import annotations

from datetime import timedelta
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.functions.exprs import parse_utc
from candlewick.functions.present import present
from candlewick.operators import bars as B
from candlewick.operators import dataset as DS
from candlewick.operators.dedupe import latest_version
from candlewick.operators.features import time_bar_features
from candlewick.operators.labels import time_bar_labels
from candlewick.operators.rollup import rollup_bars
from candlewick.plans import incremental as INC
from candlewick.plans import ledger as LED
from candlewick.plans import quality as QC
from candlewick.plans import sinks as SNK
from candlewick.session import configure, shared_path
from candlewick.sources import fixtures
from candlewick.streaming import bars as STR
from oracle import sql as O

SCALED = ("kyle_lambda_approx", "amihud_illiquidity", "funding_rate")

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        SPARK[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


# ----------------------------------------------------------------- shared context


class Ctx:
    def __init__(self, spark: SparkSession, sf_dir: str):
        configure(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self.events = fixtures.read_table(spark, sf_dir, "events")
        self.raw = fixtures.raw_frames(self.events)
        self.start, self.end = fixtures.data_range(self.events)

    def offset(self, days: int) -> str:
        return (parse_utc(self.start) + timedelta(days=days)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def end_minus(self, days: int) -> str:
        return (parse_utc(self.end) - timedelta(days=days)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def grid(self, n: int = 60) -> DataFrame:
        return B.time_bars(self.raw, n, self.start, self.end)

    def store(self, tag: str) -> SNK.Store:
        return SNK.Store(shared_path(self.spark, "candlewick_store", tag, unique=True))


def _out(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return present(df.select(*cols) if cols else df, scaled=SCALED)


# oracle building blocks
S, E = O.DATA_START, O.DATA_END
FIX = O.fixtures_ctes()
BOUNDS = O.BOUNDS_CTE


def _sql(*ctes: str, select: str, columns, scaled=SCALED) -> str:
    return O.present_sql(O.with_(BOUNDS, FIX, *ctes) + "\n" + select, columns, scaled)


def _cols(schema, names=None):
    return O.columns_of(schema, names)


def _grid_ctes(n: int = 60, p: str = "", out: str = "bars") -> str:
    return O.bars_ctes(n, S, E, p=p, out=out)


# ----------------------------------------------------------------- sources (SRC)


@register("raw_trades", _sql(select="SELECT * FROM trades", columns=_cols(schemas.RAW_TRADES)))
def q_raw_trades(spark, sf):
    return _out(Ctx(spark, sf).raw["trades"])


@register("raw_book_topk", _sql(select="SELECT * FROM book", columns=_cols(schemas.RAW_BOOK_TOPK)))
def q_raw_book(spark, sf):
    return _out(Ctx(spark, sf).raw["book"])


@register("raw_liquidations", _sql(select="SELECT * FROM liq", columns=_cols(schemas.RAW_LIQUIDATIONS)))
def q_raw_liq(spark, sf):
    return _out(Ctx(spark, sf).raw["liquidations"])


@register("raw_funding", _sql(select="SELECT * FROM funding", columns=_cols(schemas.RAW_FUNDING)))
def q_raw_funding(spark, sf):
    return _out(Ctx(spark, sf).raw["funding"])


@register("raw_open_interest", _sql(select="SELECT * FROM oi", columns=_cols(schemas.RAW_OPEN_INTEREST)))
def q_raw_oi(spark, sf):
    return _out(Ctx(spark, sf).raw["open_interest"])


_R7 = (O.shift(S, 7 * 86400), O.shift(S, 14 * 86400))


@register(
    "scan_time_range",
    _sql(select=f"SELECT * FROM trades WHERE {O.cond('timestamp', *_R7)}", columns=_cols(schemas.RAW_TRADES)),
)
def q_scan_time_range(spark, sf):
    c = Ctx(spark, sf)
    from candlewick.functions.exprs import time_range

    return _out(c.raw["trades"].filter(time_range("timestamp", c.offset(7), c.offset(14))))


@register(
    "scan_symbol_filter",
    _sql(
        O.bars_ctes(3600, p="h"),
        select="SELECT * FROM bars WHERE exchange = 'SIM' AND symbol = 'view' AND bar_interval_sec = 3600",
        columns=_cols(schemas.BARS),
    ),
)
def q_scan_symbol(spark, sf):
    c = Ctx(spark, sf)
    b = B.time_bars(c.raw, 3600)
    return _out(b.filter((F.col("exchange") == "SIM") & (F.col("symbol") == "view") & (F.col("bar_interval_sec") == 3600)))


# ----------------------------------------------------------------- dedupe (DED-1)

_DED_COLS = _cols(schemas.BARS) + [("_version", "l"), ("_run_id", "s")]


@register(
    "latest_version",
    _sql(
        O.bars_ctes(3600, p="a", out="v1"),
        "buys AS (SELECT * FROM trades WHERE side = 'buy')",
        O.bars_ctes(3600, p="b", out="v2").replace("FROM trades", "FROM buys"),
        select="""SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY exchange, symbol, bar_interval_sec, bar_time ORDER BY _version DESC) AS rn
            FROM (SELECT *, CAST(1 AS BIGINT) AS _version, 'v1' AS _run_id FROM v1
                  UNION ALL SELECT *, CAST(2 AS BIGINT) AS _version, 'v2' AS _run_id FROM v2)) WHERE rn = 1""",
        columns=_DED_COLS,
    ),
)
def q_latest_version(spark, sf):
    c = Ctx(spark, sf)
    v1 = B.time_bars(c.raw, 3600).withColumn("_version", F.lit(1).cast("long")).withColumn("_run_id", F.lit("v1"))
    buys = dict(c.raw, trades=c.raw["trades"].filter(F.col("side") == "buy"))
    v2 = B.time_bars(buys, 3600).withColumn("_version", F.lit(2).cast("long")).withColumn("_run_id", F.lit("v2"))
    return _out(latest_version(v1.unionByName(v2), schemas.KEY_COLUMNS))


# ----------------------------------------------------------------- bars (BAR)


@register(
    "time_bucket",
    _sql(
        select=f"SELECT exchange, symbol, timestamp, trade_id, {O.bucket('timestamp', 300)} AS bar_time FROM trades",
        columns=[("exchange", "s"), ("symbol", "s"), ("timestamp", "t"), ("trade_id", "s"), ("bar_time", "t")],
    ),
)
def q_time_bucket(spark, sf):
    from candlewick.functions.exprs import bucket_start

    t = Ctx(spark, sf).raw["trades"]
    return _out(t.select("exchange", "symbol", "timestamp", "trade_id", bucket_start(F.col("timestamp"), 300).alias("bar_time")))


@register(
    "trade_gaps",
    _sql(
        O.trade_bars_ctes(60).split(",\ntb AS")[0].strip("\n"),
        select="""SELECT exchange, symbol, bar_time, trade_id, timestamp, prev_ts AS prev_trade_ts,
                  epoch_us(timestamp) // 1000 - epoch_us(prev_ts) // 1000 AS gap_ms FROM tg""",
        columns=[("exchange", "s"), ("symbol", "s"), ("bar_time", "t"), ("trade_id", "s"), ("timestamp", "t"), ("prev_trade_ts", "t"), ("gap_ms", "l")],
    ),
)
def q_trade_gaps(spark, sf):
    return _out(B.trade_gaps(Ctx(spark, sf).raw["trades"], 60))


_TB_COLS = [
    ("exchange", "s"), ("symbol", "s"), ("bar_time", "t"), ("open", "d"), ("high", "d"), ("low", "d"), ("close", "d"),
    ("volume", "d"), ("turnover", "d"), ("trade_count", "l"), ("buy_volume", "d"), ("sell_volume", "d"),
    ("buy_turnover", "d"), ("sell_turnover", "d"), ("signed_sqrt_dollar_volume", "d"), ("vwap", "d"),
    ("large_trade_count", "l"), ("large_trade_volume", "d"), ("first_trade_ts", "t"), ("last_trade_ts", "t"),
    ("max_trade_gap_ms", "l"),
]


@register("trade_bars", _sql(O.trade_bars_ctes(60), select="SELECT * FROM tb", columns=_TB_COLS))
def q_trade_bars(spark, sf):
    return _out(B.trade_bars(Ctx(spark, sf).raw["trades"], 60))


@register(
    "trade_bars_lineitem_86400",
    O.present_sql(O.with_(O.lineitem_trades_cte(), O.trade_bars_ctes(86400)) + "\nSELECT * FROM tb", _TB_COLS, SCALED),
)
def q_trade_bars_lineitem(spark, sf):
    configure(spark)
    li = fixtures.read_table(spark, sf, "lineitem")
    return _out(B.trade_bars(fixtures.lineitem_trades(li), 86400))


_BB = ["ob_snapshot_count"] + schemas.BOOK_MEAN_COLUMNS


@register(
    "book_bars",
    _sql(O.source_bars_ctes(60), select="SELECT * FROM bb",
         columns=[("exchange", "s"), ("symbol", "s"), ("bar_time", "t"), ("ob_snapshot_count", "l")] + [(c, "d") for c in schemas.BOOK_MEAN_COLUMNS]),
)
def q_book_bars(spark, sf):
    return _out(B.book_bars(Ctx(spark, sf).raw["book"], 60))


@register(
    "oi_bars",
    _sql(O.source_bars_ctes(60), select="SELECT * FROM ob",
         columns=[("exchange", "s"), ("symbol", "s"), ("bar_time", "t"), ("open_interest_open", "d"), ("open_interest_close", "d")]),
)
def q_oi_bars(spark, sf):
    return _out(B.oi_bars(Ctx(spark, sf).raw["open_interest"], 60))


@register(
    "funding_bars",
    _sql(O.source_bars_ctes(60), select="SELECT * FROM fb", columns=[("exchange", "s"), ("symbol", "s"), ("bar_time", "t"), ("funding_rate", "d")]),
)
def q_funding_bars(spark, sf):
    return _out(B.funding_bars(Ctx(spark, sf).raw["funding"], 60))


@register(
    "liquidation_bars",
    _sql(
        O.source_bars_ctes(60), select="SELECT * FROM lb",
        columns=[("exchange", "s"), ("symbol", "s"), ("bar_time", "t"), ("liq_buy_volume", "d"), ("liq_sell_volume", "d"),
                 ("liq_buy_turnover", "d"), ("liq_sell_turnover", "d"), ("liq_count", "l")],
    ),
)
def q_liq_bars(spark, sf):
    return _out(B.liquidation_bars(Ctx(spark, sf).raw["liquidations"], 60))


@register(
    "time_grid",
    _sql(O.bars_ctes(3600, S, E), select="SELECT exchange, symbol, bar_time FROM grid",
         columns=[("exchange", "s"), ("symbol", "s"), ("bar_time", "t")]),
)
def q_time_grid(spark, sf):
    c = Ctx(spark, sf)
    from candlewick.functions.exprs import time_range

    syms = c.raw["trades"].filter(time_range("timestamp", c.start, c.end)).select("exchange", "symbol").distinct()
    return _out(B.time_grid(syms, c.start, c.end, 3600).drop("_chunk"))


@register(
    "asof_prev_close",
    _sql(O.bars_ctes(3600, S, E), select="SELECT exchange, symbol, bar_time, prev_close FROM gp",
         columns=[("exchange", "s"), ("symbol", "s"), ("bar_time", "t"), ("prev_close", "d")]),
)
def q_asof(spark, sf):
    c = Ctx(spark, sf)
    from candlewick.functions.exprs import time_range

    syms = c.raw["trades"].filter(time_range("timestamp", c.start, c.end)).select("exchange", "symbol").distinct()
    grid = B.time_grid(syms, c.start, c.end, 3600)
    tb = B.trade_bars(c.raw["trades"], 3600, c.start, c.end).select("exchange", "symbol", "bar_time", "close")
    filled = B.forward_fill(grid.join(tb, B.KEYS3, "left"), "close", "prev_close", ["exchange", "symbol"], "_chunk", "bar_time")
    return _out(filled.select("exchange", "symbol", "bar_time", "prev_close"))


@register("bars_1m_grid", _sql(_grid_ctes(60), select="SELECT * FROM bars", columns=_cols(schemas.BARS)))
def q_bars_grid(spark, sf):
    return _out(Ctx(spark, sf).grid(60))


@register("bars_1m_sparse", _sql(O.bars_ctes(60), select="SELECT * FROM bars", columns=_cols(schemas.BARS)))
def q_bars_sparse(spark, sf):
    return _out(B.time_bars(Ctx(spark, sf).raw, 60))


# ----------------------------------------------------------------- rollup (ROL)


def _rollup_sql(n: int) -> str:
    return _sql(_grid_ctes(60), O.rollup_cte(n), select="SELECT * FROM roll", columns=_cols(schemas.BARS))


@register("rollup_bars", _rollup_sql(3600))
def q_rollup(spark, sf):
    return _out(rollup_bars(Ctx(spark, sf).grid(60), 3600))


@register("rollup_bars_86400", _rollup_sql(86400))
def q_rollup_day(spark, sf):
    return _out(rollup_bars(Ctx(spark, sf).grid(60), 86400))


# ----------------------------------------------------------------- features (FEA)

FEATURE_SETS = {
    "features_basic": [
        "log_return", "co_return", "hl_range", "close_position", "gap_return", "buy_ratio", "delta_volume",
        "avg_trade_size", "large_trade_pct", "close_vwap_bias", "spread_bps", "imbalance_top1", "imbalance_top5",
        "depth_ratio_5", "microprice_bias", "ob_quality", "oi_change", "oi_change_pct", "funding_rate",
        "liq_imbalance", "liq_intensity", "liq_volume_pct", "hour_of_day", "day_of_week", "price_acceleration",
    ],
    "features_rolling": [
        "realized_vol_5", "realized_vol_20", "realized_vol_60", "vol_ratio_5_20", "volume_zscore_20",
        "volume_ratio_5_20", "kyle_lambda_approx", "oi_zscore_20", "amihud_illiquidity",
    ],
    "features_autocorr": ["autocorrelation_5", "autocorrelation_20"],
    "features_fracdiff": ["frac_diff_0_4", "frac_diff_0_6"],
    "features_vpin": ["vpin_5", "vpin_10", "vpin_20"],
}
_K = list(schemas.KEY_COLUMNS)
# feature subsets run on 15-minute grid bars over the whole range
SUBSET_INTERVAL = 900


def _feature_sql(n: int, names, start=None, end=None) -> str:
    return _sql(
        _grid_ctes(n), O.features_ctes(n, start=start, end=end),
        select=f"SELECT {', '.join(_K + names)} FROM feat", columns=_cols(schemas.FEATURES, _K + names),
    )


def _feature_query(names, n=SUBSET_INTERVAL):
    def q(spark, sf):
        c = Ctx(spark, sf)
        return _out(time_bar_features(c.grid(n), n), _K + names)

    return q


for _name, _names in FEATURE_SETS.items():
    register(_name, _feature_sql(SUBSET_INTERVAL, _names))(_feature_query(_names))

register("features_all", _feature_sql(60, schemas.FEATURE_NAMES))(_feature_query(schemas.FEATURE_NAMES, 60))

_FR = (O.shift(S, 10 * 86400), O.shift(S, 20 * 86400))


@register("features_incremental", _feature_sql(60, schemas.FEATURE_NAMES, *_FR))
def q_features_incremental(spark, sf):
    c = Ctx(spark, sf)
    return _out(time_bar_features(c.grid(60), 60, c.offset(10), c.offset(20)), _K + schemas.FEATURE_NAMES)


# ----------------------------------------------------------------- labels (LAB)

LABEL_SETS = {
    "labels_forward_returns": ["fwd_return_1", "fwd_return_5", "fwd_return_10", "fwd_return_20", "fwd_return_60", "is_valid"],
    "labels_classes": ["fwd_direction_5", "fwd_direction_10", "fwd_label_3class_5", "fwd_label_3class_10", "label_threshold_5", "label_threshold_10"],
    "labels_excursions": ["fwd_max_up_5", "fwd_max_down_5", "fwd_realized_vol_5", "fwd_range_5", "mae_5", "mae_10", "mfe_5", "mfe_10"],
    "triple_barrier": ["triple_barrier_signal", "label_threshold_10"],
}


def _label_sql(n: int, names, start=None, end=None) -> str:
    return _sql(
        _grid_ctes(n), O.labels_ctes(n, start=start, end=end),
        select=f"SELECT {', '.join(_K + names)} FROM lab", columns=_cols(schemas.LABELS, _K + names),
    )


def _label_query(names, n=SUBSET_INTERVAL):
    def q(spark, sf):
        c = Ctx(spark, sf)
        return _out(time_bar_labels(c.grid(n), n), _K + names)

    return q


for _name, _names in LABEL_SETS.items():
    register(_name, _label_sql(SUBSET_INTERVAL, _names))(_label_query(_names))

register("labels_all", _label_sql(60, schemas.LABEL_NAMES))(_label_query(schemas.LABEL_NAMES, 60))


@register("labels_incremental", _label_sql(60, schemas.LABEL_NAMES, *_FR))
def q_labels_incremental(spark, sf):
    c = Ctx(spark, sf)
    return _out(time_bar_labels(c.grid(60), 60, c.offset(10), c.offset(20)), _K + schemas.LABEL_NAMES)


# ----------------------------------------------------------------- dataset (DAT)

_FINITE = ("realized_vol_20", "realized_vol_60", "volume_zscore_20", "oi_zscore_20")


def _dataset_cte(feat: str = "feat", lab: str = "lab", bars: str = "roll", out: str = "ds") -> str:
    keys = ", ".join(schemas.KEY_COLUMNS)
    held = {"has_trades": "trade_count > 0 AND volume > 0", "has_book": "has_book_data = 1", "is_time_bar_complete": "is_time_bar_complete = 1",
            "has_open_interest": "has_open_interest_data = 1", "has_funding": "has_funding_data = 1"}
    flags = ", ".join(f"CAST({test} AS INTEGER) AS sample_{name}" for name, test in held.items())
    return f"""
{out}_sample AS (SELECT {keys}, {", ".join(DS.SAMPLE_CONTEXT_COLUMNS)}, {flags} FROM {bars}),
{out}_feature AS (SELECT {keys}, {", ".join(DS.FEATURE_COLUMNS)},
    CAST({" AND ".join(f"coalesce(isfinite({c}), false)" for c in _FINITE)} AS INTEGER) AS feature_window_ready FROM {feat}),
{out}_label AS (SELECT {keys}, {", ".join(DS.LABEL_COLUMNS)}, is_valid AS label_is_valid FROM {lab}),
{out} AS (
    SELECT *, sample_has_trades * sample_has_book * sample_is_time_bar_complete * feature_window_ready AS training_ready
    FROM {out}_sample JOIN {out}_feature USING ({keys}) JOIN {out}_label USING ({keys})
)"""


def _ds_columns(names=None):
    kinds = {n: k for n, k in _cols(schemas.BARS)}
    kinds.update({n: k for n, k in _cols(schemas.FEATURES)})
    kinds.update({n: k for n, k in _cols(schemas.LABELS)})
    kinds.update({q: "i" for q in DS.QUALITY_COLUMNS})
    return [(n, kinds[n]) for n in (names or DS.ALL_COLUMNS)]


_DS_CTES_3600 = (
    _grid_ctes(60),
    O.rollup_cte(3600),
    O.features_ctes(3600, src="roll"),
    O.labels_ctes(3600, src="roll"),
    _dataset_cte(),
)


def _dataset_3600(c: Ctx) -> DataFrame:
    h = rollup_bars(c.grid(60), 3600)
    return DS.dataset(time_bar_features(h, 3600), time_bar_labels(h, 3600), h)


@register("dataset_join", _sql(*_DS_CTES_3600, select="SELECT * FROM ds", columns=_ds_columns()))
def q_dataset_join(spark, sf):
    return _out(_dataset_3600(Ctx(spark, sf)))


@register(
    "dataset_select",
    _sql(*_DS_CTES_3600, select=f"SELECT {', '.join(DS.TRAIN_COLUMNS)} FROM ds WHERE training_ready = 1 AND label_is_valid = 1",
         columns=_ds_columns(DS.TRAIN_COLUMNS)),
)
def q_dataset_select(spark, sf):
    ds = _dataset_3600(Ctx(spark, sf))
    return _out(DS.dataset_select(ds, training_ready_only=True, label_valid_only=True, column_set="train"))


@register(
    "dataset_view",
    _sql(
        _grid_ctes(60),
        O.rollup_cte(900, out="r900"),
        O.rollup_cte(3600, out="r3600"),
        "roll AS (SELECT * FROM r900 UNION ALL SELECT * FROM r3600)",
        O.features_ctes(900, src="roll", out="f900", p="fa"),
        O.features_ctes(3600, src="roll", out="f3600", p="fb"),
        "feat AS (SELECT * FROM f900 UNION ALL SELECT * FROM f3600)",
        O.labels_ctes(900, src="roll", out="l900", p="la"),
        O.labels_ctes(3600, src="roll", out="l3600", p="lb"),
        "lab AS (SELECT * FROM l900 UNION ALL SELECT * FROM l3600)",
        _dataset_cte(),
        select="SELECT * FROM ds",
        columns=_ds_columns(),
    ),
)
def q_dataset_view(spark, sf):
    c = Ctx(spark, sf)
    g = c.grid(60)
    rolls = [rollup_bars(g, n) for n in (900, 3600)]
    bars = rolls[0].unionByName(rolls[1])
    feats = time_bar_features(bars, 900).unionByName(time_bar_features(bars, 3600))
    labs = time_bar_labels(bars, 900).unionByName(time_bar_labels(bars, 3600))
    ds = DS.dataset(feats, labs, bars)
    ds.createOrReplaceTempView("dataset_time_bar")
    return _out(spark.table("dataset_time_bar"))


@register(
    "dataset_fused",
    _sql(
        _grid_ctes(60).replace("\nbars AS (", "\nbars AS MATERIALIZED ("), O.features_ctes(60), O.labels_ctes(60), _dataset_cte(bars="bars"),
        select="SELECT * FROM ds", columns=_ds_columns(),
    ),
)
def q_dataset_fused(spark, sf):
    return _out(DS.dataset_fused(Ctx(spark, sf).grid(60), 60))


# ----------------------------------------------------------------- quality (QC)

_QC1_END = O.shift(E, -86400)


@register(
    "qc_trade_reconcile",
    _sql(
        O.bars_ctes(60, S, _QC1_END),
        f"""counted AS (
    SELECT exchange, symbol, {O.bucket('timestamp', 60)} AS bar_time, 1 AS in_raw, 0 AS in_bars FROM trades
    UNION ALL SELECT exchange, symbol, bar_time, 0, trade_count FROM bars WHERE bar_interval_sec = 60)""",
        select="""SELECT exchange, symbol, bar_time, sum(in_raw) AS raw_trade_count, sum(in_bars) AS bar_trade_count,
                  sum(in_raw - in_bars) AS trade_count_delta
                  FROM counted GROUP BY ALL HAVING sum(in_raw - in_bars) <> 0""",
        columns=[("exchange", "s"), ("symbol", "s"), ("bar_time", "t"), ("raw_trade_count", "l"), ("bar_trade_count", "l"), ("trade_count_delta", "l")],
    ),
)
def q_qc_reconcile(spark, sf):
    c = Ctx(spark, sf)
    bars = B.time_bars(c.raw, 60, c.start, c.end_minus(1))
    return _out(QC.trade_count_reconciliation(c.raw["trades"], bars))


@register(
    "qc_rollup_gaps",
    _sql(
        _grid_ctes(60),
        select=f"""SELECT exchange, symbol, {O.bucket('bar_time', 3600)} AS rollup_bar_time, count(*) AS source_bar_count
                   FROM bars WHERE bar_interval_sec = 60 GROUP BY ALL HAVING count(*) <> 60""",
        columns=[("exchange", "s"), ("symbol", "s"), ("rollup_bar_time", "t"), ("source_bar_count", "l")],
    ),
)
def q_qc_rollup_gaps(spark, sf):
    return _out(QC.rollup_gaps(Ctx(spark, sf).grid(60), 3600))


def _bad(c):
    return f"count(*) FILTER (WHERE isnan({c}) OR abs({c}) = 'inf'::DOUBLE)"


_QC3_COLS = [
    ("row_count", "l"), ("log_return_null", "l"), ("realized_vol_20_null", "l"), ("realized_vol_20_bad_rows", "l"),
    ("volume_zscore_20_bad_rows", "l"), ("autocorrelation_5_bad_rows", "l"), ("autocorrelation_20_bad_rows", "l"),
    ("oi_zscore_20_bad_rows", "l"), ("kyle_lambda_bad", "l"), ("amihud_bad", "l"), ("vol_ratio_bad", "l"),
    ("buy_ratio_out_of_range", "l"), ("close_position_out_of_range", "l"), ("extreme_return_count", "l"),
    ("large_trade_pct_distinct_values", "l"),
]


@register(
    "qc_features",
    _sql(
        _grid_ctes(60), O.features_ctes(60),
        select=f"""SELECT count(*) AS row_count, count(*) FILTER (WHERE log_return IS NULL) AS log_return_null,
            count(*) FILTER (WHERE realized_vol_20 IS NULL) AS realized_vol_20_null,
            {_bad('realized_vol_20')} AS realized_vol_20_bad_rows, {_bad('volume_zscore_20')} AS volume_zscore_20_bad_rows,
            {_bad('autocorrelation_5')} AS autocorrelation_5_bad_rows, {_bad('autocorrelation_20')} AS autocorrelation_20_bad_rows,
            {_bad('oi_zscore_20')} AS oi_zscore_20_bad_rows, {_bad('kyle_lambda_approx')} AS kyle_lambda_bad,
            {_bad('amihud_illiquidity')} AS amihud_bad, {_bad('vol_ratio_5_20')} AS vol_ratio_bad,
            count(*) FILTER (WHERE buy_ratio < 0 OR buy_ratio > 1) AS buy_ratio_out_of_range,
            count(*) FILTER (WHERE close_position < 0 OR close_position > 1) AS close_position_out_of_range,
            count(*) FILTER (WHERE abs(log_return) > 0.5) AS extreme_return_count,
            count(DISTINCT coalesce(large_trade_pct, CAST(-1 AS DOUBLE))) AS large_trade_pct_distinct_values
            FROM feat""",
        columns=_QC3_COLS,
    ),
)
def q_qc_features(spark, sf):
    c = Ctx(spark, sf)
    return _out(QC.feature_quality(time_bar_features(c.grid(60), 60), 60))


@register(
    "qc_labels",
    _sql(
        _grid_ctes(60), O.labels_ctes(60),
        select="""SELECT count(*) AS row_count, count(*) FILTER (WHERE is_valid = 0) AS invalid_row_count,
                  min(bar_time) FILTER (WHERE is_valid = 0) AS first_invalid_bar_time,
                  max(bar_time) FILTER (WHERE is_valid = 0) AS last_invalid_bar_time FROM lab""",
        columns=[("row_count", "l"), ("invalid_row_count", "l"), ("first_invalid_bar_time", "t"), ("last_invalid_bar_time", "t")],
    ),
)
def q_qc_labels(spark, sf):
    c = Ctx(spark, sf)
    return _out(QC.label_quality(time_bar_labels(c.grid(60), 60), 60))


_R_QC = (O.shift(S, 5 * 86400), O.shift(S, 12 * 86400))
_TWO_INTERVALS = (
    _grid_ctes(60),
    O.rollup_cte(900, out="r900"),
    O.rollup_cte(3600, out="r3600"),
    "roll AS (SELECT * FROM r900 UNION ALL SELECT * FROM r3600)",
    O.features_ctes(900, src="roll", out="f900", p="fa"),
    O.features_ctes(3600, src="roll", out="f3600", p="fb"),
    "feat AS (SELECT * FROM f900 UNION ALL SELECT * FROM f3600)",
    O.labels_ctes(900, src="roll", out="l900", p="la"),
    O.labels_ctes(3600, src="roll", out="l3600", p="lb"),
    "lab AS (SELECT * FROM l900 UNION ALL SELECT * FROM l3600)",
    _dataset_cte(),
)


def _two_intervals(c: Ctx) -> tuple[DataFrame, DataFrame]:
    g = c.grid(60)
    bars = rollup_bars(g, 900).unionByName(rollup_bars(g, 3600))
    labels = time_bar_labels(bars, 900).unionByName(time_bar_labels(bars, 3600))
    features = time_bar_features(bars, 900).unionByName(time_bar_features(bars, 3600))
    return DS.dataset(features, labels, bars), labels


@register(
    "qc_dataset_rowcount",
    _sql(
        *_TWO_INTERVALS,
        select=f"""SELECT count(*) FILTER (WHERE side = 1) AS dataset_row_count, count(*) FILTER (WHERE side = 0) AS valid_label_row_count,
                  CAST(0 AS BIGINT) AS row_count_delta
                  FROM (SELECT 1 AS side, {", ".join(schemas.KEY_COLUMNS)} FROM ds WHERE label_is_valid = 1
                        UNION ALL SELECT 0, {", ".join(schemas.KEY_COLUMNS)} FROM lab WHERE is_valid = 1)
                  WHERE bar_interval_sec = 900 AND symbol = 'view' AND {O.cond('bar_time', *_R_QC)}""",
        columns=[("dataset_row_count", "l"), ("valid_label_row_count", "l"), ("row_count_delta", "l")],
    ),
)
def q_qc_dataset_rowcount(spark, sf):
    c = Ctx(spark, sf)
    ds, labels = _two_intervals(c)
    return _out(QC.dataset_row_count(ds, labels, 900, c.offset(5), c.offset(12), symbol="view"))


# ----------------------------------------------------------------- incremental + ledger (INC, RUN)


@register(
    "layer_watermarks",
    _sql(
        *_DS_CTES_3600[:4],
        select="""SELECT bar_interval_sec, max(bar_time) FILTER (WHERE k = 's') AS sample_max,
                  max(bar_time) FILTER (WHERE k = 'f') AS feature_max, max(bar_time) FILTER (WHERE k = 'l') AS label_max
                  FROM (SELECT bar_interval_sec, bar_time, 's' AS k FROM bars UNION ALL SELECT bar_interval_sec, bar_time, 's' FROM roll
                        UNION ALL SELECT bar_interval_sec, bar_time, 'f' FROM feat UNION ALL SELECT bar_interval_sec, bar_time, 'l' FROM lab)
                  GROUP BY bar_interval_sec""",
        columns=[("bar_interval_sec", "i"), ("sample_max", "t"), ("feature_max", "t"), ("label_max", "t")],
    ),
)
def q_layer_watermarks(spark, sf):
    c = Ctx(spark, sf)
    g = c.grid(60)
    h = rollup_bars(g, 3600)
    return _out(INC.layer_watermarks(g.unionByName(h), time_bar_features(h, 3600), time_bar_labels(h, 3600)))


def _half(c: Ctx) -> str:
    return c.offset(15)


_HALF = O.shift(S, 15 * 86400)


def _fmt(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%SZ')"


@register(
    "incremental_window",
    _sql(
        O.bars_ctes(60, S, _HALF, p="m"),
        O.rollup_cte(3600, src="bars", out="roll", start=S, end=_HALF),
        O.features_ctes(3600, src="roll", start=S, end=_HALF),
        O.labels_ctes(3600, src="roll", start=S, end=_HALF),
        """marks AS (
    SELECT bar_interval_sec, least(max(bar_time) FILTER (WHERE k = 's'), coalesce(max(bar_time) FILTER (WHERE k = 'f'), max(bar_time) FILTER (WHERE k = 's')),
                                   coalesce(max(bar_time) FILTER (WHERE k = 'l'), max(bar_time) FILTER (WHERE k = 's'))) AS anchor
    FROM (SELECT bar_interval_sec, bar_time, 's' AS k FROM bars UNION ALL SELECT bar_interval_sec, bar_time, 's' FROM roll
          UNION ALL SELECT bar_interval_sec, bar_time, 'f' FROM feat UNION ALL SELECT bar_interval_sec, bar_time, 'l' FROM lab)
    GROUP BY bar_interval_sec
)""",
        select=f"""SELECT bar_interval_sec,
                   {_fmt("anchor - to_seconds(CAST(bar_interval_sec * 120 AS BIGINT))")} AS window_start,
                   {_fmt(str(E))} AS window_end
                   FROM marks""",
        columns=[("bar_interval_sec", "i"), ("window_start", "s"), ("window_end", "s")],
    ),
)
def q_incremental_window(spark, sf):
    c = Ctx(spark, sf)
    store = c.store("incwin")
    INC.backfill(spark, store, c.raw, [3600], c.start, _half(c), refresh_dataset=False)
    windows = INC.run_windows(INC.stored_watermarks(spark, store), end=c.end)
    text = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(t)
    return windows.select("bar_interval_sec", text("window_start"), text("window_end"))


def _store_dataset(spark, store, interval: int) -> DataFrame:
    ds = INC.dataset_view(spark, store)
    return ds.filter(F.col("bar_interval_sec") == interval)


@register("incremental_backfill", _sql(*_DS_CTES_3600, select="SELECT * FROM ds", columns=_ds_columns()))
def q_incremental_backfill(spark, sf):
    c = Ctx(spark, sf)
    store = c.store("incremental")
    INC.backfill(spark, store, c.raw, [3600], c.start, _half(c), refresh_dataset=False)
    INC.incremental_backfill(spark, store, c.raw, [3600], end=c.end)
    return _out(_store_dataset(spark, store, 3600))


@register("incremental_bars_60", _sql(_grid_ctes(60), select="SELECT * FROM bars", columns=_cols(schemas.BARS)))
def q_incremental_bars(spark, sf):
    """INC-3 at 60 s: half the range, then one incremental run over the default overlap, equals the batch grid."""
    c = Ctx(spark, sf)
    store = c.store("incremental60")
    INC.run_steps(spark, store, c.raw, INC.plan_range([60], c.start, _half(c), refresh_dataset=False))
    INC.incremental_backfill(spark, store, c.raw, [60], end=c.end, refresh_dataset=False)
    return _out(SNK.read_layer(spark, store, "sample.bars_time", interval_sec=60))


@register("backfill", _sql(*_DS_CTES_3600, select="SELECT * FROM ds", columns=_ds_columns()))
def q_backfill(spark, sf):
    c = Ctx(spark, sf)
    store = c.store("backfill")
    INC.backfill(spark, store, c.raw, [3600], c.start, c.end)
    return _out(_store_dataset(spark, store, 3600))


_JOBS = (("sample", "bars_time", 60, "bars"), ("sample", "bars_time", 3600, "roll"), ("feature", "features_time_bar", 3600, "feat"), ("label", "labels_time_bar", 3600, "lab"))


@register(
    "run_ledger",
    _sql(
        *_DS_CTES_3600[:4],
        select=" UNION ALL ".join(
            f"SELECT '{layer}' AS layer, '{table}' AS table_name, {i} AS bar_interval_sec, 'done' AS status, count(*) AS row_count FROM {cte}"
            for layer, table, i, cte in _JOBS
        ),
        columns=[("layer", "s"), ("table_name", "s"), ("bar_interval_sec", "i"), ("status", "s"), ("row_count", "l")],
    ),
)
def q_run_ledger(spark, sf):
    c = Ctx(spark, sf)
    store = c.store("ledger")
    INC.backfill(spark, store, c.raw, [3600], c.start, c.end, refresh_dataset=False)
    state = LED.run_state(SNK.read_layer(spark, store, LED.LEDGER))
    return _out(state.select("layer", "table_name", "bar_interval_sec", "status", "row_count"))


def _event_ledger(c: Ctx) -> SNK.Store:
    """A ledger with one run per event: started at the event, and finished a second later unless the id is a multiple of four."""
    store = c.store("event_ledger")
    started = F.col("ts").cast("timestamp")
    start = c.events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.lit("sample").alias("layer"),
        F.col("event_type").alias("table_name"),
        F.lit(60).alias("bar_interval_sec"),
        F.lit("running").alias("status"),
        started.alias("started_at"),
        started.alias("event_ts"),
        F.col("event_id").alias("event_seq"),
    )
    later = F.col("event_ts") + F.expr("INTERVAL 1 SECOND")
    end = start.filter(F.col("event_seq") % 4 != 0).withColumns({"status": F.lit("done"), "event_ts": later, "finished_at": later})
    SNK.write_layer(start.unionByName(end, allowMissingColumns=True), store, LED.LEDGER)
    return store


# Runs are stale if they started before the last day began.
_STALE_AT = O.shift(E, -86400)


@register(
    "stale_runs",
    O.present_sql(
        f"""{O.with_(BOUNDS)} SELECT 'sample' AS layer, event_type AS table_name, 60 AS bar_interval_sec, count(*) AS stale_run_count, min(ts) AS oldest_started_at
            FROM events WHERE event_id % 4 = 0 AND ts < {O.ts_lit(_STALE_AT)} GROUP BY event_type""",
        [("layer", "s"), ("table_name", "s"), ("bar_interval_sec", "i"), ("stale_run_count", "l"), ("oldest_started_at", "t")],
        SCALED,
    ),
)
def q_stale_runs(spark, sf):
    c = Ctx(spark, sf)
    state = LED.run_state(SNK.read_layer(spark, _event_ledger(c), LED.LEDGER))
    return _out(LED.stale_runs(state, max_age_minutes=0, now=c.end_minus(1)))


@register(
    "repair_runs",
    O.present_sql(
        f"""{O.with_(BOUNDS)} SELECT event_type AS table_name, count(*) AS runs,
            CASE WHEN event_id % 4 <> 0 THEN 'done' WHEN ts < {O.ts_lit(_STALE_AT)} THEN 'failed' ELSE 'running' END AS status
            FROM events GROUP BY ALL""",
        [("table_name", "s"), ("status", "s"), ("runs", "l")],
        SCALED,
    ),
)
def q_repair_runs(spark, sf):
    """RUN-3: the repair is appended; a second read of the ledger sees it."""
    c = Ctx(spark, sf)
    store = _event_ledger(c)
    LED.repair_stale_runs(spark, store, max_age_minutes=0, now=c.end_minus(1))
    state = LED.run_state(SNK.read_layer(spark, store, LED.LEDGER))
    return _out(state.groupBy("table_name", "status").agg(F.count("*").alias("runs")))


# ----------------------------------------------------------------- streaming (STR, SRC-6)


def _stream_sql(n: int) -> str:
    return _sql(
        O.trade_bars_ctes(n),
        select=f"""SELECT * FROM tb WHERE bar_time + to_seconds(CAST({n} AS BIGINT))
                   <= (SELECT max(timestamp) FROM trades) - to_seconds(CAST(120 AS BIGINT))""",
        columns=_TB_COLS,
    )


@register("stream_trade_bars", _stream_sql(60))
def q_stream_bars(spark, sf):
    configure(spark)
    return _out(STR.stream_bars_to(spark, sf, shared_path(spark, "candlewick_stream"), 60).select(*[n for n, _ in _TB_COLS]))


@register("stream_watermark", _stream_sql(3600))
def q_stream_watermark(spark, sf):
    configure(spark)
    return _out(STR.stream_bars_to(spark, sf, shared_path(spark, "candlewick_stream"), 3600).select(*[n for n, _ in _TB_COLS]))


_LANDED = {"trades": "trades", "book": "book", "liquidations": "liq", "funding": "funding", "open_interest": "oi"}


def _register_landing(channel: str) -> None:
    name = SNK.RAW_TABLES[channel]

    @register("stream_ingest" if channel == "trades" else f"stream_ingest_{channel}", _sql(select=f"SELECT * FROM {_LANDED[channel]}", columns=_cols(schemas.LAYERS[name][0])))
    def q_landing(spark, sf):
        c = Ctx(spark, sf)
        store = c.store("landing")
        STR.land_stream(spark, sf, store, [channel])
        return _out(SNK.read_layer(spark, store, name))


for _channel in _LANDED:
    _register_landing(_channel)


@register("stream_ingest_resumed", _sql(select="SELECT * FROM trades", columns=_cols(schemas.RAW_TRADES)))
def q_landing_resumed(spark, sf):
    """SRC-6 over several calls: two sources, one of them twice, and a batch append give each row once."""
    c = Ctx(spark, sf)
    store, folder = c.store("resumed"), shared_path(spark, "candlewick_sources", unique=True)
    third = F.pmod(F.col("event_id"), F.lit(3))
    sources = [f"{folder}/{k}/events.parquet" for k in range(2)]
    for k, source in enumerate(sources):
        c.events.filter(third == k).write.parquet(source)
    for source in (*sources, sources[0]):
        STR.land_stream(spark, source, store, ["trades"])
    SNK.land_raw({"trades": fixtures.raw_frames(c.events.filter(third == 2))["trades"]}, store)
    return _out(SNK.read_layer(spark, store, "raw.trades"))


@register(
    "stream_late_repair",
    _sql(
        _grid_ctes(60),
        select=f"SELECT * FROM bars WHERE bar_time <= (SELECT max({O.bucket('timestamp', 60)}) FROM trades)",
        columns=_cols(schemas.BARS),
    ),
)
def q_stream_late_repair(spark, sf):
    """STR-3: the bars of early rows, then late rows of all five channels; every column equals the batch grid."""
    c = Ctx(spark, sf)
    store = c.store("repair")
    SNK.bootstrap(spark, store)
    late = F.pmod(F.xxhash64("symbol", "timestamp"), F.lit(10)) == 0
    checkpoint = shared_path(spark, "candlewick_repair", unique=True)
    for part in (~late, late):
        SNK.land_raw({channel: rows.filter(part) for channel, rows in c.raw.items()}, store)
        STR.stream_late_repair(spark, store, checkpoint)
    return _out(SNK.read_layer(spark, store, "sample.bars_time"))


# ----------------------------------------------------------------- sinks (SNK)


@register("write_layer", _sql(O.bars_ctes(60), select="SELECT * FROM bars", columns=_cols(schemas.BARS)))
def q_write_layer(spark, sf):
    c = Ctx(spark, sf)
    store = c.store("write")
    bars = B.time_bars(c.raw, 60)
    SNK.write_layer(bars, store, "sample.bars_time")
    SNK.write_layer(bars, store, "sample.bars_time")  # a re-run: same keys, newer version
    return _out(SNK.read_layer(spark, store, "sample.bars_time").drop("_version", "_run_id"))


@register("compact_layer", _sql(O.bars_ctes(60), select="SELECT * FROM bars", columns=_cols(schemas.BARS)))
def q_compact_layer(spark, sf):
    """SNK-1 around compaction: a re-run, a compaction that stops before its commit, one that commits, and a further re-run of half the range."""
    c = Ctx(spark, sf)
    store, name = c.store("compact"), "sample.bars_time"
    bars = B.time_bars(c.raw, 60)
    for _ in range(2):
        SNK.write_layer(bars, store, name)
    SNK._put_files(SNK.read_layer(spark, store, name, latest=False).withColumn("ym", F.date_format("bar_time", "yyyyMM")), store, name, rewrite=True)
    SNK.compact_layer(spark, store, name)
    SNK.write_layer(bars.filter(F.col("bar_time") < F.lit(c.offset(15)).cast("timestamp")), store, name)
    return _out(SNK.read_layer(spark, store, name))


@register(
    "export_csv",
    _sql(*_DS_CTES_3600, select=f"SELECT {', '.join(DS.TRAIN_COLUMNS)} FROM ds WHERE training_ready = 1 AND label_is_valid = 1", columns=_ds_columns(DS.TRAIN_COLUMNS)),
)
def q_export_csv(spark, sf):
    ds = _dataset_3600(Ctx(spark, sf))
    path = shared_path(spark, "candlewick_export", unique=True)
    SNK.export_csv(ds, path)
    return _out(spark.read.option("header", True).schema(ds.select(*DS.TRAIN_COLUMNS).schema).csv(path))


@register(
    "schema_bootstrap",
    _sql(
        select=" UNION ALL ".join(
            f"SELECT '{name}' AS table_name, {len(schema.fields)} AS column_count, "
            + (f"(SELECT count(*) FROM {_LANDED[next(k for k, v in SNK.RAW_TABLES.items() if v == name)]})" if name in SNK.RAW_TABLES.values() else "CAST(0 AS BIGINT)")
            + " AS row_count"
            for name, (schema, _) in schemas.LAYERS.items()
        ),
        columns=[("table_name", "s"), ("column_count", "i"), ("row_count", "l")],
    ),
)
def q_schema_bootstrap(spark, sf):
    """SNK-4: bootstrap every layer table, land the raw frames, report schema width and rows per table."""
    c = Ctx(spark, sf)
    store = c.store("bootstrap")
    SNK.bootstrap(spark, store)
    SNK.land_raw(c.raw, store)
    parts = [
        SNK.read_layer(spark, store, name, latest=False).agg(
            F.lit(name).alias("table_name"), F.lit(len(schema.fields)).alias("column_count"), F.count(F.lit(1)).alias("row_count")
        )
        for name, (schema, _) in schemas.LAYERS.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _out(out)


_RET_NOW = O.shift(E, 76 * 86400)


@register(
    "retention",
    _sql(select=f"SELECT * FROM book WHERE timestamp >= {O.ts_lit(_RET_NOW)} - INTERVAL 90 DAY", columns=_cols(schemas.RAW_BOOK_TOPK)),
)
def q_retention(spark, sf):
    c = Ctx(spark, sf)
    now = (parse_utc(c.end) + timedelta(days=76)).strftime("%Y-%m-%d %H:%M:%S")
    return _out(SNK.retention_filter(c.raw["book"], now=now))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(SPARK)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
