"""SQL oracles: the registered queries written independently for a plain SQL engine (DuckDB dialect)."""

from __future__ import annotations

from barflow.operators.indicators import GOLD_COLUMNS, GOLD_FEATURES, LAGS, WINDOWS, engineered_columns
from barflow.plans.catalog import (
    AS_OF, CHECK_DATE, CUTOFF, EXACT, FOUR_PLACES, RANGE, RUN_DATE,
)

# ---------------------------------------------------------------- building blocks

INTEGERS = {"volume", "target", "target_direction_5d", "day_of_week", "month", "quarter",
            "is_month_start", "is_month_end", *(f"volume_lag_{k}" for k in LAGS)}


def cols(*names: str) -> str:
    """Select list with doubles rounded as the queries round them."""
    parts = []
    for name in names:
        expression, _, alias = name.rpartition(" AS ")
        expression = expression or alias
        if alias in INTEGERS or alias in EXACT:
            parts.append(f"{expression} AS {alias}")
        else:
            parts.append(f"round({expression}, {4 if alias in FOUR_PLACES else 6}) AS {alias}")
    return ", ".join(parts)


def sql(select: str, *ctes: str) -> str:
    return f"WITH RECURSIVE {', '.join(ctes)} {select}" if ctes else select


BARS = """bars AS MATERIALIZED (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
         arg_max(o_totalprice, o_orderkey) AS close, arg_max(o_totalprice, o_orderkey) AS adj_close,
         count(*) AS volume
  FROM orders GROUP BY 1, 2)"""

BRAND = """brand_ticks AS (
  SELECT p.p_brand AS symbol, CAST(l.l_shipdate AS DATE) AS date, l.l_quantity AS quantity,
         l.l_extendedprice / l.l_quantity AS price,
         row_number() OVER (PARTITION BY p.p_brand, CAST(l.l_shipdate AS DATE)
           ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice / l.l_quantity) AS tick
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
bars AS MATERIALIZED (
  SELECT symbol, date, arg_min(price, tick) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, tick) AS close, arg_max(price, tick) AS adj_close,
         CAST(sum(quantity) AS BIGINT) AS volume
  FROM brand_ticks GROUP BY 1, 2)"""

DIRTY = BARS + """,
keyed AS (SELECT *, 7 * date_diff('day', DATE '1995-01-01', date)
            + CAST(substr(symbol, 1, 1) AS INTEGER) AS k FROM bars),
raw AS MATERIALIZED (
  SELECT symbol, date,
         CASE WHEN k % 97 <> 0 AND k % 41 <> 0 THEN open END AS open,
         CASE WHEN k % 97 <> 0 THEN CASE WHEN k % 37 = 0 THEN low ELSE high END END AS high,
         CASE WHEN k % 97 <> 0 THEN CASE WHEN k % 37 = 0 THEN high ELSE low END END AS low,
         CASE WHEN k % 97 <> 0 AND k % 53 <> 0 THEN CASE WHEN c = 2 THEN close * 1.001 ELSE close END END AS close,
         adj_close,
         CASE WHEN k % 61 <> 0 THEN CASE WHEN k % 29 = 0 THEN 0 ELSE volume END END AS volume,
         'landing' AS source, c AS delivery, 'batch-' || c AS batch_id
  FROM keyed, (VALUES (1), (2)) AS copies(c) WHERE c = 1 OR k % 47 = 0)"""

LAST = """last_raw AS (SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY delivery DESC) = 1)"""
FIRST = """last_raw AS (SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY delivery) = 1)"""


def _ffill(c: str, frame: str = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW") -> str:
    return f"last_value({c} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date {frame})"


def _bfill(c: str) -> str:
    return (f"first_value({c} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date "
            "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")


SILVER = f"""filled AS (
  SELECT symbol, date, adj_close, batch_id, volume AS raw_volume,
         open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL AS is_imputed,
         {_ffill("open")} AS o, {_ffill("high")} AS h, {_ffill("low")} AS l, {_ffill("close")} AS c
  FROM last_raw),
moved AS (SELECT *, lag(c) OVER (PARTITION BY symbol ORDER BY date) AS prev FROM filled),
silver AS MATERIALIZED (
  SELECT symbol, date, o AS open, CASE WHEN h < l THEN l ELSE h END AS high,
         CASE WHEN h < l THEN h ELSE l END AS low, c AS close, adj_close,
         coalesce(raw_volume, 0) AS volume, c / nullif(prev, 0) - 1 AS return_simple,
         ln(c / nullif(prev, 0)) AS return_log, is_imputed,
         (100 - CASE WHEN is_imputed THEN 30 ELSE 0 END - CASE WHEN raw_volume = 0 THEN 20 ELSE 0 END
              - CASE WHEN h < l THEN 20 ELSE 0 END) / 100.0 AS quality_score, batch_id
  FROM moved WHERE o IS NOT NULL AND h IS NOT NULL AND l IS NOT NULL AND c IS NOT NULL)"""
SILVER_OUT = (
    "symbol, date, batch_id, is_imputed, volume, CAST(quality_score AS DOUBLE) AS quality_score, "
    + cols("open", "high", "low", "close", "adj_close", "return_simple", "return_log")
)


def averages(source: str = "bars") -> str:
    """Exponential averages and the signal by plain recursion over the row number."""
    return f"""numbered AS MATERIALIZED (
  SELECT symbol, date, close, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM {source}),
recur(symbol, rn, date, e12, e26, sig) AS (
  SELECT symbol, rn, date, close, close, CAST(0 AS DOUBLE) FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.symbol, n.rn, n.date,
         2.0/13 * n.close + 11.0/13 * r.e12, 2.0/27 * n.close + 25.0/27 * r.e26,
         0.2 * ((2.0/13 * n.close + 11.0/13 * r.e12) - (2.0/27 * n.close + 25.0/27 * r.e26)) + 0.8 * r.sig
  FROM recur r JOIN numbered n ON n.symbol = r.symbol AND n.rn = r.rn + 1),
averages AS MATERIALIZED (
  SELECT symbol, date, e12 AS ema_12, e26 AS ema_26, e12 - e26 AS macd, sig AS macd_signal,
         e12 - e26 - sig AS macd_histogram FROM recur)"""


def _full(fn: str, column: str, n: int) -> str:
    return f"CASE WHEN count({column}) OVER w{n} >= {n} THEN {fn}({column}) OVER w{n} END"


def features(source: str = "bars", log_return: str = "ln(close / nullif(lag_1, 0))") -> str:
    """Every finite-frame feature over a table of bars."""
    lags = ", ".join(f"lag(close, {k}) OVER w AS lag_{k}" for k in (*LAGS, 4, 6, 11, 22))
    volume_lags = ", ".join(f"lag(volume, {k}) OVER w AS volume_lag_{k}" for k in LAGS)
    rolled = []
    for n in (*WINDOWS, 20, 30):
        rolled += [f"{_full('avg', 'close', n)} AS sma_{n}", f"{_full('stddev_samp', 'close', n)} AS std_{n}",
                   f"{_full('min', 'close', n)} AS rolling_min_{n}", f"{_full('max', 'close', n)} AS rolling_max_{n}",
                   f"{_full('avg', 'volume', n)} AS volume_sma_{n}"]
    for n in (7, 14):
        rolled += [f"{_full('avg', 'gain', n)} AS gain_{n}", f"{_full('avg', 'loss', n)} AS loss_{n}",
                   f"{_full('max', 'loss', n)} AS worst_{n}"]
    rolled += [f"{_full('avg', 'true_range', 14)} AS atr_14", f"{_full('avg', 'term', 21)} AS gk_21"]
    rolled += [f"{_full('stddev_samp', 'log_return', n)} * sqrt(252) AS volatility_{n}d" for n in (21, 63)]
    windows = ", ".join(
        f"w{n} AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for n in (5, 7, 10, 14, 20, 21, 30, 63))
    out = []
    for n in WINDOWS:
        out += [
            f"CASE WHEN rolling_max_{n} > rolling_min_{n} THEN (close - sma_{n}) / nullif(std_{n}, 0) END AS zscore_{n}",
            f"(close - rolling_min_{n}) / nullif(rolling_max_{n} - rolling_min_{n}, 0) AS range_position_{n}",
            f"volume / nullif(volume_sma_{n}, 0) AS volume_ratio_{n}"]
    for k in LAGS:
        out += [f"lag_{k} AS close_lag_{k}", f"lag_{k} / nullif(lag_{k + 1}, 0) - 1 AS return_lag_{k}"]
    for n in (7, 14):
        out.append(f"CASE WHEN worst_{n} > 0 THEN 100 - 100 / (1 + gain_{n} / loss_{n}) END AS rsi_{n}")
    return f"""near AS (
  SELECT *, {lags}, {volume_lags}, lead(close, 5) OVER w AS ahead_5
  FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY date)),
rowwise AS (
  SELECT *, CASE WHEN close > lag_1 THEN close - lag_1 ELSE 0 END AS gain,
         CASE WHEN close < lag_1 THEN lag_1 - close ELSE 0 END AS loss,
         {log_return} AS log_return,
         greatest(high - low, abs(high - lag_1), abs(low - lag_1)) AS true_range,
         0.5 * ln(high / low) ** 2 - (2 * ln(2) - 1) * ln(close / open) ** 2 AS term,
         sum(coalesce(sign(close - lag_1) * volume, 0)) OVER (PARTITION BY symbol ORDER BY date
           ROWS UNBOUNDED PRECEDING)::DOUBLE AS obv
  FROM near),
rolled AS (SELECT *, {", ".join(rolled)} FROM rowwise WINDOW {windows}),
feat AS MATERIALIZED (
  SELECT *, {", ".join(out)},
         close / nullif(lag_1, 0) - 1 AS return_1d, close / nullif(lag_5, 0) - 1 AS return_5d,
         close / nullif(lag_21, 0) - 1 AS return_21d,
         ln(close / nullif(lag_1, 0)) AS log_return_1d, ln(close / nullif(lag_5, 0)) AS log_return_5d,
         sma_20 + 2 * std_20 AS bb_upper, sma_20 - 2 * std_20 AS bb_lower, 4 * std_20 / sma_20 AS bb_width,
         (close - (sma_20 - 2 * std_20)) / nullif(4 * std_20, 0) AS bb_position,
         CASE WHEN gk_21 >= 0 THEN sqrt(gk_21 * 252) END AS gk_volatility, (high - low) / open AS intraday_range,
         ahead_5 / nullif(close, 0) - 1 AS future_return_5d,
         CAST(ahead_5 / nullif(close, 0) - 1 > 0 AS INTEGER) AS target_direction_5d,
         CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
         CAST(quarter(date) AS INTEGER) AS quarter, CAST(day(date) = 1 AS INTEGER) AS is_month_start, CAST(last_day(date) = date AS INTEGER) AS is_month_end
  FROM rolled)"""


ALL_FEATURES = "wide AS MATERIALIZED (SELECT f.*, a.* EXCLUDE (symbol, date) FROM feat f JOIN averages a USING (symbol, date))"
GOLD = "gold AS MATERIALIZED (SELECT * FROM wide WHERE sma_63 IS NOT NULL AND volatility_63d IS NOT NULL AND rsi_14 IS NOT NULL)"
GOLD_OF_BARS = (BARS, averages(), features(), ALL_FEATURES, GOLD)
GOLD_OF_SILVER = (DIRTY, LAST, SILVER, averages("silver"), features("silver", "return_log"), ALL_FEATURES, GOLD)

ASSETS = """assets AS (
  SELECT DISTINCT o_orderpriority AS symbol, 'Asset ' || substr(o_orderpriority, 1, 1) AS name,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'energy' WHEN '2' THEN 'mining' ELSE 'banking' END AS sector,
         'BRL' AS currency
  FROM orders WHERE o_orderpriority <> '5-LOW')"""

PREDICTIONS = """steps AS (
  SELECT symbol, date, close, row_number() OVER w AS rn, lag(close, 5) OVER w AS lag_5,
         lead(close, 5) OVER w AS ahead_5, lead(date, 5) OVER w AS ahead_date
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)),
predictions AS MATERIALIZED (
  SELECT symbol, date AS prediction_date, date + 7 AS target_date, 'momentum_v1' AS model_version,
         CAST(close > lag_5 AS INTEGER) AS predicted_direction, 0.5 + (rn % 50) / 100.0::DOUBLE AS confidence,
         CAST(ahead_5 / close - 1 > 0 AS INTEGER) AS actual_direction, ahead_5 / close - 1 AS actual_return,
         (close > lag_5) = (ahead_5 / close - 1 > 0) AS is_correct, ahead_date
  FROM steps WHERE rn % 10 = 0)"""

FOLDS = """labelled AS (SELECT * FROM ({labelled})),
counted AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS pos,
                   count(*) OVER (PARTITION BY symbol) AS n FROM labelled),
folds AS MATERIALIZED (
  SELECT *, CASE WHEN fold = 0 THEN 'too_short' WHEN pos >= n - (5 - fold) * 63 - 63 THEN 'test' ELSE 'train' END AS role
  FROM counted, (SELECT unnest(range(0, 6)) AS fold) AS f
  WHERE CASE WHEN fold = 0 THEN n < 378 ELSE n >= 378 AND pos < n - (5 - fold) * 63 END)"""
MOMENTUM = FOLDS.format(labelled="""SELECT symbol, date, CAST(close > lag_5 AS INTEGER) AS prediction,
  CAST(ahead_5 / close - 1 > 0 AS INTEGER) AS label FROM steps WHERE lag_5 IS NOT NULL AND ahead_5 IS NOT NULL""")
SCORES = """counts AS (
  SELECT symbol, fold, count(*) FILTER (role = 'test' AND prediction = 1 AND label = 1) AS tp,
         count(*) FILTER (role = 'test' AND prediction = 1 AND label = 0) AS fp,
         count(*) FILTER (role = 'test' AND prediction = 0 AND label = 1) AS fn,
         count(*) FILTER (role = 'test' AND prediction = 0 AND label = 0) AS tn,
         max(date) FILTER (role = 'test') AS trained_at, count(*) FILTER (role = 'train') AS n_train
  FROM folds GROUP BY 1, 2),
scores AS MATERIALIZED (
  SELECT *, (tp + tn) / nullif(tp + fp + fn + tn, 0) AS accuracy,
         CASE WHEN fold > 0 THEN coalesce(tp / nullif(tp + fp, 0), 0) END AS precision,
         CASE WHEN fold > 0 THEN coalesce(tp / nullif(tp + fn, 0), 0) END AS recall,
         CASE WHEN fold > 0 THEN coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) END AS f1_score,
         (tp + tn) / nullif(tp + fp + fn + tn, 0) AS directional_accuracy
  FROM counts)"""
MOMENTUM_SCORES = (BARS, PREDICTIONS, MOMENTUM, SCORES)
SCORE_NAMES = ("accuracy", "precision", "recall", "f1_score", "directional_accuracy")
TRAININGS = "trainings AS (" + " UNION ALL ".join(
    f"SELECT 'fold_' || fold AS model_version, trained_at, symbol, '{m}' AS metric_name, {m} AS metric_value, n_train FROM scores WHERE fold > 0"
    for m in SCORE_NAMES) + ")"

CHECKS = f"""negative AS (
  SELECT symbol, date, open, high, low,
         CASE WHEN (7 * date_diff('day', DATE '1995-01-01', date) + CAST(substr(symbol, 1, 1) AS INTEGER)) % 89 = 0
              THEN -close ELSE close END AS close, volume
  FROM bars),
found AS (
  SELECT symbol, count(*) FILTER (close IS NULL) AS a, count(*) FILTER (high < low) AS b,
         count(*) FILTER (close < 0 OR open < 0) AS c, max(date) AS d FROM negative GROUP BY 1),
checks AS (
  SELECT symbol, DATE '{CHECK_DATE}' AS check_date, 'completeness_no_null_close' AS check_name, a = 0 AS passed,
         '{{"null_count":' || a || '}}' AS details FROM found
  UNION ALL SELECT symbol, DATE '{CHECK_DATE}', 'consistency_ohlc_integrity', b = 0, '{{"invalid_rows":' || b || '}}' FROM found
  UNION ALL SELECT symbol, DATE '{CHECK_DATE}', 'validity_no_negative_prices', c = 0, '{{"negative_count":' || c || '}}' FROM found
  UNION ALL SELECT symbol, DATE '{CHECK_DATE}', 'freshness_has_recent_data', d IS NOT NULL, '{{"max_date":"' || d || '"}}' FROM found)"""

SIDES = "sides AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT symbol, CASE WHEN date < DATE '{CUTOFF}' THEN 'ref' ELSE 'cur' END AS side, '{c}' AS feature, "
    f"round({c}, 4) AS x FROM gold WHERE {c} IS NOT NULL" for c in GOLD_FEATURES) + ")"
BINS = """ranges AS (SELECT symbol, feature, min(x) AS lo, max(x) AS hi FROM sides GROUP BY 1, 2),
bins AS (SELECT symbol, feature, side,
           CASE WHEN hi = lo THEN 9 ELSE least(CAST(floor((x - lo) / (hi - lo) * 10) AS BIGINT), 9) END AS bin
         FROM sides JOIN ranges USING (symbol, feature)),
histogram AS MATERIALIZED (SELECT symbol, feature, bin, count(*) FILTER (side = 'ref') AS n_ref,
           count(*) FILTER (side = 'cur') AS n_cur FROM bins GROUP BY 1, 2, 3)"""
PSI = """totals AS (SELECT symbol, feature, CAST(sum(n_ref) AS BIGINT) AS n_ref, CAST(sum(n_cur) AS BIGINT) AS n_cur
           FROM histogram GROUP BY 1, 2),
shares AS (SELECT t.symbol, t.feature, t.n_ref, t.n_cur, (coalesce(h.n_ref, 0) + 1) / (t.n_ref + 10) AS e,
           (coalesce(h.n_cur, 0) + 1) / (t.n_cur + 10) AS a
         FROM totals t CROSS JOIN (SELECT unnest(range(10)) AS bin) b
         LEFT JOIN histogram h ON h.symbol = t.symbol AND h.feature = t.feature AND h.bin = b.bin),
psi AS MATERIALIZED (SELECT *, CASE WHEN psi >= 0.25 THEN 'CRITICAL' WHEN psi >= 0.1 THEN 'WARNING' ELSE 'OK' END AS severity
  FROM (SELECT symbol, feature, n_ref, n_cur,
          CASE WHEN n_ref = 0 OR n_cur = 0 THEN 0 ELSE sum((a - e) * ln(a / e)) END AS psi
        FROM shares GROUP BY 1, 2, 3, 4))"""
KS = """per_value AS (SELECT symbol, feature, x, count(*) FILTER (side = 'ref') AS r, count(*) FILTER (side = 'cur') AS c
             FROM sides GROUP BY 1, 2, 3),
steps_up AS (SELECT symbol, feature, sum(r) OVER w AS ru, sum(c) OVER w AS cu,
               sum(r) OVER (PARTITION BY symbol, feature) AS n_ref, sum(c) OVER (PARTITION BY symbol, feature) AS n_cur
             FROM per_value WINDOW w AS (PARTITION BY symbol, feature ORDER BY x ROWS UNBOUNDED PRECEDING)),
gaps AS (SELECT symbol, feature, CAST(max(n_ref) AS BIGINT) AS n_ref, CAST(max(n_cur) AS BIGINT) AS n_cur,
           max(abs(ru::DOUBLE / nullif(n_ref, 0) - cu::DOUBLE / nullif(n_cur, 0))) AS gap FROM steps_up GROUP BY 1, 2),
scaled AS (SELECT *, n_ref < 10 OR n_cur < 10 AS few, sqrt(n_ref * n_cur / (n_ref + n_cur)) * gap AS lam FROM gaps),
ks AS MATERIALIZED (SELECT symbol, feature, n_ref, n_cur, CASE WHEN few THEN 0 ELSE gap END AS ks_statistic,
         CASE WHEN few OR lam < 0.2 THEN 1.0::DOUBLE ELSE greatest(0, least(1, list_sum(list_transform(range(1, 101),
           lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END)::DOUBLE * exp(-2.0 * k * k * lam * lam))))) END AS ks_p_value
       FROM scaled)"""
REPORT = """report AS MATERIALIZED (
  SELECT symbol, feature, round(psi, 4) AS psi, round(ks_statistic, 4) AS ks_statistic,
         round(ks_p_value, 4) AS ks_p_value, severity FROM psi JOIN ks USING (symbol, feature))"""
SUMMARY = """summed AS (
  SELECT symbol, count(*) AS total_features, count(*) FILTER (severity <> 'OK') AS drifted_features,
         coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (severity <> 'OK'), '') AS drifted_names
  FROM report GROUP BY 1),
drift_summary AS (
  SELECT *, round(drifted_features / total_features, 4) AS drift_ratio,
         CASE WHEN drifted_features / total_features >= 0.3 THEN 'RETRAIN_IMMEDIATELY'
              WHEN drifted_features / total_features >= 0.15 OR drifted_features >= 5 THEN 'RETRAIN_RECOMMENDED'
              WHEN drifted_features / total_features >= 0.05 THEN 'MONITOR_CLOSELY'
              ELSE 'NO_ACTION_NEEDED' END AS recommendation FROM summed)"""
DRIFT = (*GOLD_OF_BARS, SIDES, BINS, PSI, KS, REPORT, SUMMARY)

MONITOR = f"""trained AS (SELECT symbol, CAST(max(date) - 9 * CAST(substr(symbol, 1, 1) AS INTEGER) AS DATE) AS trained_at
  FROM bars GROUP BY 1),
ages AS (SELECT symbol, CAST(DATE '{AS_OF}' - trained_at AS BIGINT) AS model_age_days FROM trained),
newest AS (SELECT * FROM predictions WHERE actual_direction IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY target_date DESC) <= 20),
recent AS (SELECT symbol, count(*) AS n_recent, round(avg(CAST(is_correct AS INTEGER)), 4) AS recent_accuracy
  FROM newest GROUP BY 1),
advice AS (SELECT symbol, model_age_days, recent_accuracy, model_age_days > 30 AS is_stale,
    CASE WHEN model_age_days > 30 THEN 'RETRAIN_STALE_MODEL' WHEN recent_accuracy < 0.5 THEN 'RETRAIN_LOW_ACCURACY'
         WHEN model_age_days > 14 THEN 'MONITOR_CLOSELY' ELSE 'NO_ACTION_NEEDED' END AS recommendation
  FROM ages LEFT JOIN recent USING (symbol))"""

OHLC = cols("open", "high", "low", "close")
ORACLES: dict[str, str] = {}


def add(name: str, select: str, *ctes: str) -> None:
    ORACLES[name] = sql(select, *ctes)


# ---------------------------------------------------------------- sources and sinks

ALL_BAR = f"symbol, date, {OHLC}, adj_close, volume"
add("src_bars_scan", f"SELECT {ALL_BAR} FROM bars WHERE date >= DATE '{RANGE[0]}'", BRAND)
add("src_window_7d", f"SELECT {ALL_BAR} FROM bars WHERE date >= DATE '{RUN_DATE}' - 7 AND date < DATE '{RUN_DATE}'", BARS)
add("src_incremental_after_max", f"""SELECT {ALL_BAR} FROM bars b LEFT JOIN (
  SELECT symbol, max(date) AS last FROM bars WHERE date < DATE '{CUTOFF}' AND symbol <> '5-LOW' GROUP BY 1) m USING (symbol)
  WHERE date > coalesce(last, DATE '1900-01-01')""", BARS)
IN_WINDOW = f"date >= DATE '{RUN_DATE}' - 7 AND date < DATE '{RUN_DATE}'"
add("ing_rows_per_symbol", f"SELECT symbol, count(*) FILTER ({IN_WINDOW}) AS rows_ingested FROM bars GROUP BY 1", BARS)
# The delivery of one symbol fails as a whole.
add("ing_status_summary", """SELECT count(DISTINCT symbol) FILTER (symbol <> '5-LOW') AS succeeded, CAST(0 AS BIGINT) AS empty,
  count(DISTINCT symbol) FILTER (symbol = '5-LOW') AS failed, count(DISTINCT (symbol, date)) FILTER (symbol <> '5-LOW') AS total_rows
  FROM raw""", DIRTY)
add("src_rejected_rows", """SELECT symbol, date, close, CASE WHEN volume % 7 <> 0 THEN volume END AS volume,
  volume % 7 = 0 AS rejected FROM bars""", BARS)
add("src_wide_to_long", "SELECT symbol, date, close, volume FROM bars", BARS)
add("src_normalise_columns", f"""SELECT {ALL_BAR} FROM raw
  WHERE open IS NOT NULL OR high IS NOT NULL OR low IS NOT NULL OR close IS NOT NULL""", DIRTY)
add("scan_prices_range", f"""SELECT {ALL_BAR} FROM bars WHERE symbol IN ('1-URGENT', '3-MEDIUM')
  AND date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' ORDER BY symbol, date""", BARS)
add("lineage_last_batch", """SELECT symbol, date, batch_id AS source_batch_id FROM raw
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC, delivery DESC) = 1""", DIRTY)
add("ingestion_log_summary", """SELECT batch_id, symbol, min(date) AS start_date, max(date) AS end_date,
  count(*) AS rows_ingested, 'success' AS status, CAST(NULL AS VARCHAR) AS error_message FROM raw GROUP BY 1, 2""", DIRTY)

# ---------------------------------------------------------------- projections, casts, scalar functions

add("cast_numeric_coerce", """SELECT symbol, date, batch_id, open,
  CASE WHEN volume % 2 = 0 THEN NULL ELSE close END AS close, volume FROM raw""", DIRTY)
add("fn_math_bars", "SELECT symbol, date, " + cols(
    "ln(close) AS ln_close", "sqrt(close) AS sqrt_close", "ln(high / low) ** 2 AS square_range",
    "abs(close - open) AS abs_move", "CAST(sign(close - open) AS DOUBLE) AS sign_move",
    "greatest(high - low, abs(high - close), abs(low - close)) AS row_max", "round(close / 1000, 2) AS thousands",
    "least(greatest((close - low) / nullif(high - low, 0), 0), 1) AS clipped") + " FROM bars", BARS)
ORACLES["fn_math_bars"] = ORACLES["fn_math_bars"].replace(
    "least(greatest((close - low) / nullif(high - low, 0), 0), 1)",
    "CASE WHEN high = low THEN 0.0 ELSE least(greatest((close - low) / (high - low), 0), 1) END")
add("fn_null_handling", """SELECT symbol, date, batch_id, round(coalesce(close, adj_close), 6) AS any_close,
  coalesce(volume, 0) AS volume_filled, nullif(volume, 0) AS volume_or_null, open IS NOT NULL AS has_open FROM raw""", DIRTY)
add("fn_ticker_strings", f"""SELECT DISTINCT lower(p_brand) AS brand, replace(upper(p_brand) || '.SA', '.', '_') AS artifact,
  lower(p_brand) || '.sa|' || upper(p_brand) AS symbols, CAST(2 AS BIGINT) AS n_symbols,
  'gbt_v1_' || strftime(DATE '{AS_OF}', '%Y%m%d') AS version FROM part""")
add("feat_calendar", """SELECT symbol, date, isodow(date) - 1 AS day_of_week, month(date) AS month, quarter(date) AS quarter,
  CAST(day(date) = 1 AS BIGINT) AS is_month_start, CAST(last_day(date) = date AS BIGINT) AS is_month_end FROM bars""", BARS)


def _business(n: int) -> str:
    """n-th weekday after the date, found by listing the days after it."""
    return (f"list_filter(list_transform(range(1, {2 * n + 5}), lambda i: date + i::INTEGER), "
            f"lambda x: isodow(x) < 6)[{n}]")


add("target_date_bday", f"""SELECT symbol, date, {_business(5)} AS plus_5, {_business(1)} AS plus_1,
  {_business(13)} AS plus_13 FROM bars""", BARS)
add("target_date_calendar", "SELECT symbol, date, date + 7 AS target_date FROM bars", BARS)
add("pred_confidence", """SELECT symbol, date, p AS probability_up, CASE WHEN p > 0.5 THEN 'UP' ELSE 'DOWN' END AS direction,
  round(CASE WHEN p > 0.5 THEN p ELSE 1 - p END, 4) AS confidence
  FROM (SELECT symbol, date, round(((volume * 37) % 100) / 100::DOUBLE, 4) AS p FROM bars)""", BARS)

# ---------------------------------------------------------------- joins, aggregates, sorts

add("join_fact_asset", "SELECT symbol, date, close, name, sector FROM bars JOIN assets USING (symbol)", BARS, ASSETS)
add("dim_unknown_symbols", "SELECT DISTINCT symbol FROM bars WHERE symbol NOT IN (SELECT symbol FROM assets)", BARS, ASSETS)
add("dim_symbols", "SELECT symbol FROM assets ORDER BY symbol", ASSETS)
add("agg_last_date", "SELECT symbol, max(date) AS last_date FROM bars GROUP BY 1", BRAND)
COVERAGE = "SELECT symbol, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date FROM {} GROUP BY 1"
add("agg_feature_coverage", COVERAGE.format("gold SEMI JOIN assets USING (symbol)"), *GOLD_OF_BARS, ASSETS)
CELLS = "(open IS NULL)::INT + (high IS NULL)::INT + (low IS NULL)::INT + (close IS NULL)::INT + (volume IS NULL)::INT"
FILLED_BOTH = "both_ways AS (SELECT symbol, date, " + ", ".join(
    f"coalesce({_ffill(c)}, {_bfill(c)}) AS {c}" for c in ("open", "high", "low", "close", "volume")) + " FROM last_raw)"
add("null_audit", f"""SELECT symbol, CAST(b AS BIGINT) AS missing_before, CAST(a AS BIGINT) AS missing_after
  FROM (SELECT symbol, sum({CELLS}) AS b FROM raw GROUP BY 1) JOIN (SELECT symbol, sum({CELLS}) AS a FROM both_ways GROUP BY 1)
  USING (symbol)""", DIRTY, LAST, FILLED_BOTH)
add("features_pivot", f"""SELECT symbol, date, {cols(*GOLD_FEATURES)} FROM (SELECT * REPLACE (
  CASE WHEN day(date) = 1 THEN 2 * sma_5 ELSE sma_5 END AS sma_5) FROM gold)""", *GOLD_OF_BARS)
add("latest_prices", """SELECT symbol, name, date, close, volume, round(return_simple, 6) AS daily_return
  FROM silver JOIN assets USING (symbol) QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1""",
    DIRTY, LAST, SILVER, ASSETS)
GOLD_OUT = "symbol, date, " + cols(*GOLD_COLUMNS)
add("latest_features", f"""SELECT {GOLD_OUT} FROM gold
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1""", *GOLD_OF_BARS)

# ---------------------------------------------------------------- windows and indicators


def feature_query(name: str, *columns: str, source: str = BARS) -> None:
    add(name, f"SELECT symbol, date, {cols(*columns)} FROM feat", source, features())


feature_query("feat_lags", *(f"{c}_lag_{k}" for c in ("close", "volume", "return") for k in LAGS))
feature_query("feat_target", "target_direction_5d", "future_return_5d")
feature_query("feat_returns", "return_1d", "return_5d", "return_21d", "log_return_1d", "log_return_5d")
feature_query("feat_sma", "sma_5", "sma_10", "sma_20", "sma_21", "sma_63")
feature_query("feat_rolling_stats", *(f"{p}_{n}" for n in WINDOWS for p in (
    "std", "zscore", "rolling_min", "rolling_max", "range_position")))
feature_query("feat_volume", *(f"{p}_{n}" for n in WINDOWS for p in ("volume_sma", "volume_ratio")))
add("feat_ema", f"SELECT symbol, date, {cols('ema_12', 'ema_26')} FROM averages", BARS, averages())
add("feat_macd", f"SELECT symbol, date, {cols('macd', 'macd_signal', 'macd_histogram')} FROM averages", BARS, averages())
feature_query("feat_obv", "obv", source=BRAND)
feature_query("feat_rsi", "rsi_14", "rsi_7")
feature_query("feat_bollinger", "bb_upper", "bb_lower", "bb_width", "bb_position")
feature_query("feat_atr", "atr_14")
feature_query("feat_volatility", "volatility_21d", "volatility_63d")
feature_query("feat_gk_vol", "gk_volatility", "intraday_range")
add("gold_features", f"SELECT {GOLD_OUT} FROM wide", *GOLD_OF_BARS)
add("gold_warm_rows", f"SELECT symbol, date, {cols('sma_63', 'volatility_63d', 'rsi_14')} FROM gold", *GOLD_OF_BARS)
ENGINEERED = [c for c in engineered_columns() if c not in ("target", "future_return")]
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in (*ENGINEERED, "ahead_5"))
add("engineered_features", f"""SELECT symbol, date, {cols(*ENGINEERED)}, round(future_return_5d, 6) AS future_return,
  target_direction_5d AS target FROM wide WHERE {COMPLETE}""", BARS, averages(), features(), ALL_FEATURES)
add("features_complete_rows", COVERAGE.format(f"wide WHERE {COMPLETE}"), BRAND, averages(), features(), ALL_FEATURES)

# ---------------------------------------------------------------- cleaning

add("drop_all_null_prices", f"""SELECT {ALL_BAR}, batch_id FROM raw
  WHERE open IS NOT NULL OR high IS NOT NULL OR low IS NOT NULL OR close IS NOT NULL""", DIRTY)
add("clean_dedup_last", f"SELECT {ALL_BAR}, batch_id FROM last_raw", DIRTY, LAST)
add("clean_quality_score", "SELECT symbol, date, CAST(quality_score AS DOUBLE) AS quality_score, is_imputed FROM silver", DIRTY, LAST, SILVER)
FORWARD = "forward AS (SELECT symbol, date, " + ", ".join(
    f"{_ffill(c)} AS {c}" for c in ("open", "high", "low", "close")) + ", coalesce(volume, 0) AS volume FROM last_raw)"
add("clean_ffill", f"SELECT symbol, date, {OHLC}, volume FROM forward", DIRTY, LAST, FORWARD)
add("clean_ffill_bfill", f"SELECT symbol, date, {OHLC}, volume FROM both_ways", DIRTY, LAST, FILLED_BOTH)


def _interpolated(c: str) -> str:
    known = f"CASE WHEN {c} IS NOT NULL THEN date END"
    left, right, d0, d1 = _ffill(c), _bfill(c), _ffill(known), _bfill(known)
    return (f"coalesce({c}, {left} + ({right} - {left}) * ((date - {d0})::DOUBLE / nullif({d1} - {d0}, 0)), "
            f"{left}, {right})::DOUBLE AS {c}")


add("clean_interpolate", f"SELECT symbol, date, {OHLC}, round(volume, 6) AS volume FROM between_known", DIRTY, LAST,
    "between_known AS (SELECT symbol, date, " + ", ".join(
        _interpolated(c) for c in ("open", "high", "low", "close", "volume")) + " FROM last_raw)")
add("clean_drop", f"""SELECT symbol, date, {OHLC}, volume FROM last_raw WHERE open IS NOT NULL AND high IS NOT NULL
  AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL""", DIRTY, LAST)
add("clean_ohlc_swap", f"""SELECT symbol, date, {cols("greatest(high, low) AS high", "least(high, low) AS low")} FROM forward""",
    DIRTY, LAST, FORWARD)
add("clean_outliers_4sd", f"""SELECT symbol, date, {cols("close", "return_simple", "return_log")} FROM moves
  JOIN (SELECT symbol, avg(return_simple) AS m, stddev_samp(return_simple) AS s FROM moves GROUP BY 1) USING (symbol)
  WHERE return_simple IS NULL OR return_simple BETWEEN m - 4 * s AND m + 4 * s""", BRAND,
    """moves AS MATERIALIZED (SELECT symbol, date, close, close / lag(close) OVER w - 1 AS return_simple,
  ln(close / lag(close) OVER w) AS return_log FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date))""")
add("silver_prices", f"SELECT {SILVER_OUT} FROM silver", DIRTY, LAST, SILVER)
add("assert_clean", """SELECT symbol, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(a) AS BIGINT) AS null_close,
  CAST(sum(b) AS BIGINT) AS non_positive_close, CAST(sum(n - 1) AS BIGINT) AS repeated_days FROM (
  SELECT symbol, date, count(*) AS n, count(*) FILTER (close IS NULL) AS a, count(*) FILTER (close <= 0) AS b FROM (
    SELECT symbol, date, close FROM negative UNION ALL SELECT symbol, date, close FROM bars)
  GROUP BY 1, 2) GROUP BY 1""", BARS, CHECKS)

# ---------------------------------------------------------------- data quality

add("dq_checks", "SELECT * FROM checks", BARS, CHECKS)
add("dq_totals", "SELECT count(*) AS total_checks, count(*) FILTER (NOT passed) AS failed FROM checks", BARS, CHECKS)
add("dq_extended", f"""SELECT symbol, count(*) FILTER (NOT close BETWEEN low AND high) AS close_outside_range,
  count(*) FILTER (volume < 0) AS negative_volume, any_value(lag) AS lag_business_days, any_value(lag) <= 5 AS is_recent
  FROM negative JOIN (SELECT symbol, len(list_filter(list_transform(range(1, CAST(DATE '{AS_OF}' - max(date) AS BIGINT) + 1),
    lambda i: max(date) + i::INTEGER), lambda x: isodow(x) < 6))::BIGINT AS lag FROM negative GROUP BY 1) USING (symbol) GROUP BY 1""",
    BARS, CHECKS)
add("dq_missing_symbols", "SELECT DISTINCT symbol FROM raw WHERE symbol = '5-LOW'", DIRTY)

# ---------------------------------------------------------------- keyed writes and increments

STORED = f"""stored AS (SELECT symbol, date, source, close, volume, batch_id, delivery FROM raw
  WHERE delivery = 1 AND date < DATE '{CUTOFF}'),
batch AS (SELECT symbol, date, source, close, volume, batch_id, delivery FROM raw
  WHERE delivery = 2 OR date >= DATE '{RANGE[1]}')"""
DELIVERED = "symbol, date, source, close, volume"
add("upsert_insert_ignore", f"""SELECT {DELIVERED}, batch_id FROM stored UNION ALL
  SELECT {DELIVERED}, batch_id FROM (SELECT * FROM batch
    QUALIFY row_number() OVER (PARTITION BY symbol, date, source ORDER BY delivery) = 1)
  ANTI JOIN stored USING (symbol, date, source)""", DIRTY, STORED)
add("upsert_replace", f"""SELECT coalesce(b.symbol, s.symbol) AS symbol, coalesce(b.date, s.date) AS date,
  CASE WHEN b.symbol IS NULL THEN s.source ELSE b.source END AS source,
  CASE WHEN b.symbol IS NULL THEN s.close ELSE b.close END AS close,
  CASE WHEN b.symbol IS NULL THEN s.volume ELSE b.volume END AS volume,
  CASE WHEN s.symbol IS NULL THEN b.batch_id ELSE s.batch_id END AS batch_id
  FROM stored s FULL OUTER JOIN (SELECT * FROM batch
    QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY delivery DESC) = 1) b
  ON s.symbol = b.symbol AND s.date = b.date""", DIRTY, STORED)
add("upsert_feature_values", f"""SELECT coalesce(b.symbol, s.symbol) AS symbol, coalesce(b.date, s.date) AS date,
  coalesce(b.name, s.name) AS feature_name, round(coalesce(b.v, s.v), 6) AS feature_value
  FROM (UNPIVOT (SELECT symbol, date, open, high, low, close, volume::DOUBLE AS volume FROM bars WHERE date < DATE '{CUTOFF}')
        ON open, high, low, close, volume INTO NAME name VALUE v) s
  FULL OUTER JOIN (UNPIVOT (SELECT symbol, date, low, close * 2 AS close FROM bars WHERE date >= DATE '{RANGE[1]}')
        ON low, close INTO NAME name VALUE v) b
  ON s.symbol = b.symbol AND s.date = b.date AND s.name = b.name""", BARS)
add("upsert_asset_coalesce", """SELECT b.symbol, coalesce(CASE WHEN g % 2 = 1 THEN 'New ' || b.symbol END, a.name) AS name,
  coalesce(CASE WHEN g > 3 THEN 'retail' END, a.sector) AS sector, coalesce(a.currency, 'USD') AS currency
  FROM (SELECT DISTINCT symbol, CAST(substr(symbol, 1, 1) AS INTEGER) AS g FROM bars) b LEFT JOIN assets a USING (symbol)""",
    BARS, ASSETS)
add("upsert_touch", f"""SELECT symbol, date, CASE WHEN date < DATE '{CUTOFF}' THEN close ELSE close + 1 END AS close,
  CASE WHEN date >= DATE '{RANGE[1]}' THEN DATE '{AS_OF}' ELSE DATE '{CUTOFF}' END AS computed_at FROM bars""", BARS)
add("incr_bronze_after_silver", f"SELECT {SILVER_OUT} FROM silver WHERE symbol = '5-LOW' OR date > (SELECT max(date) FROM silver s "
    f"WHERE s.symbol = silver.symbol AND s.date < DATE '{CUTOFF}')", DIRTY, LAST, SILVER)
add("incr_gold", f"""SELECT {GOLD_OUT} FROM gold LEFT JOIN (SELECT symbol, min(date) AS since FROM (
    SELECT symbol, date FROM gold WHERE date < DATE '{CUTOFF}' AND symbol <> '5-LOW'
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 5) GROUP BY 1) USING (symbol)
  WHERE since IS NULL OR date >= since""", *GOLD_OF_BARS)
add("backfill_reload", f"""SELECT symbol, date, CASE WHEN symbol IN ('2-HIGH', '5-LOW') THEN close / 2 ELSE close END AS close
  FROM bars WHERE symbol NOT IN ('2-HIGH', '5-LOW') OR date >= DATE '{CUTOFF}'""", BARS)

# ---------------------------------------------------------------- model data

add("ml_feature_matrix", f"""SELECT symbol, date, {cols(*GOLD_FEATURES)}, target_direction_5d AS label FROM gold
  WHERE target_direction_5d IS NOT NULL""", *GOLD_OF_BARS)
MEDIANS = ", ".join(f"median({c}) AS m_{c}" for c in GOLD_FEATURES)
IMPUTED = ", ".join(
    cols(f"coalesce({c}, m_{c}) AS {c}") for c in GOLD_FEATURES)
add("ml_median_impute", f"""SELECT symbol, date, {IMPUTED} FROM known JOIN (SELECT symbol, {MEDIANS} FROM known GROUP BY 1)
  USING (symbol)""", BARS, averages(), features(), ALL_FEATURES, "known AS (SELECT * FROM wide WHERE target_direction_5d IS NOT NULL)")
add("ml_class_balance", """SELECT symbol, count(*) AS n_rows, round(avg(target_direction_5d), 6) AS positive_share FROM gold
  WHERE target_direction_5d IS NOT NULL GROUP BY 1""", *GOLD_OF_BARS)
PLAIN_FOLDS = FOLDS.format(labelled="SELECT symbol, date FROM bars")
add("wf_folds", "SELECT symbol, date, fold, role FROM folds", BARS, PLAIN_FOLDS)
add("wf_fold_sizes", """SELECT symbol, fold, CASE WHEN fold = 0 THEN 'too_short' ELSE 'ok' END AS status, count(*) AS row_total, count(*) FILTER (role = 'train') AS train_size,
  count(*) FILTER (role = 'test') AS test_size, max(date) FILTER (role = 'train') AS train_end,
  min(date) FILTER (role = 'test') AS test_start, max(date) FILTER (role = 'test') AS test_end FROM folds GROUP BY 1, 2""",
    BARS, PLAIN_FOLDS)
SCORE_COLS = cols(*SCORE_NAMES)
add("clf_metrics", f"SELECT symbol, fold, tp, fp, fn, tn, {SCORE_COLS} FROM scores", *MOMENTUM_SCORES)
SUMMED = ", ".join(f"avg({c}) AS {c}" for c in SCORE_NAMES)
FOLD_SUMMARY = f"""fold_summary AS (SELECT symbol, {SUMMED}, stddev_pop(accuracy) AS accuracy_std,
  count(*) FILTER (fold > 0) AS n_splits, max(n_train) AS n_train FROM scores GROUP BY 1)"""
add("wf_fold_summary", f"SELECT symbol, {SCORE_COLS}, round(accuracy_std, 6) AS accuracy_std, n_splits FROM fold_summary",
    *MOMENTUM_SCORES, FOLD_SUMMARY)
add("metrics_long", " UNION ALL ".join(
    f"""SELECT 'momentum_v1' AS model_version, DATE '{AS_OF}' AS trained_at, symbol, '{m}' AS metric_name,
  round({m}::DOUBLE, 6) AS metric_value, n_train, CAST(63 AS BIGINT) AS n_test,
  '{{"test_size":63,"n_splits":5}}' AS hyperparameters FROM fold_summary"""
    for m in (*SCORE_NAMES, "accuracy_std", "n_splits")), *MOMENTUM_SCORES, FOLD_SUMMARY)

# ---------------------------------------------------------------- drift

add("drift_histogram", "SELECT * FROM histogram", *GOLD_OF_BARS, SIDES, BINS)
add("drift_psi", "SELECT symbol, feature, n_ref, n_cur, round(psi, 6) AS psi, severity FROM psi", *GOLD_OF_BARS, SIDES, BINS, PSI)
add("drift_ks", """SELECT symbol, feature, n_ref, n_cur, round(ks_statistic, 6) AS ks_statistic,
  round(ks_p_value, 6) AS ks_p_value, ks_p_value < 0.05 AS ks_drift FROM ks""", *GOLD_OF_BARS, SIDES, KS)
add("drift_ks_stored", """SELECT symbol, feature, n_ref, n_cur, round(ks_statistic, 6) AS ks_statistic,
  round(ks_p_value, 6) AS ks_p_value, ks_p_value < 0.05 AS ks_drift FROM ks""", *GOLD_OF_BARS, SIDES, KS)
add("drift_report", "SELECT * FROM report", *DRIFT)
add("drift_summary", "SELECT * FROM drift_summary", *DRIFT)

# ---------------------------------------------------------------- monitoring

add("pred_outcomes", f"""SELECT symbol, prediction_date, target_date, model_version, predicted_direction,
  round(confidence, 6) AS confidence, actual_direction, round(actual_return, 6) AS actual_return, is_correct,
  DATE '{RUN_DATE}' AS evaluated_at FROM predictions WHERE ahead_date <= DATE '{RUN_DATE}'""", BARS, PREDICTIONS)
add("mon_accuracy", """SELECT symbol, CASE WHEN total_predictions > 0 THEN 'evaluated' ELSE 'no_matching_dates' END AS status,
  total_predictions, coalesce(round(hits / nullif(total_predictions, 0), 4), 0) AS accuracy,
  coalesce(round(sure_hits / nullif(high_confidence_count, 0), 4), 0) AS high_confidence_accuracy,
  high_confidence_count, period_start, period_end FROM (
  SELECT p.symbol, count(b.date) AS total_predictions, count(*) FILTER (b.date IS NOT NULL AND is_correct) AS hits,
    count(*) FILTER (b.date IS NOT NULL AND confidence > 0.7) AS high_confidence_count,
    count(*) FILTER (b.date IS NOT NULL AND confidence > 0.7 AND is_correct) AS sure_hits,
    min(b.date) AS period_start, max(b.date) AS period_end
  FROM predictions p LEFT JOIN bars b ON b.symbol = p.symbol AND b.date = p.target_date GROUP BY 1)""", BARS, PREDICTIONS)
add("mon_staleness", """SELECT symbol, model_age_days, is_stale, CASE WHEN is_stale THEN 'RETRAIN' ELSE 'OK' END AS recommendation
  FROM advice""", BARS, PREDICTIONS, MONITOR)
add("mon_recent20", "SELECT * FROM recent", BARS, PREDICTIONS, MONITOR)
add("mon_recommendation", "SELECT symbol, model_age_days, recent_accuracy, recommendation FROM advice", BARS, PREDICTIONS, MONITOR)
add("mon_rolling_accuracy", """SELECT symbol, prediction_date AS date, count(*) OVER w AS n_predictions,
  round(avg(is_correct::INT) OVER w, 6) AS rolling_accuracy FROM predictions WHERE actual_direction IS NOT NULL
  WINDOW w AS (PARTITION BY symbol ORDER BY prediction_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)""",
    BARS, PREDICTIONS)
add("perf_by_period", """SELECT symbol, 'momentum_v1' AS model_version, period_start, CAST(period_start + INTERVAL 3 MONTHS AS DATE) - 1 AS period_end, n_predictions,
  round(hits / n_predictions, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_score, round(hits / n_predictions, 6) AS directional_accuracy,
  round(m / nullif(s, 0) * sqrt(252 / 5), 6) AS sharpe_ratio, round(least(d, 0), 6) AS max_drawdown FROM (
  SELECT symbol, period_start, count(*) AS n_predictions, count(*) FILTER (is_correct) AS hits,
    count(*) FILTER (predicted_direction = 1 AND actual_direction = 1) AS tp,
    count(*) FILTER (predicted_direction = 1 AND actual_direction = 0) AS fp,
    count(*) FILTER (predicted_direction = 0 AND actual_direction = 1) AS fn,
    avg(gain) AS m, stddev_samp(gain) AS s, min(equity / greatest(peak, 1) - 1) AS d
  FROM (SELECT *, max(equity) OVER (PARTITION BY symbol, period_start ORDER BY prediction_date ROWS UNBOUNDED PRECEDING) AS peak
    FROM (SELECT *, CASE WHEN min(1 + gain) OVER v <= 0 THEN 0
          ELSE exp(sum(CASE WHEN gain > -1 THEN ln(1 + gain) END) OVER v) END AS equity
      FROM (SELECT *, CAST(date_trunc('quarter', prediction_date) AS DATE) AS period_start,
          CASE WHEN predicted_direction = 1 THEN actual_return ELSE -actual_return END AS gain
        FROM predictions WHERE actual_direction IS NOT NULL)
      WINDOW v AS (PARTITION BY symbol, period_start ORDER BY prediction_date ROWS UNBOUNDED PRECEDING)))
  GROUP BY 1, 2)""", BARS, PREDICTIONS)
add("mon_report", """SELECT symbol, model_age_days, is_stale, drifted_features > 0 AS drift_detected, drifted_features,
  total_features, recent_accuracy, a.recommendation FROM advice a JOIN drift_summary d USING (symbol)""",
    *DRIFT, PREDICTIONS, MONITOR)

# ---------------------------------------------------------------- dashboard and serving queries

add("bi_price_series", "SELECT symbol, date, close FROM bars SEMI JOIN assets USING (symbol) ORDER BY date, symbol",
    BARS, ASSETS)
add("bi_accuracy_latest", """SELECT symbol, trained_at, round(metric_value, 6) AS accuracy FROM trainings
  WHERE metric_name = 'accuracy' ORDER BY trained_at DESC, symbol LIMIT 3""", *MOMENTUM_SCORES, TRAININGS)
add("bi_latest_predictions", """SELECT symbol, prediction_date, target_date,
  CASE WHEN predicted_direction = 1 THEN 'UP' ELSE 'DOWN' END AS direction, round(confidence, 4) AS confidence, model_version
  FROM predictions SEMI JOIN assets USING (symbol) ORDER BY prediction_date DESC, symbol LIMIT 10""", BARS, PREDICTIONS, ASSETS)
add("bi_volatility_1y", f"""SELECT symbol, date, round(volatility_21d, 6) AS volatility_21d FROM gold SEMI JOIN assets USING (symbol)
  WHERE date > DATE '{AS_OF}' - INTERVAL 12 MONTHS""", *GOLD_OF_BARS, ASSETS)
add("bi_rsi_6m", f"""SELECT symbol, date, round(rsi_14, 4) AS rsi_14 FROM gold SEMI JOIN assets USING (symbol)
  WHERE date > DATE '{AS_OF}' - INTERVAL 6 MONTHS""", *GOLD_OF_BARS, ASSETS)
add("bi_layer_counts", """SELECT count(*) AS value, 'Bronze Rows' AS metric FROM raw UNION ALL
  SELECT count(*), 'Silver Rows' FROM silver UNION ALL SELECT count(*), 'Gold Feature Rows' FROM gold""", *GOLD_OF_SILVER)
add("bi_dq_latest", """SELECT symbol, check_name, passed, check_date, details FROM checks SEMI JOIN assets USING (symbol)
  ORDER BY check_date DESC, symbol, check_name LIMIT 10""", BARS, CHECKS, ASSETS)
add("bi_model_metrics", "SELECT symbol, " + ", ".join(
    f"round(arg_max(metric_value, trained_at) FILTER (metric_name = '{m}'), 6) AS {m}" for m in SCORE_NAMES)
    + """, arg_max(model_version, trained_at) AS model_version, arg_max(n_train, trained_at) AS n_train,
  max(trained_at) AS trained_at FROM trainings GROUP BY 1""", *MOMENTUM_SCORES, TRAININGS)
add("bi_prediction_history", """SELECT symbol, prediction_date, target_date, model_version, predicted_direction,
  round(confidence, 6) AS confidence, actual_direction, is_correct,
  CASE WHEN predicted_direction = 1 THEN 'UP' ELSE 'DOWN' END AS direction_label FROM predictions
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY prediction_date DESC) <= 10""", BARS, PREDICTIONS)
add("bi_price_ma", "SELECT symbol, date, close, round(sma_30, 4) AS moving_average FROM feat", BRAND, features())
add("bi_period_change", """SELECT symbol, round(a, 6) AS first_close, round(b, 6) AS last_close, round((b - a) / a * 100, 6) AS change_pct
  FROM (SELECT symbol, arg_min(close, date) AS a, arg_max(close, date) AS b FROM last_raw WHERE close IS NOT NULL GROUP BY 1)""",
    DIRTY, LAST)

# ---------------------------------------------------------------- streaming (batch SQL over the same rows)

add("stream_bronze_ingest", f"SELECT {ALL_BAR}, batch_id FROM last_raw", DIRTY, FIRST)
add("stream_silver_gold", f"SELECT {GOLD_OUT} FROM gold", DIRTY, FIRST, *GOLD_OF_SILVER[2:])
# ---------------------------------------------------------------- model runs: what does not hang on the learner

LABELLED = ("rows_known AS (SELECT symbol, date FROM wide WHERE target_direction_5d IS NOT NULL)",
            FOLDS.format(labelled="SELECT symbol, date FROM rows_known"))
MADE = """made AS (
  SELECT symbol, date, 'gbt_v1_fold_' || fold AS model_version FROM folds WHERE role = 'test'
  UNION ALL SELECT symbol, max(date), 'gbt_v1' FROM gold GROUP BY 1),
outcomes AS (SELECT symbol, date, lead(date, 5) OVER w AS ahead_date, lead(close, 5) OVER w / close - 1 AS ahead
             FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date))"""
add("run_model_predictions", f"""SELECT symbol, date AS prediction_date, date + 7 AS target_date, model_version,
  true AS confidence_of_choice, true AS hit_of_choice,
  CASE WHEN ahead_date <= DATE '{AS_OF}' THEN CAST(ahead > 0 AS INTEGER) END AS actual_direction,
  CASE WHEN ahead_date <= DATE '{AS_OF}' THEN round(ahead, 6) END AS actual_return
  FROM made JOIN outcomes USING (symbol, date)""", *GOLD_OF_BARS, *LABELLED, MADE)
add("run_model_metrics", """SELECT symbol, metric_name, n_train, CAST(63 AS BIGINT) AS n_test, true AS as_stored
  FROM (SELECT symbol, max(n) AS n_train FROM (SELECT symbol, fold, count(*) AS n FROM folds WHERE role = 'train' GROUP BY 1, 2) GROUP BY 1),
  (SELECT unnest(['accuracy', 'precision', 'recall', 'f1_score', 'directional_accuracy', 'accuracy_std', 'n_splits']) AS metric_name)""",
    *GOLD_OF_BARS, *LABELLED)
add("run_model_performance", f"""SELECT symbol, model_version, CAST(date_trunc('quarter', date) AS DATE) AS period_start,
  count(*) AS n_predictions FROM made JOIN outcomes USING (symbol, date) WHERE ahead_date <= DATE '{AS_OF}' GROUP BY 1, 2, 3""",
    *GOLD_OF_BARS, *LABELLED, MADE)

# ---------------------------------------------------------------- layer runs

RUN_ROWS = f"""deliveries AS (
  SELECT *, date >= DATE '{CUTOFF}' OR (7 * date_diff('day', DATE '1995-01-01', date)
            + CAST(substr(symbol, 1, 1) AS INTEGER)) % 31 = 0 AS second_run
  FROM raw QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY delivery) = 1),
aged AS (SELECT *, second_run AND date <= max(date) FILTER (NOT second_run) OVER (PARTITION BY symbol) - 7 AS is_late
         FROM deliveries),
last_raw AS (SELECT * FROM aged WHERE NOT is_late)"""
RUN_GOLD = (DIRTY, RUN_ROWS, *GOLD_OF_SILVER[2:])
add("run_layers_silver", f"""SELECT {SILVER_OUT}, CASE WHEN date >= changed THEN DATE '{CHECK_DATE}' ELSE DATE '{CUTOFF}' END
  AS processed_at FROM silver LEFT JOIN (SELECT symbol, min(date) AS changed FROM last_raw WHERE second_run GROUP BY 1) USING (symbol)""",
    DIRTY, RUN_ROWS, SILVER)
add("run_zone_map", """SELECT symbol, CAST(year(date) AS INTEGER) AS period, count(*) AS n, count(*) FILTER (close IS NULL) AS nulls,
  count(*) FILTER (high < low) AS inverted, count(*) FILTER (close < 0 OR open < 0) AS negatives,
  min(date) AS first_date, max(date) AS last_date FROM silver GROUP BY ALL""", DIRTY, RUN_ROWS, SILVER)
add("run_newest_dates", "SELECT symbol, max(date) AS last_date FROM last_raw GROUP BY 1", DIRTY, RUN_ROWS)
add("run_quality_checks", f"""SELECT symbol, DATE '{CHECK_DATE}' AS check_date, c.check_name, c.passed, c.details FROM (
    SELECT symbol, count(*) FILTER (close IS NULL) AS nulls, count(*) FILTER (high < low) AS inverted,
           count(*) FILTER (close < 0 OR open < 0) AS negatives, max(date) AS newest FROM silver GROUP BY 1),
  unnest([{{'check_name': 'completeness_no_null_close', 'passed': nulls = 0, 'details': '{{"null_count":' || nulls || '}}'}},
    {{'check_name': 'consistency_ohlc_integrity', 'passed': inverted = 0, 'details': '{{"invalid_rows":' || inverted || '}}'}},
    {{'check_name': 'validity_no_negative_prices', 'passed': negatives = 0, 'details': '{{"negative_count":' || negatives || '}}'}},
    {{'check_name': 'freshness_has_recent_data', 'passed': newest IS NOT NULL, 'details': '{{"max_date":"' || newest || '"}}'}}]) AS u(c)""",
    DIRTY, RUN_ROWS, SILVER)
add("run_layers_gold", f"SELECT {GOLD_OUT} FROM gold", *RUN_GOLD)
add("run_ingestion_log", """SELECT batch_id, symbol, min(date) AS start_date, max(date) AS end_date, count(*) AS rows_ingested,
  'success' AS status FROM aged GROUP BY batch_id, symbol, second_run
  UNION ALL SELECT DISTINCT batch_id, symbol, NULL::DATE, NULL::DATE, 0, 'success' FROM raw WHERE delivery = 2""", DIRTY, RUN_ROWS)
add("run_quarantine", f"SELECT {SILVER_OUT} FROM held", DIRTY, RUN_ROWS, SILVER, SILVER[SILVER.index("silver AS"):].replace(
    "silver AS", "held AS").replace("o IS NOT NULL AND h IS NOT NULL AND l IS NOT NULL AND c IS NOT NULL",
                                    "o IS NULL OR h IS NULL OR l IS NULL OR c IS NULL"))
add("run_backfill", f"SELECT {SILVER_OUT} FROM silver", DIRTY, f"""last_raw AS (
  SELECT * FROM raw WHERE symbol NOT IN ('2-HIGH', '5-LOW') OR date >= DATE '{CUTOFF}'
  QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY delivery) = 1)""", SILVER)
add("run_late", f"SELECT symbol, date, {OHLC}, round(adj_close, 6) AS adj_close, volume, source, batch_id FROM aged WHERE is_late",
    DIRTY, RUN_ROWS)
add("stream_bars_hourly", f"""SELECT symbol, bar_time, {OHLC}, volume FROM (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS bar_time, arg_min(value, tick) AS open, max(value) AS high,
    min(value) AS low, arg_max(value, tick) AS close, count(*) AS volume
  FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS tick FROM events) GROUP BY 1, 2)""")
add("stream_ema", f"SELECT symbol, date, {cols('ema_12', 'ema_26', 'obv')} FROM feat JOIN averages USING (symbol, date)",
    BARS, averages(), features())

# ---------------------------------------------------------------- a boosted model for each symbol and fold

PLAIN = ("close", "volume", "height", "body", "rise")


def _boosted(trees: int = 3, depth: int = 2, rate: float = 0.3, least: int = 20, bins: int = 16, l2: float = 1.0) -> str:
    """The learner of ``wf_each_symbol_nodes``, one step after the other: CTEs up to ``nodes`` and ``scored``."""
    places = range(1, len(PLAIN) + 1)
    out = [f"""labelled AS (
  SELECT *, lead(close, 5) OVER (PARTITION BY symbol ORDER BY date) AS later FROM bars),
matrix AS (
  SELECT symbol, date, (later > close)::INTEGER AS label,
         [close, volume::DOUBLE, high - low, close - open, close - low] AS x,
         row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS total
  FROM labelled WHERE later IS NOT NULL),
split AS MATERIALIZED (
  SELECT symbol, date, label, x, fold, pos >= total - (2 - fold) * 63 - 63 AS is_test
  FROM matrix, (VALUES (1), (2)) AS f(fold) WHERE total >= 189 AND pos < total - (2 - fold) * 63),
valued AS (
  SELECT symbol, fold, date, unnest(range(1, {len(PLAIN) + 1})) AS f, unnest(x) AS v FROM split WHERE NOT is_test),
ranked AS MATERIALIZED (
  SELECT symbol, fold, date, f, v, (rank() OVER (PARTITION BY symbol, fold, f ORDER BY v) - 1) * {bins}
         // count(*) OVER (PARTITION BY symbol, fold, f) AS bin
  FROM valued),
edges AS MATERIALIZED (SELECT symbol, fold, f, bin, min(v) AS low FROM ranked GROUP BY ALL),
start AS (
  SELECT symbol, fold, count(*) AS n, ln((sum(label) + 1) / (count(*) - sum(label) + 1)) AS value
  FROM split WHERE NOT is_test GROUP BY ALL),
binned AS (SELECT symbol, fold, date, list(bin ORDER BY f) AS b FROM ranked GROUP BY ALL),
s0 AS MATERIALIZED (
  SELECT symbol, fold, date, label, b, value AS m, 1 AS node
  FROM binned JOIN split USING (symbol, fold, date) JOIN start USING (symbol, fold))"""]
    state, splits, leaves = "s0", [], []
    for t in range(1, trees + 1):
        for level in range(depth):
            k = f"{t}_{level}"
            out.append(f"""h{k} AS (
  SELECT symbol, fold, node, f, bin, sum(p - label) AS g, sum(p * (1 - p)) AS h, count(*) AS n
  FROM (SELECT *, 1 / (1 + exp(-m)) AS p, unnest({list(places)}) AS f, unnest(b) AS bin FROM {state}) WHERE node >= {1 << level} GROUP BY ALL),
c{k} AS (
  SELECT symbol, fold, node, f, bin, sum(g) OVER l AS gl, sum(h) OVER l AS hl, sum(n) OVER l AS nl,
         sum(g) OVER a AS ga, sum(h) OVER a AS ha, sum(n) OVER a AS na
  FROM h{k} WINDOW l AS (PARTITION BY symbol, fold, node, f ORDER BY bin), a AS (PARTITION BY symbol, fold, node, f)),
b{k} AS MATERIALIZED (
  SELECT *, round(gl * gl / (hl + {l2}) + (ga - gl) * (ga - gl) / (ha - hl + {l2}) - ga * ga / (ha + {l2}), 9) AS gain
  FROM c{k} WHERE nl >= {least} AND na - nl >= {least} AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY symbol, fold, node ORDER BY gain DESC, f, bin) = 1),
s{k} AS MATERIALIZED (
  SELECT s.* EXCLUDE (node), CASE WHEN x.f IS NULL THEN s.node ELSE 2 * s.node + (s.b[x.f] > x.bin)::INTEGER END AS node
  FROM {state} s LEFT JOIN b{k} x USING (symbol, fold, node))""")
            state = f"s{k}"
            splits.append(f"SELECT symbol, fold, {t} AS tree, node, f, bin, gain, na AS n_rows, NULL::DOUBLE AS value FROM b{k}")
        out.append(f"""l{t} AS MATERIALIZED (
  SELECT symbol, fold, node, count(*) AS n, -{rate} * sum(p - label) / (sum(p * (1 - p)) + {l2}) AS value
  FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM {state}) GROUP BY ALL),
s{t} AS MATERIALIZED (
  SELECT s.* EXCLUDE (m, node), s.m + l.value AS m, 1 AS node FROM {state} s JOIN l{t} l USING (symbol, fold, node))""")
        state = f"s{t}"
        leaves.append(f"SELECT symbol, fold, {t} AS tree, node, NULL AS f, NULL AS bin, NULL::DOUBLE AS gain, n AS n_rows, value FROM l{t}")
    every = " UNION ALL ".join(
        ["SELECT symbol, fold, 0 AS tree, 1 AS node, NULL AS f, NULL AS bin, NULL::DOUBLE AS gain, n AS n_rows, value FROM start", *splits, *leaves])
    names = list(PLAIN)
    out.append(f"""nodes AS MATERIALIZED (
  SELECT symbol, fold::BIGINT AS fold, tree::BIGINT AS tree, node::BIGINT AS node, f, {names}[f] AS feature, gain, n_rows::BIGINT AS n_rows, value,
         (SELECT min(low) FROM edges e WHERE e.symbol = t.symbol AND e.fold = t.fold AND e.f = t.f AND e.bin > t.bin) AS threshold
  FROM ({every}) t)""")
    at, walk = "1", ""
    for level in range(depth):
        walk += f" LEFT JOIN nodes n{level} ON n{level}.symbol = r.symbol AND n{level}.fold = r.fold AND n{level}.tree = r.tree " \
                f"AND n{level}.node = {at} AND n{level}.f IS NOT NULL"
        at = f"CASE WHEN n{level}.f IS NULL THEN {at} ELSE 2 * {at} + (r.x[n{level}.f] >= n{level}.threshold)::INTEGER END"
    out.append(f"""scored AS MATERIALIZED (
  SELECT symbol, fold, date, label, 1 / (1 + exp(-sum(value))) AS p FROM (
    SELECT r.symbol, r.fold, r.date, r.label, leaf.value
    FROM (SELECT s.*, tree FROM split s, range({trees + 1}) AS t(tree) WHERE is_test) r{walk}
    JOIN nodes leaf ON leaf.symbol = r.symbol AND leaf.fold = r.fold AND leaf.tree = r.tree AND leaf.f IS NULL AND leaf.node = {at})
  GROUP BY ALL)""")
    return ", ".join(out)


BOOSTED = _boosted()
add("wf_each_symbol_nodes", """SELECT symbol, fold, tree, node, feature, round(threshold, 6) AS threshold, round(gain, 6) AS gain, n_rows,
  round(value, 6) AS value FROM nodes""", BARS, BOOSTED)
add("wf_each_symbol_scores", """SELECT symbol, fold::BIGINT AS fold, date, label, round(p, 6) AS probability_up, (p > 0.5)::INTEGER AS prediction
  FROM scored""", BARS, BOOSTED)
add("wf_each_symbol_metrics", """SELECT symbol, fold::BIGINT AS fold, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_score, round((tp + tn) / (tp + fp + fn + tn), 6) AS directional_accuracy
  FROM (SELECT symbol, fold, count(*) FILTER (p > 0.5 AND label = 1) AS tp, count(*) FILTER (p > 0.5 AND label = 0) AS fp,
    count(*) FILTER (p <= 0.5 AND label = 1) AS fn, count(*) FILTER (p <= 0.5 AND label = 0) AS tn FROM scored GROUP BY ALL)""", BARS, BOOSTED)
add("ml_split_importance", """SELECT * FROM (SELECT symbol, feature, count(*) AS importance FROM nodes WHERE feature IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY importance DESC, feature) <= 3""", BARS, BOOSTED)
