"""Plain SQL for each registered query, written from the definitions.

Sums are rounded to six digits on both sides, since the engines add in different
orders. ``r6`` also maps a rounded minus zero to zero.
"""

from __future__ import annotations

from barlab.functions.scalars import CONDITION_PATTERN
from barlab.params import FEATURE_COLUMNS
from checks.queries import CSL, DIGITS, EDA_NUMBERS, METRICS, MONEY, RATIOS, RESULT_NUMBERS, RULES

W = "PARTITION BY symbol ORDER BY bar_no"


def r6(expr: str, name: str | None = None) -> str:
    name = name or expr
    rounded = f"round({expr}, {DIGITS.get(name, 6)})"
    return f"CASE WHEN {rounded} = 0 THEN CAST(0 AS DOUBLE) ELSE {rounded} END AS {name}"


def r6s(*names: str) -> str:
    return ", ".join(r6(n) for n in names)


def roll(agg: str, expr: str, n: int) -> str:
    over = f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({expr}) {over} = {n} THEN {agg}({expr}) {over} END"


def lag(expr: str, k: int = 1) -> str:
    return f"lag({expr}, {k}) OVER ({W})"


def dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


BARS = """
lt AS (
  SELECT concat('S', CAST(l_suppkey % 10 AS VARCHAR)) AS symbol, l_shipdate AS ts, l_orderkey, l_linenumber,
         l_partkey, l_suppkey, l_quantity, CAST(round(l_discount * 100) AS BIGINT) - 5 AS step
  FROM lineitem),
lp AS (
  SELECT *,
    row_number() OVER (PARTITION BY symbol ORDER BY ts, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn,
    sum(step) OVER (PARTITION BY symbol ORDER BY ts, l_orderkey, l_linenumber, l_partkey, l_suppkey
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k
  FROM lt),
lq AS (SELECT *, (200 + abs((((5*k + 800) % 3200) + 3200) % 3200 - 1600)) / CAST(100 AS DOUBLE) AS px FROM lp),
bars AS (
  SELECT symbol, ts, min_by(px, rn) AS open, max(px) AS high, min(px) AS low, max_by(px, rn) AS close,
         sum(l_quantity) AS volume
  FROM lq GROUP BY symbol, ts)"""

# As many bars as 99 of 100 of the largest symbol.
ENOUGH = "(SELECT max(n) * 99 // 100 FROM (SELECT count(*) AS n FROM bars GROUP BY symbol))"
PANEL = BARS + """,
panel AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS bar_no,
         count(*) OVER (PARTITION BY symbol) AS n_bars
  FROM bars)"""


def steps_of(source: str, name: str) -> str:
    """One-bar moves, true range and directional moves of a bar table."""
    return f"""
{name}0 AS (SELECT *, {lag('close')} AS pc, {lag('high')} AS ph, {lag('low')} AS pl, {lag('close', 10)} AS c10
  FROM {source}),
{name} AS (SELECT *, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr, close - pc AS mv,
  CASE WHEN close - pc > 0 THEN close - pc ELSE 0 END AS up,
  CASE WHEN close - pc < 0 THEN pc - close ELSE 0 END AS dn,
  close / nullif(pc, 0) - 1 AS ret, (high + low + close) / 3 * volume AS tpv,
  CASE WHEN high - ph > pl - low AND high - ph > 0 THEN high - ph ELSE CAST(0 AS DOUBLE) END AS dmu,
  CASE WHEN pl - low > high - ph AND pl - low > 0 THEN pl - low ELSE CAST(0 AS DOUBLE) END AS dmd
  FROM {name}0)"""


STEPS = PANEL + "," + steps_of("panel", "st")


def ema_step(prev: str, x: str, span: int) -> str:
    return f"({prev} * {dbl((span - 1) / (span + 1))} + {x} * {dbl(2 / (span + 1))})"


EMAS = STEPS + f""",
em AS (
  SELECT symbol, bar_no, close AS e12, close AS e20, close AS e26, close AS e50, close - close AS line,
         close - close AS sig, dmu AS p, dmd AS m, CAST(NULL AS DOUBLE) AS adx
  FROM st WHERE bar_no = 0
  UNION ALL
  SELECT symbol, bar_no, e12, e20, e26, e50, e12 - e26, {ema_step('sig', '(e12 - e26)', 9)}, p, m,
    CASE WHEN p + m = 0 THEN adx WHEN adx IS NULL THEN abs(p - m) / (p + m)
         ELSE {ema_step('adx', '(abs(p - m) / (p + m))', 14)} END
  FROM (
    SELECT s.symbol, s.bar_no, {ema_step('e.e12', 's.close', 12)} AS e12, {ema_step('e.e20', 's.close', 20)} AS e20,
           {ema_step('e.e26', 's.close', 26)} AS e26, {ema_step('e.e50', 's.close', 50)} AS e50, e.sig, e.adx,
           {ema_step('e.p', 's.dmu', 14)} AS p, {ema_step('e.m', 's.dmd', 14)} AS m
    FROM em e JOIN st s ON s.symbol = e.symbol AND s.bar_no = e.bar_no + 1))"""

RSI = (
    "CASE WHEN {l} = 0 AND {g} > 0 THEN CAST(100 AS DOUBLE) WHEN {l} = 0 THEN NULL "
    "ELSE 100 - 100 / (1 + {g} / nullif({l}, 0)) END"
)


def dist(level: str, price: str = "close") -> str:
    return f"({price} - {level}) / nullif({level}, 0) * 100"


WIDE = EMAS + f""",
w1 AS (
  SELECT st.*, e12, e20, e26, e50, line, sig, adx FROM st JOIN em USING (symbol, bar_no)),
w2 AS (
  SELECT *, {roll('avg', 'up', 14)} AS gain, {roll('avg', 'dn', 14)} AS loss, {roll('avg', 'tr', 50)} AS atr50,
    {roll('sum', 'tpv', 20)} AS tpv20, {roll('sum', 'volume', 20)} AS v20, {roll('avg', 'volume', 20)} AS va20,
    {roll('sum', 'abs(mv)', 10)} AS path10, {roll('stddev_samp', 'ret', 20)} AS sd20,
    {roll('avg', 'close', 10)} AS sma10, {roll('avg', 'close', 20)} AS mid, {roll('stddev_samp', 'close', 20)} AS sd
  FROM w1),
wide AS (
  SELECT symbol, ts, bar_no, n_bars, open, high, low, close, volume,
    {RSI.format(l='loss', g='gain')} AS RSI_14, atr50 AS ATR_50, e20 AS EMA_20, e50 AS EMA_50,
    {dist('e20')} AS dist_ema20_pct, {dist('e50')} AS dist_ema50_pct,
    tpv20 / nullif(v20, 0) AS VWAP_20, {dist('(tpv20 / nullif(v20, 0))')} AS dist_vwap_pct,
    line AS MACD_line, sig AS MACD_signal, line - sig AS MACD_hist, volume / nullif(va20, 0) AS RVOL_20,
    (close - c10) / nullif(path10, 0) AS ER_Kaufman_10, (open - pc) / nullif(pc, 0) AS Gap_pct, adx * 100 AS ADX_14,
    (close / nullif(c10, 0) - 1) * 100 AS ROC_10, close / nullif(c10, 0) - 1 AS Momentum_10,
    sd20 * sqrt(CAST(252 AS DOUBLE)) AS Volatility_20, sma10 AS SMA_10,
    (close - (mid + 2 * sd)) / nullif(mid, 0) * 100 AS dist_bb_upper_pct,
    (close - (mid - 2 * sd)) / nullif(mid, 0) * 100 AS dist_bb_lower_pct,
    abs(close - open) AS Candle_Body, high - low AS Candle_Range, high - greatest(open, close) AS Upper_Wick,
    least(open, close) - low AS Lower_Wick
  FROM w2)"""

_filled = ", ".join(
    f"last_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
    for c in FEATURE_COLUMNS
)
_complete = " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLUMNS)
FEATURES = WIDE + f""",
fl AS (SELECT symbol, ts, bar_no, open, high, low, close, volume, {_filled} FROM wide),
feat AS (
  SELECT * REPLACE (row_number() OVER ({W}) - 1 AS bar_no), count(*) OVER (PARTITION BY symbol) AS n_bars
  FROM fl WHERE {_complete})"""


def q(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes.strip()}\n{body.strip()}"


def calendar(unit: str, to_last: str) -> str:
    """Bars per calendar unit, dated by its last day."""
    return f"""
SELECT symbol, CAST(date_trunc('{unit}', ts) + {to_last} AS TIMESTAMP) AS ts, min_by(open, ts) AS open, max(high) AS high,
  min(low) AS low, max_by(close, ts) AS close, sum(volume) AS volume
FROM bars GROUP BY symbol, date_trunc('{unit}', ts)"""


def indicator(select: str, ctes: str = STEPS, source: str = "st") -> str:
    return q(ctes, f"SELECT symbol, bar_no, {select} FROM {source}")


def from_wide(*names: str, **renamed: str) -> str:
    columns = [r6(n) for n in names] + [r6(old, new) for new, old in renamed.items()]
    return q(WIDE, f"SELECT symbol, bar_no, {', '.join(columns)} FROM wide")


# Resampling -------------------------------------------------------------------

def resampled(ctes: str, source: str, seconds: int) -> str:
    return f"""{ctes}
SELECT symbol, bin AS ts, min_by(open, ts) AS open, max(high) AS high, min(low) AS low, max_by(close, ts) AS close,
       sum(volume) AS volume
FROM (
  SELECT *, first_day + to_seconds(CAST(floor((epoch_us(ts) - epoch_us(first_day)) / 1000000 / {seconds}) AS BIGINT)
            * {seconds}) AS bin
  FROM (SELECT *, CAST(date_trunc('day', min(ts) OVER (PARTITION BY symbol)) AS TIMESTAMP) AS first_day FROM {source}))
GROUP BY symbol, bin"""


EVENT_BARS = """WITH ev AS (
  SELECT event_type AS symbol, ts, value AS open, value AS high, value AS low, value AS close,
         CAST(1 AS DOUBLE) AS volume FROM events)"""

# Calibration ------------------------------------------------------------------

CANDIDATES = STEPS + f""",
k0 AS (
  SELECT *, round({roll('avg', 'tr', 50)}, 8) AS atr,
    round((close - c10) / nullif({roll('sum', 'abs(mv)', 10)}, 0), 8) AS er,
    min(low) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING) AS low20
  FROM st),
tradable AS (SELECT * FROM k0 WHERE bar_no BETWEEN 50 AND n_bars - 21 AND close BETWEEN 1 AND 20),
cand AS (
  SELECT symbol, bar_no, CASE WHEN atr > 0 THEN (close - low20) / atr END AS coef
  FROM tradable WHERE er > {dbl(0.3)})"""


def sampled(source: str, n: int, seed: int) -> str:
    return f"""(SELECT *, row_number() OVER (
    PARTITION BY symbol ORDER BY md5(concat_ws(':', symbol, CAST(bar_no AS VARCHAR), '{seed}')), bar_no) AS rk
  FROM {source}) WHERE rk <= {n}"""


STOPS = CANDIDATES + f""",
kept AS (SELECT * FROM {sampled('cand', 500, 42)} AND coef > 0),
stops AS (
  SELECT symbol, coalesce(nc, 0) AS n_candidates, coalesce(nk, 0) AS n_kept,
         CASE WHEN nc >= 30 AND nk >= 30 THEN med END AS csl_median,
         CASE WHEN nc >= 30 AND nk >= 30 AND med BETWEEN 1.5 AND 3.0 THEN med END AS csl
  FROM (SELECT DISTINCT symbol FROM panel)
  LEFT JOIN (SELECT symbol, count(*) AS nc FROM cand GROUP BY symbol) USING (symbol)
  LEFT JOIN (SELECT symbol, count(*) AS nk, median(coef) AS med FROM kept GROUP BY symbol) USING (symbol))"""


def power(csl_table: str) -> str:
    return f"""
bp AS (
  SELECT symbol, median(v) AS bp_median, max(v) AS bp_max, count(*) AS n_samples
  FROM (SELECT s.symbol, s.close * (100 / (c.csl * s.atr)) AS v
        FROM (SELECT * FROM {sampled('tradable', 500, 7)} AND atr > 0) s JOIN {csl_table} c ON c.symbol = s.symbol
        WHERE c.csl IS NOT NULL)
  GROUP BY symbol)"""


BP_OK = "coalesce(bp_median BETWEEN 100 AND 1800 AND bp_max <= 3000, false)"
CALIBRATION = STOPS + "," + power("stops") + f""",
calib AS (
  SELECT symbol, CASE WHEN big THEN csl END AS csl, CASE WHEN big THEN bp_median END AS bp_median,
         CASE WHEN big THEN bp_max END AS bp_max,
         CASE WHEN big AND csl IS NOT NULL THEN coalesce(n_samples, 0) END AS n_samples,
         big AND csl IS NOT NULL AND {BP_OK} AS admitted,
         CASE WHEN NOT big THEN 'insufficient_data' WHEN csl IS NULL THEN 'csl_rejected'
              WHEN NOT {BP_OK} THEN 'bp_rejected' END AS error
  FROM (SELECT symbol, count(*) >= {ENOUGH} AS big FROM bars GROUP BY symbol)
  LEFT JOIN stops USING (symbol) LEFT JOIN bp USING (symbol))"""

# The same calibration on the feature frame: true range and ER start anew.
FEATURE_STOPS = FEATURES + "," + steps_of("(SELECT symbol, ts, bar_no, n_bars, open, high, low, close, volume FROM feat)", "sf") + f""",
k0 AS (
  SELECT *, round({roll('avg', 'tr', 50)}, 8) AS atr,
    round((close - c10) / nullif({roll('sum', 'abs(mv)', 10)}, 0), 8) AS er,
    min(low) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING) AS low20
  FROM sf),
cand AS (
  SELECT symbol, bar_no, CASE WHEN atr > 0 THEN (close - low20) / atr END AS coef
  FROM k0 WHERE bar_no BETWEEN 50 AND n_bars - 21 AND close BETWEEN 1 AND 20 AND er > {dbl(0.3)}),
kept AS (SELECT * FROM {sampled('cand', 500, 42)} AND coef > 0),
stops AS (
  SELECT symbol, CASE WHEN nc >= 30 AND nk >= 30 AND med BETWEEN 1.5 AND 3.0 THEN med END AS csl
  FROM (SELECT symbol, count(*) AS nc FROM cand GROUP BY symbol)
  JOIN (SELECT symbol, count(*) AS nk, median(coef) AS med FROM kept GROUP BY symbol) USING (symbol))"""


# First touch ------------------------------------------------------------------

def touches(entries: str, bars: int, source: str = "feat") -> str:
    """First stop and target bar within ``bars`` bars of ``entries(symbol, bar_no, sl, tp)``."""
    return f"""
touch AS (
  SELECT e.symbol, e.bar_no,
         min(CASE WHEN b.low <= e.sl THEN b.bar_no END) AS sb, min(CASE WHEN b.high >= e.tp THEN b.bar_no END) AS tb
  FROM {entries} e
  LEFT JOIN {source} b ON b.symbol = e.symbol AND b.bar_no > e.bar_no AND b.bar_no <= e.bar_no + {bars}
  GROUP BY e.symbol, e.bar_no)"""


def label_ctes(base: str, csl: str, where: str = "true", join: str = "") -> str:
    return base + f""",
ent AS (
  SELECT symbol, bar_no, close - round(ATR_50, 8) * {csl} AS sl, close + round(ATR_50, 8) * ({csl} * 1.5) AS tp
  FROM feat {join}
  WHERE bar_no <= n_bars - 42 AND ATR_50 > 0 AND close BETWEEN 1 AND 20 AND {where}),""" + touches("ent", 40) + """,
lab AS (
  SELECT symbol, bar_no, CASE WHEN sb <= coalesce(tb, sb) THEN 0 WHEN tb IS NOT NULL THEN 1 ELSE 2 END AS label
  FROM touch)"""


LABELS = label_ctes(FEATURES, dbl(CSL))
OWN_LABELS = label_ctes(FEATURE_STOPS, "csl", "csl IS NOT NULL AND ER_Kaufman_10 > 0.30071", "JOIN stops USING (symbol)")

# Rules ------------------------------------------------------------------------

_hits = " UNION ALL ".join(
    f"SELECT symbol, bar_no, {r.rule_id} AS rule_id FROM feat WHERE "
    + " AND ".join(f"{f} {op} {dbl(t)}" for f, op, t in r.conditions)
    for r in RULES
)
HITS = f"hits AS ({_hits})"

RULE_TEXTS = PANEL + """,
texts AS (
  SELECT CAST(CAST(substr(symbol, 2) AS INTEGER) * 100 + y - 1990 AS INTEGER) AS rule_id,
    [ 'VWAP_20 <= ' || printf('%.3f', floor(m) + CAST(0.25 AS DOUBLE)), 'VWAP_20 <= ' || printf('%.3f', top),
      'VWAP_20 > 2.500', CASE WHEN y % 3 = 0 THEN 'close above the cloud' ELSE 'RSI_14 > 55' END,
      'ATR_50>=-0.5' ] AS conditions
  FROM (SELECT symbol, year(ts) AS y, avg(close) AS m, max(high) AS top FROM panel GROUP BY symbol, year(ts))),
cond AS (
  SELECT rule_id, CAST(pos - 1 AS INTEGER) AS pos, text,
    nullif(regexp_extract(text, '""" + CONDITION_PATTERN + """', 1), '') AS feature,
    nullif(regexp_extract(text, '""" + CONDITION_PATTERN + """', 2), '') AS op,
    TRY_CAST(regexp_extract(text, '""" + CONDITION_PATTERN + """', 3) AS DOUBLE) AS threshold
  FROM (SELECT rule_id, unnest(conditions) AS text, unnest(range(1, 6)) AS pos FROM texts))"""


# Trades -----------------------------------------------------------------------

def exit_ctes(signals: str, csl: str, tp: str, join: str = "", where: str = "true") -> str:
    """Exit of every entry one bar after a row of ``signals(symbol, bar_no)``."""
    return f"""
sized AS (
  SELECT f.symbol, f.bar_no, f.ts, f.n_bars, f.open, f.open - a.atr * {csl} AS sl, f.open + a.atr * {tp} AS tp,
         CAST(floor(100 / ({csl} * a.atr)) AS BIGINT) AS size
  FROM feat f JOIN (SELECT symbol, bar_no, round(ATR_50, 8) AS atr FROM feat) a
    ON a.symbol = f.symbol AND a.bar_no = f.bar_no - 1
  {join}
  WHERE a.atr > 0 AND {where}
    AND EXISTS (SELECT 1 FROM {signals} h WHERE h.symbol = f.symbol AND h.bar_no = f.bar_no - 1)),
ent AS (SELECT * FROM sized WHERE size > 0),""" + touches("ent", 40) + """,
ex0 AS (
  SELECT e.*, t.sb, t.tb,
    CASE WHEN t.sb IS NOT NULL OR t.tb IS NOT NULL THEN least(t.sb, t.tb)
         WHEN e.bar_no + 40 < e.n_bars THEN e.bar_no + 40 END AS xb
  FROM ent e JOIN touch t ON t.symbol = e.symbol AND t.bar_no = e.bar_no),
ex1 AS (
  SELECT e.symbol, e.bar_no, min(b.low) AS lo, max(b.high) AS hi
  FROM ex0 e JOIN feat b ON b.symbol = e.symbol AND b.bar_no > e.bar_no AND b.bar_no <= coalesce(e.xb, e.bar_no + 1)
  GROUP BY e.symbol, e.bar_no),
exits AS (
  SELECT e.symbol, e.bar_no AS entry_bar, e.xb AS exit_bar, e.ts AS entry_ts, x.ts AS exit_ts, e.open AS price_in,
    CASE WHEN e.sb <= coalesce(e.tb, e.sb) THEN e.sl WHEN e.tb IS NOT NULL THEN e.tp ELSE x.close END AS price_out,
    (CASE WHEN e.sb <= coalesce(e.tb, e.sb) THEN e.sl WHEN e.tb IS NOT NULL THEN e.tp ELSE x.close END - e.open)
      * e.size AS pnl,
    CASE WHEN e.sb <= coalesce(e.tb, e.sb) THEN 'SL' WHEN e.tb IS NOT NULL THEN 'TP'
         WHEN e.xb IS NOT NULL THEN 'Time Exit' END AS reason,
    e.open - least(e.open, r.lo) AS mae, greatest(e.open, r.hi) - e.open AS mfe,
    CAST(e.xb - e.bar_no AS INTEGER) AS bars_held, e.size, e.sl AS stop, e.tp AS target
  FROM ex0 e LEFT JOIN ex1 r ON r.symbol = e.symbol AND r.bar_no = e.bar_no
  LEFT JOIN feat x ON x.symbol = e.symbol AND x.bar_no = e.xb)"""


def chain_ctes(signals: str) -> str:
    """Non-overlapping entries of each rule: from each trade to the first entry after its exit."""
    return f"""
rc AS (
  SELECT DISTINCT h.rule_id, x.symbol, x.entry_bar AS e, x.exit_bar AS x
  FROM {signals} h JOIN exits x ON x.symbol = h.symbol AND x.entry_bar = h.bar_no + 1),
nx AS (
  SELECT c.rule_id, c.symbol, c.e, c.x, n.e AS nxt
  FROM rc c ASOF LEFT JOIN rc n ON n.symbol = c.symbol AND n.rule_id = c.rule_id AND c.x < n.e),
chain AS (
  SELECT rule_id, symbol, e, x, nxt FROM nx
  WHERE e = (SELECT min(e) FROM rc r WHERE r.rule_id = nx.rule_id AND r.symbol = nx.symbol)
  UNION ALL
  SELECT n.rule_id, n.symbol, n.e, n.x, n.nxt
  FROM chain c JOIN nx n ON n.rule_id = c.rule_id AND n.symbol = c.symbol AND n.e = c.nxt),
trades AS (
  SELECT c.rule_id, x.* FROM chain c JOIN exits x ON x.symbol = c.symbol AND x.entry_bar = c.e
  WHERE c.x IS NOT NULL)"""


EXITS = FEATURES + "," + HITS + "," + exit_ctes("hits", dbl(CSL), dbl(CSL * 1.5))
TRADES = EXITS + "," + chain_ctes("hits")
OWN_TRADES = (
    FEATURE_STOPS + "," + HITS + ","
    + exit_ctes("hits", "c.csl", "(c.csl * 1.5)", "JOIN stops c ON c.symbol = f.symbol", "c.csl IS NOT NULL")
    + "," + chain_ctes("hits")
)

P = "PARTITION BY symbol, rule_id ORDER BY entry_bar"


def metric_ctes(trades: str = "trades", name: str = "perf") -> str:
    return f"""
{name}0 AS (
  SELECT *, row_number() OVER ({P}) AS trade_no,
         sum(pnl) OVER ({P} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pnl FROM {trades}),
{name}1 AS (
  SELECT *, max(cum_pnl + 10000) OVER ({P} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak FROM {name}0),
{name}2 AS (SELECT *, (cum_pnl + 10000 - peak) / peak * 100 AS drawdown_pct FROM {name}1),
{name}3 AS (
  SELECT symbol, rule_id, count(*) AS n_trades, avg(CASE WHEN pnl > 0 THEN 1 ELSE 0 END) AS win_rate,
    coalesce(avg(pnl) FILTER (pnl > 0), 0) AS avg_win, coalesce(avg(pnl) FILTER (pnl <= 0), 0) AS avg_loss,
    coalesce(sum(pnl) FILTER (pnl > 0), 0) AS won, coalesce(sum(pnl) FILTER (pnl <= 0), 0) AS lost,
    min(drawdown_pct) AS max_drawdown_pct, avg(pnl / 10000) AS mean, stddev_samp(pnl / 10000) AS sd,
    sum(pnl) AS total_pnl, covar_pop(CAST(trade_no AS DOUBLE), cum_pnl) AS cv,
    stddev_pop(CAST(trade_no AS DOUBLE)) * stddev_pop(cum_pnl) AS sp
  FROM {name}2 GROUP BY symbol, rule_id),
{name} AS (
  SELECT symbol, rule_id, n_trades, win_rate,
    CASE WHEN lost = 0 THEN CAST('inf' AS DOUBLE) ELSE won / abs(lost) END AS profit_factor,
    win_rate * avg_win + (1 - win_rate) * avg_loss AS expectancy, avg_win, avg_loss, max_drawdown_pct,
    CASE WHEN sd > 0 THEN mean / sd * sqrt(CAST(252 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END AS sharpe, total_pnl,
    total_pnl / 10000 * 100 AS return_pct, total_pnl + 10000 AS final_capital,
    CASE WHEN n_trades > 1 THEN cv / nullif(sp, 0) ELSE CAST(0 AS DOUBLE) END AS corr_trade_vs_pnl
  FROM {name}3)"""


PERFORMANCE = TRADES + "," + metric_ctes()
_zeroed = ", ".join(f"coalesce({c}, 0) AS {c}" for c in RESULT_NUMBERS[:-1])
RESULTS = OWN_TRADES + "," + metric_ctes() + f""",
res AS (
  SELECT s.symbol, s.rule_id, c.csl, s.n_signals, coalesce(n_trades, 0) AS n_trades, {_zeroed},
         CASE WHEN n_trades IS NULL THEN CAST(0 AS DOUBLE) ELSE corr_trade_vs_pnl END AS corr_trade_vs_pnl
  FROM (SELECT symbol, rule_id, count(*) AS n_signals FROM hits GROUP BY symbol, rule_id) s
  JOIN stops c ON c.symbol = s.symbol AND c.csl IS NOT NULL
  LEFT JOIN perf p ON p.symbol = s.symbol AND p.rule_id = s.rule_id),
flags AS (
  SELECT *, coalesce(total_pnl > 0 AND corr_trade_vs_pnl > 0.3 AND max_drawdown_pct > -35, false) AS strict,
         coalesce(total_pnl > 0 AND corr_trade_vs_pnl > 0.1, false) AS loose FROM res),
sel AS (SELECT * FROM flags WHERE CASE WHEN (SELECT bool_or(strict) FROM flags) THEN strict ELSE loose END)"""

_long = " UNION ALL ".join(
    f"SELECT symbol, '{c}' AS feature, {c} AS value FROM feat" for c in ["close", *FEATURE_COLUMNS]
)

EDA = FEATURE_STOPS + f""",
eda AS (
  SELECT symbol, count(*) AS n_bars, CAST(min(ts) AS DATE) AS first_day, CAST(max(ts) AS DATE) AS last_day,
    avg(close) AS price_mean, stddev_samp(close) AS price_std, avg(a50) AS atr_mean, stddev_samp(a50) AS atr_std,
    avg(er0) AS er_mean, stddev_samp(er0) AS er_std,
    avg(CASE WHEN round(er0, 8) > {dbl(0.3)} THEN 1 ELSE 0 END) AS er_above_thresh_pct
  FROM (SELECT k.symbol, k.ts, k.close, f.ATR_50 AS a50, k.bar_no,
          (k.close - k.c10) / nullif(k.path, 0) AS er0
        FROM (SELECT *, {roll('sum', 'abs(mv)', 10)} AS path FROM sf) k JOIN feat f USING (symbol, bar_no))
  GROUP BY symbol)"""

SPLIT = LABELS + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_no) - 1 AS row_no,
                  count(*) OVER (PARTITION BY symbol) AS n_rows FROM lab)"""

METRIC_COLUMNS = r6s(*METRICS)

ORACLES: dict[str, str] = {
    "bars": q(BARS, "SELECT symbol, ts, open, high, low, close, volume FROM bars"),
    "panel": q(PANEL, "SELECT symbol, ts, bar_no, n_bars, close FROM panel"),
    "resample_week": resampled(f"WITH {BARS.strip()}", "bars", 7 * 86_400),
    "resample_hour": resampled(EVENT_BARS, "ev", 3_600),
    "resample_seven_hours": resampled(EVENT_BARS, "ev", 7 * 3_600),
    "quality": q(BARS, f"SELECT symbol, count(*) AS n_bars, count(*) >= {ENOUGH} AS ok FROM bars GROUP BY symbol"),
    "good_bars": q(PANEL, f"SELECT symbol, ts, close FROM panel WHERE n_bars >= {ENOUGH}"),
    "symbol_list": """
SELECT symbol, count(*) AS n
FROM (SELECT upper(trim(CASE event_id % 4 WHEN 0 THEN '# ' || event_type WHEN 1 THEN '  '
        ELSE ' ' || event_type || CAST(user_id % 7 AS VARCHAR) || ' ' END)) AS symbol FROM events)
WHERE symbol <> '' AND symbol NOT LIKE '#%' GROUP BY symbol""",
    "resample_calendar_week": q(BARS, calendar("week", "INTERVAL 6 DAYS")),
    "resample_month": q(BARS, calendar("month", "INTERVAL 1 MONTH - INTERVAL 1 DAY")),
    "ema_gaps": q(PANEL + """,
holes AS (SELECT symbol, bar_no, CASE WHEN bar_no % 700 < 350 AND bar_no % 3 <> 1 THEN CAST(close AS DOUBLE) END AS x FROM panel),
e AS (
  SELECT symbol, bar_no, x AS y, CASE WHEN x IS NOT NULL THEN bar_no END AS seen FROM holes WHERE bar_no = 0
  UNION ALL
  SELECT h.symbol, h.bar_no,
    CASE WHEN h.x IS NULL THEN e.y WHEN e.y IS NULL THEN h.x
         ELSE (pow(0.8, h.bar_no - e.seen) * e.y + 0.2 * h.x) / (pow(0.8, h.bar_no - e.seen) + 0.2) END,
    CASE WHEN h.x IS NULL THEN e.seen ELSE h.bar_no END
  FROM e JOIN holes h ON h.symbol = e.symbol AND h.bar_no = e.bar_no + 1)""", "SELECT symbol, bar_no, round(y, 6) AS \"EMA_9\" FROM e"),
    "symbol_files": q(BARS, "SELECT symbol, ts, open, high, low, close, volume FROM bars"),
    "symbol_file_rejects": "SELECT 'S0' AS symbol, 'no header' AS reason",
    "forward_fill": q(PANEL + """,
holes AS (SELECT symbol, bar_no, CASE WHEN volume % 3 = 0 THEN close END AS close,
                 CASE WHEN bar_no % 50 = 7 THEN volume END AS volume FROM panel)""", f"""
SELECT symbol, bar_no,
  last_value(close IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close,
  last_value(volume IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS volume
FROM holes"""),
    "atr": indicator(r6(f"({roll('avg', 'tr', 14)})", "ATR")),
    "sma": indicator(r6(f"({roll('avg', 'close', 10)})", "SMA")),
    "ema": from_wide("EMA_20", "EMA_50"),
    "rsi": from_wide(RSI="RSI_14"),
    "macd": from_wide("MACD_line", "MACD_signal", "MACD_hist"),
    "vwap": from_wide(VWAP="VWAP_20"),
    "adx": from_wide(ADX="ADX_14"),
    "momentum": from_wide(Momentum="Momentum_10"),
    "volatility": from_wide(Volatility="Volatility_20"),
    "gap": from_wide("Gap_pct"),
    "rvol": from_wide(RVOL="RVOL_20"),
    "efficiency_ratio": from_wide(ER="ER_Kaufman_10"),
    "bollinger": from_wide("dist_bb_upper_pct", "dist_bb_lower_pct"),
    "distance_to_mean": from_wide("dist_vwap_pct"),
    "candles": from_wide("Candle_Body", "Candle_Range", "Upper_Wick", "Lower_Wick"),
    "momentum_entries": q(CANDIDATES, f"SELECT symbol, bar_no FROM k0 WHERE er > {dbl(0.3)}"),
    "liquid_bars": q(PANEL, f"""
SELECT symbol, bar_no, {r6('avg_volume')}
FROM (SELECT *, {roll('avg', 'volume', 63)} AS avg_volume FROM panel) WHERE avg_volume >= {dbl(66.003)}"""),
    "features": q(FEATURES, f"""
SELECT symbol, ts, bar_no, n_bars, open, high, low, close, volume, {r6s(*FEATURE_COLUMNS)} FROM feat"""),
    "atr_alias": q(FEATURES, f"SELECT symbol, bar_no, {r6('ATR_50', 'ATR')}, {r6('ATR_50')} FROM feat"),
    "sample": q(PANEL, f"SELECT symbol, bar_no, close FROM {sampled('panel', 500, 42)}"),
    "drop_candidates": q(CANDIDATES, f"SELECT symbol, bar_no, {r6('coef')} FROM cand"),
    "stop_coefficients": q(STOPS, f"SELECT symbol, n_candidates, n_kept, {r6s('csl_median', 'csl')} FROM stops"),
    "buying_power": q(
        CANDIDATES + f", two AS (SELECT DISTINCT symbol, {dbl(CSL)} AS csl FROM panel)," + power("two"),
        f"""SELECT symbol, {r6s('bp_median', 'bp_max')}, coalesce(n_samples, 0) AS n_samples, {BP_OK} AS admitted
FROM two LEFT JOIN bp USING (symbol)"""),
    "calibration": q(
        CALIBRATION, f"SELECT symbol, {r6s('csl', 'bp_median', 'bp_max')}, n_samples, admitted, error FROM calib"),
    "admitted_universe": q(CALIBRATION, f"""
SELECT symbol AS ticker, {r6s('csl', 'bp_median', 'bp_max')}, n_samples FROM calib WHERE admitted ORDER BY calib.csl"""),
    "sizing": q(CANDIDATES, f"""
SELECT symbol, bar_no, {r6('stop')}, {r6('target')}, size, {r6('power')}
FROM (SELECT *, CASE WHEN atr > 0 THEN close - atr * {dbl(CSL)} END AS stop,
        CASE WHEN atr > 0 THEN close + atr * ({dbl(CSL)} * 1.5) END AS target,
        close * CASE WHEN atr > 0 THEN CAST(floor(100 / ({dbl(CSL)} * atr)) AS BIGINT) ELSE 0 END AS power,
        CASE WHEN atr > 0 THEN CAST(floor(100 / ({dbl(CSL)} * atr)) AS BIGINT) ELSE 0 END AS size FROM k0)"""),
    "labels": q(LABELS, "SELECT symbol, bar_no, label, bar_no AS entry_bar FROM lab"),
    "labels_own_csl": q(OWN_LABELS, "SELECT symbol, bar_no, CASE WHEN label = 1 THEN 1 ELSE 0 END AS label FROM lab"),
    "label_counts": q(LABELS, "SELECT symbol, label, count(*) AS n FROM lab GROUP BY symbol, label"),
    "durations": q(FEATURES + f""",
ent AS (SELECT symbol, bar_no, n_bars, close - round(ATR_50, 8) * {dbl(CSL)} AS sl,
               close + round(ATR_50, 8) * ({dbl(CSL)} * 1.5) AS tp FROM feat),""" + touches("ent", 100), """
SELECT symbol, bar_no, CAST(CASE WHEN bar_no = n_bars - 1 THEN 0
  ELSE coalesce(least(sb, tb) - bar_no, 100) END AS INTEGER) AS duration
FROM ent JOIN touch USING (symbol, bar_no)"""),
    "durations_by_ratio": q(FEATURES + f""",
lv AS (SELECT symbol, bar_no, n_bars, ratio, -(round(ATR_50, 8) * {dbl(CSL)} - close) AS sl,
              close + ratio * {dbl(CSL)} * round(ATR_50, 8) AS tp
       FROM feat, (VALUES {', '.join(f'({dbl(x)})' for x in RATIOS)}) AS r(ratio)),
hit AS (
  SELECT e.symbol, e.bar_no, e.ratio, min(b.bar_no) AS xb
  FROM lv e JOIN feat b ON b.symbol = e.symbol AND b.bar_no > e.bar_no AND (b.low <= e.sl OR b.high >= e.tp)
  GROUP BY e.symbol, e.bar_no, e.ratio)""", """
SELECT symbol, bar_no, ratio, coalesce(xb, n_bars - 1) - bar_no AS duration
FROM lv LEFT JOIN hit USING (symbol, bar_no, ratio)"""),
    "rule_conditions": q(RULE_TEXTS, "SELECT rule_id, pos, text, feature, op, threshold FROM cond"),
    "rejected_rules": q(RULE_TEXTS, """
SELECT rule_id, count(*) AS n_bad, min(text) AS example FROM cond WHERE threshold IS NULL GROUP BY rule_id"""),
    "rule_bounds": q(RULE_TEXTS, """
SELECT rule_id, feature, lower, CASE WHEN lower IS NOT NULL THEN lower <> coalesce(open_lo, -1e300) END AS lower_closed,
       upper, CASE WHEN upper IS NOT NULL THEN upper <> coalesce(open_hi, 1e300) END AS upper_closed
FROM (
  SELECT rule_id, feature, max(threshold) FILTER (op IN ('>', '>=', '==')) AS lower,
    min(threshold) FILTER (op IN ('<', '<=', '==')) AS upper,
    max(threshold) FILTER (op = '>') AS open_lo, min(threshold) FILTER (op = '<') AS open_hi
  FROM cond WHERE threshold IS NOT NULL GROUP BY rule_id, feature)"""),
    "rule_hits": q(FEATURES + "," + HITS, "SELECT symbol, bar_no, rule_id FROM hits"),
    "signal_counts": q(FEATURES + "," + HITS, """
SELECT symbol, rule_id, count(*) AS n_signals FROM hits GROUP BY symbol, rule_id"""),
    "entry_exits": q(EXITS, f"""
SELECT symbol, entry_bar, exit_bar, entry_ts, exit_ts, {r6s(*MONEY)}, reason, bars_held, size, n_rules
FROM exits JOIN (SELECT symbol, bar_no + 1 AS entry_bar, CAST(count(*) AS INTEGER) AS n_rules FROM hits
                 GROUP BY symbol, bar_no) USING (symbol, entry_bar)"""),
    "trades": q(TRADES, f"""
SELECT symbol, rule_id, entry_bar, exit_bar, entry_ts, exit_ts, {r6s(*MONEY)}, reason, bars_held, size FROM trades"""),
    "signal_trades": q(
        FEATURES + ", one AS (SELECT symbol, bar_no, 0 AS rule_id FROM feat WHERE RSI_14 > 55.123),"
        + exit_ctes("one", dbl(CSL), dbl(3.2)) + "," + chain_ctes("one"),
        f"SELECT symbol, entry_bar, exit_bar, {r6('pnl')}, reason FROM trades"),
    "trade_curve": q(PERFORMANCE, f"""
SELECT symbol, rule_id, trade_no, {r6s('pnl', 'cum_pnl', 'drawdown_pct')} FROM perf2"""),
    "performance": q(PERFORMANCE, f"SELECT symbol, rule_id, n_trades, {METRIC_COLUMNS} FROM perf"),
    "results": q(RESULTS, f"SELECT symbol, rule_id, n_signals, n_trades, {r6s('csl', *RESULT_NUMBERS)} FROM res"),
    "strategy_summary": q(RESULTS, f"""
SELECT rule_id, symbols, trades, {r6s('pnl_total', 'mean_return_pct', 'mean_win_rate', 'mean_profit_factor')}
FROM (SELECT rule_id, count(DISTINCT symbol) AS symbols, CAST(sum(n_trades) AS BIGINT) AS trades,
        sum(total_pnl) AS pnl_total, avg(return_pct) AS mean_return_pct, avg(win_rate) AS mean_win_rate,
        avg(profit_factor) AS mean_profit_factor FROM res GROUP BY rule_id) ORDER BY pnl_total DESC"""),
    "selected_results": q(RESULTS, f"SELECT symbol, rule_id, {r6('total_pnl')} FROM sel"),
    "best_results": q(RESULTS, f"""
SELECT symbol, rule_id, {r6s('total_pnl', 'return_pct', 'corr_trade_vs_pnl', 'max_drawdown_pct')}
FROM (SELECT * FROM sel ORDER BY total_pnl DESC, corr_trade_vs_pnl DESC, symbol, rule_id LIMIT 10)"""),
    "describe": q(FEATURES + f", long AS ({_long})", f"""
SELECT symbol, feature, count, {r6s('mean', 'std', 'min', 'p25', 'p50', 'p75', 'max')}
FROM (SELECT symbol, feature, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
        quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75,
        max(value) AS max FROM long GROUP BY symbol, feature)"""),
    "medians": q(PANEL, f"SELECT symbol, {r6('m', 'median')} FROM (SELECT symbol, median(close) AS m FROM panel GROUP BY symbol)"),
    "eda_summary": q(EDA, f"""
SELECT symbol, n_bars, first_day, last_day, {r6s('csl', *EDA_NUMBERS)}
FROM eda JOIN (SELECT DISTINCT f.symbol, s.csl FROM feat f LEFT JOIN stops s ON s.symbol = f.symbol) USING (symbol)"""),
    "eda_rollup": q(EDA, f"""
SELECT n_symbols, n_bars, {r6s('price_mean', 'atr_mean', 'er_mean', 'er_above_thresh_pct')}
FROM (SELECT count(*) AS n_symbols, CAST(sum(n_bars) AS BIGINT) AS n_bars, avg(price_mean) AS price_mean,
        avg(atr_mean) AS atr_mean, avg(er_mean) AS er_mean, avg(er_above_thresh_pct) AS er_above_thresh_pct FROM eda)"""),
    "split_summary": q(SPLIT, f"""
SELECT symbol, CAST(count(*) FILTER (row_no < cut) AS BIGINT) AS train_rows,
       CAST(count(*) FILTER (row_no >= cut) AS BIGINT) AS test_rows, max(cut) AS split_at
FROM (SELECT *, CAST(floor(n_rows * {dbl(0.7)}) AS BIGINT) AS cut FROM ranked)
WHERE n_rows >= 20 AND cut > 0 AND cut < n_rows GROUP BY symbol"""),
    "row_order_head": q(LABELS, f"""
SELECT symbol, ts, label
FROM (SELECT l.symbol, f.ts, l.label, row_number() OVER (ORDER BY l.symbol, f.ts) - 1 AS r, count(*) OVER () AS n
      FROM lab l JOIN feat f USING (symbol, bar_no)) WHERE r < floor(n * {dbl(0.7)})"""),
    "folds": q(PANEL, """
SELECT symbol, fold, min(ts) AS first_ts, min(ts) FILTER (bar_no - fold * 21 >= 252) AS test_ts, max(ts) AS last_ts,
       count(*) FILTER (bar_no - fold * 21 < 252) AS train_rows, count(*) FILTER (bar_no - fold * 21 >= 252) AS test_rows
FROM panel JOIN (SELECT unnest(range(0, 1000)) AS fold)
  ON fold * 21 + 315 <= n_bars AND bar_no >= fold * 21 AND bar_no < fold * 21 + 315
GROUP BY symbol, fold"""),
    "evaluation": q(LABELS + """,
scored AS (SELECT l.symbol, CASE WHEN label = 1 THEN 1 ELSE 0 END AS y, close / CAST(20 AS DOUBLE) AS s
           FROM lab l JOIN feat f USING (symbol, bar_no)),
ranks AS (SELECT *, rank() OVER (PARTITION BY symbol ORDER BY s)
                    + (count(*) OVER (PARTITION BY symbol, s) - 1) / 2.0 AS rk FROM scored),
cm AS (SELECT symbol, count(*) FILTER (s >= 0.5 AND y = 1) AS tp, count(*) FILTER (s >= 0.5 AND y = 0) AS fp,
              count(*) FILTER (s < 0.5 AND y = 1) AS fn, count(*) FILTER (s < 0.5 AND y = 0) AS tn,
              sum(rk) FILTER (y = 1) AS rs, count(*) FILTER (y = 1) AS np, count(*) FILTER (y = 0) AS nn
       FROM ranks GROUP BY symbol),
ms AS (SELECT *, (tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE) AS accuracy,
              coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS precision,
              coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0) AS recall,
              coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0) AS f1,
              (rs - np * (np + 1) / 2.0) / CAST(nullif(np * nn, 0) AS DOUBLE) AS auc FROM cm)""", f"""
SELECT symbol, tp, fp, fn, tn, {r6s('accuracy', 'precision', 'recall', 'f1', 'auc')} FROM ms"""),
    "out_of_sample": q(TRADES + f""",
cut AS (SELECT symbol, CAST(floor(max(n_bars) * {dbl(0.7)}) AS BIGINT) AS s FROM feat GROUP BY symbol),
early AS (SELECT t.* FROM trades t JOIN cut USING (symbol) WHERE exit_bar < s),
late AS (SELECT t.* FROM trades t JOIN cut USING (symbol) WHERE entry_bar >= s),""" + metric_ctes("early", "ptrain")
        + "," + metric_ctes("late", "ptest"), f"""
SELECT symbol, rule_id, n_trades_train, n_trades_test,
       {r6s('profit_factor_train', 'profit_factor_test', 'total_pnl_train', 'total_pnl_test')}
FROM (SELECT a.symbol, a.rule_id, a.n_trades AS n_trades_train, b.n_trades AS n_trades_test,
        a.profit_factor AS profit_factor_train, b.profit_factor AS profit_factor_test,
        a.total_pnl AS total_pnl_train, b.total_pnl AS total_pnl_test
      FROM ptrain a JOIN ptest b ON a.symbol = b.symbol AND a.rule_id = b.rule_id
      WHERE b.profit_factor >= a.profit_factor * {dbl(0.7)})"""),
    "top_features": q(LABELS + ", long AS ("
        + " UNION ALL ".join(
            f"SELECT {i} AS pos, '{c}' AS feature, {c} AS value FROM lab JOIN feat USING (symbol, bar_no)"
            for i, c in enumerate(FEATURE_COLUMNS)) + ")", f"""
SELECT feature, importance, pos
FROM (SELECT feature, pos, round(stddev_samp(value), 6) AS importance FROM long GROUP BY feature, pos)
ORDER BY importance DESC, pos DESC LIMIT 5"""),
    "bars_csv": q(BARS, "SELECT symbol, ts, open, high, low, close, volume FROM bars"),
    "universe_csv": q(
        CANDIDATES + f", two AS (SELECT DISTINCT symbol, {dbl(CSL)} AS csl FROM panel)," + power("two"),
        f"""SELECT symbol, last_ts, csl, {r6('bp_median')}, n_samples
FROM two JOIN bp USING (symbol) JOIN (SELECT symbol, max(ts) AS last_ts FROM panel GROUP BY symbol) USING (symbol)
WHERE {BP_OK}"""),
    "rules_json": q(RULE_TEXTS, "SELECT rule_id, text FROM cond"),
    "class_weights": q(LABELS, """
SELECT target, n, round(sum(n) OVER () / CAST(count(*) OVER () * n AS DOUBLE), 9) AS weight
FROM (SELECT CASE WHEN label = 1 THEN 1 ELSE 0 END AS target, count(*) AS n FROM lab GROUP BY 1)"""),
    "tree_split": q(SPLIT + f""",
rows AS (
  SELECT CASE WHEN r.label = 1 THEN 1 ELSE 0 END AS y, floor(round(f.RSI_14, 6) / 2) AS rsi_step,
         floor(round(f.close * 100) / 10) AS price_step
  FROM ranked r JOIN feat f USING (symbol, bar_no)
  WHERE n_rows >= 20 AND row_no < floor(n_rows * {dbl(0.7)})),
v AS (SELECT 0 AS pos, 'rsi_step' AS feature, rsi_step AS x, y FROM rows
      UNION ALL SELECT 1, 'price_step', price_step, y FROM rows),
g AS (SELECT pos, feature, x, count(*) AS n, sum(y) AS s FROM v GROUP BY pos, feature, x),
c AS (SELECT pos, feature, x, lead(x) OVER w AS nx, CAST(sum(n) OVER w AS BIGINT) AS nl, CAST(sum(s) OVER w AS DOUBLE) AS sl,
             CAST(sum(n) OVER (PARTITION BY feature) AS BIGINT) AS nt, CAST(sum(s) OVER (PARTITION BY feature) AS DOUBLE) AS st
      FROM g WINDOW w AS (PARTITION BY feature ORDER BY x)),
best AS (SELECT *, (x + nx) / 2 AS threshold FROM c WHERE nx IS NOT NULL AND nl >= 30 AND nt - nl >= 30
         ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, pos, x LIMIT 1)""", """
SELECT 0 AS rule_id, feature, '<=' AS op, threshold, nl AS n_samples, round(sl / nl, 9) AS p FROM best
UNION ALL SELECT 1, feature, '>', threshold, nt - nl, round((st - sl) / (nt - nl), 9) FROM best"""),
    "rule_rates": q(SPLIT + "," + HITS, f"""
SELECT rule_id, n_samples, {r6('p', 'p_label_1')}
FROM (SELECT rule_id, count(*) AS n_samples, avg(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS p
      FROM ranked JOIN hits USING (symbol, bar_no)
      WHERE n_rows >= 20 AND row_no < floor(n_rows * {dbl(0.7)}) GROUP BY rule_id)"""),
}
