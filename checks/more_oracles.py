"""Plain SQL for the further queries."""

from __future__ import annotations

from barlab.operators.features import Periods, feature_names
from barlab.params import FEATURE_COLUMNS
from checks.more_queries import LONG_BARS, LONG_LABEL_BARS, OTHER, TREE, TREE_INPUTS
from checks.oracles import (
    BARS, FEATURES, HITS, LABELS, MONEY, PANEL, RSI, SPLIT, STEPS, TRADES, W, chain_ctes, dbl, dist, ema_step, exit_ctes, lag, metric_ctes, q, r6, r6s, roll,
    touches,
)
from checks.queries import CSL, RULES

# Rule texts are read by pattern, as in the query; here each condition becomes a bound of its own column.
MANY_RULES = FEATURES + """,
weeks AS (
  SELECT symbol, CAST((CAST(ts AS DATE) - DATE '1990-01-01') // 7 AS INTEGER) AS w, min(low) AS low, max(high) AS high
  FROM feat GROUP BY ALL),
many AS (
  SELECT CAST(CAST(substr(symbol, 2) AS INTEGER) * 10000 + w AS INTEGER) AS rule_id, w,
    floor(low) + CAST(0.137 AS DOUBLE) AS vwap_above,
    CAST(printf('%.3f', floor(low) + (w % 5) * CAST(0.1 AS DOUBLE) + CAST(0.241 AS DOUBLE)) AS DOUBLE) AS vwap_to,
    CAST(printf('%.3f', (w % 45) + CAST(20.123 AS DOUBLE)) AS DOUBLE) AS rsi_from, CAST(printf('%.3f', (w % 45) + CAST(24.517 AS DOUBLE)) AS DOUBLE) AS rsi_under,
    CAST(printf('%.3f', high) AS DOUBLE) AS top, CAST(printf('%.3f', low) AS DOUBLE) AS bottom
  FROM weeks WHERE w % 41 <> 0 AND w % 43 <> 0 AND w % 47 <> 0),
many_hits AS (
  SELECT f.symbol, f.bar_no, m.rule_id
  FROM feat f JOIN many m ON f.RSI_14 >= m.rsi_from AND f.RSI_14 < m.rsi_under
   AND f.VWAP_20 > CAST(printf('%.3f', m.vwap_above) AS DOUBLE) AND f.VWAP_20 <= m.vwap_to
   AND (m.w % 2 = 1 OR f.RSI_14 > m.rsi_from) AND f.ATR_50 > -0.5
   AND CASE WHEN m.w % 3 = 0 THEN f.close <= m.top ELSE f.close = m.bottom END)"""


def barriers(stop: float, target: float) -> str:
    return f"close - round(ATR_50, 8) * {dbl(stop)} AS sl, close + round(ATR_50, 8) * {dbl(target)} AS tp"


def gap_step(y: str, span: int) -> str:
    """An EMA over a gap: the old value fades with the bars since it was known."""
    keep, alpha = dbl((span - 1) / (span + 1)), dbl(2 / (span + 1))
    aged = f"pow({keep}, h.bar_no - e.seen)"
    return f"CASE WHEN h.x IS NULL THEN e.{y} WHEN e.{y} IS NULL THEN h.x ELSE ({aged} * e.{y} + {alpha} * h.x) / ({aged} + {alpha}) END"


def features_of(p: Periods) -> str:
    """The feature frame for any lengths: EMAs by recursion, the rest by windows."""
    fast, slow, signal = p.macd
    spans = list(dict.fromkeys([fast, slow, *p.emas]))
    start = ", ".join(f"close AS e{n}" for n in spans)
    step = ", ".join(f"{ema_step(f'e.e{n}', 's.close', n)} AS e{n}" for n in spans)
    kept = ", ".join(f"e{n}" for n in spans)
    dmu, dmd = ema_step("e.p", "s.dmu", p.adx), ema_step("e.m", "s.dmd", p.adx)
    ems = ", ".join(f"e{n} AS EMA_{n}" for n in p.emas)
    away = ", ".join(f"{dist(f'e{n}')} AS dist_ema{n}_pct" for n in p.emas)
    typical = f"(tpv_ / nullif(v_, 0))"
    names = feature_names(p)
    filled = ", ".join(f"last_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in names)
    return STEPS + f""",
em AS (
  SELECT symbol, bar_no, {start}, close - close AS line, close - close AS sig, dmu AS p, dmd AS m, CAST(NULL AS DOUBLE) AS adx
  FROM st WHERE bar_no = 0
  UNION ALL
  SELECT symbol, bar_no, {kept}, e{fast} - e{slow}, {ema_step('sig', f'(e{fast} - e{slow})', signal)}, p, m,
    CASE WHEN p + m = 0 THEN adx WHEN adx IS NULL THEN abs(p - m) / (p + m) ELSE {ema_step('adx', '(abs(p - m) / (p + m))', p.adx)} END
  FROM (SELECT s.symbol, s.bar_no, {step}, e.sig, e.adx, {dmu} AS p, {dmd} AS m
        FROM em e JOIN st s ON s.symbol = e.symbol AND s.bar_no = e.bar_no + 1)),
w1 AS (SELECT st.*, {kept}, line, sig, adx, {lag('close', p.er)} AS c_er, {lag('close', p.momentum)} AS c_m FROM st JOIN em USING (symbol, bar_no)),
w2 AS (
  SELECT *, {roll('avg', 'up', p.rsi)} AS gain, {roll('avg', 'dn', p.rsi)} AS loss, {roll('avg', 'tr', p.atr)} AS atr_,
    {roll('sum', 'tpv', p.vwap)} AS tpv_, {roll('sum', 'volume', p.vwap)} AS v_, {roll('avg', 'volume', p.rvol)} AS va_,
    {roll('sum', 'abs(mv)', p.er)} AS path, {roll('stddev_samp', 'ret', p.volatility)} AS sdr, {roll('avg', 'close', p.sma)} AS sma_,
    {roll('avg', 'close', p.bollinger)} AS mid, {roll('stddev_samp', 'close', p.bollinger)} AS sd
  FROM w1),
wide AS (
  SELECT symbol, ts, bar_no, {RSI.format(l='loss', g='gain')} AS RSI_{p.rsi}, atr_ AS ATR_{p.atr}, {ems}, {away},
    tpv_ / nullif(v_, 0) AS VWAP_{p.vwap}, {dist(typical)} AS dist_vwap_pct, line AS MACD_line, sig AS MACD_signal, line - sig AS MACD_hist,
    volume / nullif(va_, 0) AS RVOL_{p.rvol}, (close - c_er) / nullif(path, 0) AS ER_Kaufman_{p.er}, (open - pc) / nullif(pc, 0) AS Gap_pct,
    adx * 100 AS ADX_{p.adx}, (close / nullif(c_m, 0) - 1) * 100 AS ROC_{p.momentum}, close / nullif(c_m, 0) - 1 AS Momentum_{p.momentum},
    sdr * sqrt(CAST(252 AS DOUBLE)) AS Volatility_{p.volatility}, sma_ AS SMA_{p.sma},
    (close - (mid + {p.width} * sd)) / nullif(mid, 0) * 100 AS dist_bb_upper_pct, (close - (mid - {p.width} * sd)) / nullif(mid, 0) * 100 AS dist_bb_lower_pct,
    abs(close - open) AS Candle_Body, high - low AS Candle_Range, high - greatest(open, close) AS Upper_Wick, least(open, close) - low AS Lower_Wick
  FROM w2),
fl AS (SELECT symbol, ts, bar_no, {filled} FROM wide),
other AS (
  SELECT * REPLACE (row_number() OVER ({W}) - 1 AS bar_no), count(*) OVER (PARTITION BY symbol) AS n_bars
  FROM fl WHERE {' AND '.join(f'{c} IS NOT NULL' for c in names)})"""


def rounded(column: str) -> str:
    value = f"round({column} + CAST(1e-11 AS DOUBLE), 9)" if column.startswith("VWAP") else f"round({column}, 6)"
    return f"CASE WHEN {value} = 0 THEN CAST(0 AS DOUBLE) ELSE {value} END AS {column}"


_inputs = " UNION ALL ".join(f"SELECT {i} AS pos, '{c}' AS feature, {c} AS v FROM complete" for i, c in enumerate(FEATURE_COLUMNS))
# Per batch, the watermark is a day behind the newest tick of the batches before it.
STREAM = """WITH ticks AS (
  SELECT event_type AS symbol, ts, value AS price, date_trunc('hour', ts) + INTERVAL 1 HOUR AS bar_end,
    CAST((CAST(ts AS DATE) - DATE '2024-01-01') // 6 AS INTEGER) + CASE WHEN event_id % 97 = 0 THEN 2 WHEN event_id % 13 = 0 THEN 1 ELSE 0 END AS batch
  FROM events),
marks AS (
  SELECT batch, coalesce(max(date_trunc('millisecond', newest)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 DAY,
                         TIMESTAMP '1970-01-01') AS mark
  FROM (SELECT batch, max(ts) AS newest FROM ticks GROUP BY batch)),
dealt AS (SELECT ticks.*, bar_end <= mark AS late FROM ticks JOIN marks USING (batch))"""


def tree_sql(levels: int, leaf: int, rate: float) -> str:
    """A regression tree level by level: every cut between values of a node, by sums over them; thresholds lie between values of all rows."""
    inputs = ", ".join(TREE_INPUTS)
    long = " UNION ALL ".join(f"SELECT path, {i} AS pos, {c} AS x, y FROM r{{k}}" for i, c in enumerate(TREE_INPUTS))
    out = SPLIT + f""",
r0 AS (
  SELECT '' AS path, CASE WHEN r.label = 1 THEN 1 ELSE 0 END AS y, floor(round(f.RSI_14, 6) * 0.5) AS rsi_step, floor(round(f.close * 100) / 10) AS price_step,
    floor(round(f.ER_Kaufman_10, 6) * 10) AS er_step, least(floor(round(f.RVOL_20, 6) * 4), 40) AS rvol_step
  FROM ranked r JOIN feat f USING (symbol, bar_no) WHERE n_rows >= 20 AND row_no < floor(n_rows * {dbl(0.7)})),
every AS (SELECT pos, x, lead(x) OVER (PARTITION BY pos ORDER BY x) AS nx FROM (SELECT DISTINCT pos, x FROM ({long.format(k=0)})))"""
    column = "CASE b.pos " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(TREE_INPUTS)) + " END"
    name = "CASE pos " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(TREE_INPUTS)) + " END"
    for k in range(levels):
        out += f""",
g{k} AS (SELECT path, pos, x, count(*) AS n, sum(y) AS s FROM ({long.format(k=k)}) GROUP BY ALL),
c{k} AS (
  SELECT path, pos, x, CAST(sum(n) OVER w AS DOUBLE) AS nl, CAST(sum(s) OVER w AS DOUBLE) AS sl,
    CAST(sum(n) OVER (PARTITION BY path, pos) AS DOUBLE) AS nt, CAST(sum(s) OVER (PARTITION BY path, pos) AS DOUBLE) AS st
  FROM g{k} WINDOW w AS (PARTITION BY path, pos ORDER BY x)),
b{k} AS (
  SELECT path, pos, (x + nx) / 2 AS threshold
  FROM (SELECT *, round(sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt, 9) AS gain
        FROM c{k} JOIN every USING (pos, x) WHERE nl >= {leaf} AND nt - nl >= {leaf})
  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, pos, x) = 1),
t{k} AS (
  SELECT path || 'L' AS path, {name} || ' <= ' || printf('%.3f', threshold) AS text FROM b{k}
  UNION ALL SELECT path || 'R', {name} || ' > ' || printf('%.3f', threshold) FROM b{k}),
r{k + 1} AS (SELECT r.path || CASE WHEN {column} <= b.threshold THEN 'L' ELSE 'R' END AS path, y, {inputs} FROM r{k} r JOIN b{k} b ON b.path = r.path)"""
    texts = " UNION ALL ".join(f"SELECT * FROM t{k}" for k in range(levels))
    ends = " UNION ALL ".join(f"SELECT path, y FROM r{k} WHERE path NOT IN (SELECT path FROM b{k})" for k in range(levels))
    return q(out + f""",
texts AS ({texts}),
leaves AS (SELECT path, count(*) AS n, avg(y) AS p FROM ({ends} UNION ALL SELECT path, y FROM r{levels}) GROUP BY path)""", f"""
SELECT CAST(row_number() OVER (ORDER BY path) - 1 AS INTEGER) AS rule_id, n AS n_samples, round(p, 9) AS p,
  (SELECT coalesce(string_agg(text, ' AND ' ORDER BY length(t.path)), '') FROM texts t WHERE starts_with(leaves.path, t.path)) AS rule
FROM leaves WHERE n >= {leaf} AND p >= {rate}""")


_rule_texts = " ".join(f"WHEN {r.rule_id} THEN '" + " AND ".join(f"{f} {op} {float(t)!r}" for f, op, t in r.conditions) + "'" for r in RULES)
_two = ["profit_factor", "total_pnl", "win_rate", "max_drawdown_pct"]
ORACLES: dict[str, str] = {
    "stream_bars": STREAM + """
SELECT symbol, date_trunc('hour', ts) AS ts, arg_min(price, (ts, price)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, price)) AS close,
  CAST(count(*) AS DOUBLE) AS volume
FROM dealt WHERE NOT late AND bar_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM ticks) GROUP BY symbol, date_trunc('hour', ts)""",
    "late_ticks": STREAM + "SELECT symbol, count(*) AS n_late, max(ts) AS newest FROM dealt WHERE late GROUP BY symbol",
    "rules_library": q(TRADES + f""",
cut AS (SELECT symbol, CAST(floor(max(n_bars) * {dbl(0.7)}) AS BIGINT) AS s FROM feat GROUP BY symbol),
early AS (SELECT t.* FROM trades t JOIN cut USING (symbol) WHERE exit_bar < s),
late AS (SELECT t.* FROM trades t JOIN cut USING (symbol) WHERE entry_bar >= s),""" + metric_ctes("early", "ptrain") + "," + metric_ctes("late", "ptest"), f"""
SELECT symbol, rule_id, CASE rule_id {_rule_texts} END AS rule, n_trades_train, n_trades_test, {r6s(*[f'{c}_{s}' for c in _two for s in ('train', 'test')])}
FROM (SELECT a.symbol, a.rule_id, a.n_trades AS n_trades_train, b.n_trades AS n_trades_test,
        {', '.join(f'a.{c} AS {c}_train, b.{c} AS {c}_test' for c in _two)}
      FROM ptrain a JOIN ptest b ON a.symbol = b.symbol AND a.rule_id = b.rule_id WHERE b.profit_factor >= a.profit_factor * {dbl(0.7)})"""),
    "bucketed_chain": q(
        FEATURES + f""",
lent AS (
  SELECT symbol, bar_no, close - round(ATR_50, 8) * {dbl(CSL)} AS sl, close + round(ATR_50, 8) * ({dbl(CSL)} * 1.5) AS tp
  FROM feat WHERE bar_no <= n_bars - 42 AND ATR_50 > 0 AND close BETWEEN 1 AND 20),""" + touches("lent", 40).replace("touch AS", "ltouch AS") + "," + HITS + ","
        + exit_ctes("hits", dbl(CSL), dbl(CSL * 1.5)) + "," + chain_ctes("hits"), """
SELECT rule_id, CASE WHEN l.sb <= coalesce(l.tb, l.sb) THEN 0 WHEN l.tb IS NOT NULL THEN 1 ELSE 2 END AS label, count(*) AS n, round(sum(pnl), 4) AS pnl
FROM trades t JOIN ltouch l ON l.symbol = t.symbol AND l.bar_no = t.entry_bar - 1 GROUP BY ALL"""),
    "tree_rules": tree_sql(TREE.levels, TREE.leaf, TREE.rate),
    "forest_importance": "SELECT unnest([" + ", ".join(f"'{c}'" for c in FEATURE_COLUMNS) + "]) AS feature, true AS agrees",
    "symbol_files_notes": q(BARS, "SELECT symbol, ts, open, high, low, close, volume FROM bars"),
    "symbol_folders": q(BARS, "SELECT symbol, ts, open, high, low, close, volume FROM bars"),
    "feature_files": q(FEATURES, f"SELECT symbol, ts, close, volume, {r6s(*FEATURE_COLUMNS)} FROM feat"),
    "labeled_files": q(LABELS, f"""
SELECT symbol, ts, close, {r6s('RSI_14', 'ATR_50')}, label, bar_no AS entry_bar FROM lab JOIN feat USING (symbol, bar_no)"""),
    "exported_rules": q(PANEL, """
SELECT CAST(CAST(substr(symbol, 2) AS INTEGER) * 10000 + year(m) * 12 % 10000 + month(m) AS INTEGER) AS rule_id, pos, n AS n_samples, CAST(0.25 AS DOUBLE) AS p_label_1,
  CASE pos WHEN 0 THEN 'VWAP_20 > ' || printf('%.3f', low) ELSE 'VWAP_20 <= ' || printf('%.3f', high + CAST(0.12345 AS DOUBLE)) END AS text
FROM (SELECT symbol, date_trunc('month', ts) AS m, min(low) AS low, max(high) AS high, count(*) AS n FROM panel GROUP BY ALL), (VALUES (0), (1)) AS v(pos)"""),
    "model_inputs": q(LABELS + f""",
complete AS (
  SELECT feat.* FROM lab JOIN feat USING (symbol, bar_no) WHERE bar_no % 7 > 0 AND bar_no % 5 > 0),
long AS ({_inputs})""", "SELECT pos, feature, count(*) AS n, round(avg(v), 4) AS mean FROM long GROUP BY pos, feature"),
    "features_periods": q(features_of(OTHER), f"SELECT symbol, ts, bar_no, n_bars, {', '.join(map(rounded, feature_names(OTHER)))} FROM other"),
    "macd_gaps": q(PANEL + f""",
holes AS (SELECT symbol, bar_no, CASE WHEN bar_no % 700 < 350 AND bar_no % 3 <> 1 THEN CAST(close AS DOUBLE) END AS x FROM panel),
e AS (
  SELECT symbol, bar_no, x AS f, x AS s, x - x AS sig, CASE WHEN x IS NOT NULL THEN bar_no END AS seen FROM holes WHERE bar_no = 0
  UNION ALL
  SELECT symbol, bar_no, f, s, CASE WHEN old IS NULL THEN f - s ELSE {ema_step('old', '(f - s)', 9)} END, seen
  FROM (
    SELECT h.symbol, h.bar_no, {gap_step('f', 12)} AS f, {gap_step('s', 26)} AS s, e.sig AS old,
      CASE WHEN h.x IS NULL THEN e.seen ELSE h.bar_no END AS seen
    FROM e JOIN holes h ON h.symbol = e.symbol AND h.bar_no = e.bar_no + 1))""", f"""
SELECT symbol, bar_no, {r6('f - s', 'MACD_line')}, {r6('sig', 'MACD_signal')}, {r6('f - s - sig', 'MACD_hist')} FROM e"""),
    "rule_hits_many": q(MANY_RULES, "SELECT symbol, bar_no, rule_id FROM many_hits"),
    "signal_counts_many": q(MANY_RULES, "SELECT symbol, rule_id, count(*) AS n_signals FROM many_hits GROUP BY symbol, rule_id"),
    "durations_long": q(FEATURES + f""",
ent AS (SELECT symbol, bar_no, n_bars, {barriers(9.37, 11.83)} FROM feat),""" + touches("ent", LONG_BARS), f"""
SELECT symbol, bar_no, CAST(CASE WHEN bar_no = n_bars - 1 THEN 0
  ELSE coalesce(least(sb, tb) - bar_no, {LONG_BARS}) END AS INTEGER) AS duration
FROM ent JOIN touch USING (symbol, bar_no)"""),
    "labels_long": q(FEATURES + f""",
ent AS (
  SELECT symbol, bar_no, close - round(ATR_50, 8) * {dbl(7.31)} AS sl, close + round(ATR_50, 8) * ({dbl(7.31)} * 1.5) AS tp
  FROM feat WHERE bar_no <= n_bars - {LONG_LABEL_BARS + 2} AND ATR_50 > 0 AND close BETWEEN 1 AND 20),""" + touches("ent", LONG_LABEL_BARS), """
SELECT symbol, bar_no, CASE WHEN sb <= coalesce(tb, sb) THEN 0 WHEN tb IS NOT NULL THEN 1 ELSE 2 END AS label, bar_no AS entry_bar
FROM touch"""),
    "exits_long": q(
        FEATURES + "," + HITS + "," + exit_ctes("hits", dbl(6.13), f"({dbl(6.13)} * 1.5)").replace("+ 40", f"+ {LONG_LABEL_BARS}"), f"""
SELECT symbol, entry_bar, exit_bar, entry_ts, exit_ts, {r6s(*MONEY)}, reason, bars_held, size, n_rules
FROM exits JOIN (SELECT symbol, bar_no + 1 AS entry_bar, CAST(count(*) AS INTEGER) AS n_rules FROM hits
                 GROUP BY symbol, bar_no) USING (symbol, entry_bar)"""),
    "medians_approx": q(PANEL, "SELECT symbol, count(*) AS n, true AS within FROM panel GROUP BY symbol"),
    "walk_forward": q(PANEL, """
SELECT symbol, fold, CASE WHEN bar_no - fold * 21 < 252 THEN 'train' ELSE 'test' END AS part, count(*) AS n,
  min(ts) AS first_ts, max(ts) AS last_ts, round(sum(close), 4) AS closes, round(sum(volume), 4) AS volumes
FROM panel JOIN (SELECT unnest(range(0, 1000)) AS fold)
  ON fold * 21 + 315 <= n_bars AND bar_no >= fold * 21 AND bar_no < fold * 21 + 315
GROUP BY ALL"""),
    "fold_performance": q(LABELS + f""",
moves AS (SELECT f.symbol, f.bar_no, f.n_bars, f.close, f.close / lag(f.close) OVER (PARTITION BY f.symbol ORDER BY f.bar_no) - 1 AS ret, l.label
          FROM feat f LEFT JOIN lab l ON l.symbol = f.symbol AND l.bar_no = f.bar_no),
dealt AS (
  SELECT *, CASE WHEN bar_no - fold * 21 < 252 THEN 'train' ELSE 'test' END AS part
  FROM moves JOIN (SELECT unnest(range(0, 1000)) AS fold)
    ON fold * 21 + 315 <= n_bars AND bar_no >= fold * 21 AND bar_no < fold * 21 + 315),
fp AS (
  SELECT symbol, fold, part, count(*) AS bars, count(label) AS labeled, count(*) FILTER (label = 1) AS positives,
    avg(ret) AS mean_return, stddev_samp(ret) AS std_return, max_by(close, bar_no) / min_by(close, bar_no) - 1 AS total_return
  FROM dealt GROUP BY symbol, fold, part)""", f"""
SELECT symbol, fold, part, bars, labeled, positives, {r6s('mean_return', 'std_return', 'total_return')},
  round(positives / nullif(labeled, 0), 6) AS rate FROM fp"""),
}
