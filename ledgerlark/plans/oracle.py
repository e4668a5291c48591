"""ANSI SQL stating each query's result over the supplied files, for comparison in another engine."""

from __future__ import annotations

from ledgerlark.functions.symbols import MARKETS, SECTORS
from ledgerlark.sources.fixtures import PAIRS


def _case(subject: str, values, otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {subject} {whens} ELSE {otherwise} END"


_CODES = [m[0] for m in MARKETS.values()]
_COUNTRIES = [m[1] for m in MARKETS.values()]
_CURRENCIES = [m[2] for m in MARKETS.values()]
_PAIR = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PAIRS.items()) + " END"

# Shared subqueries in order of dependence; a query lists those it needs.
CTES = {
    "ticks": """
SELECT event_type AS stock_symbol, ts AS "timestamp", CAST(value AS DECIMAL(12,2)) AS close,
       CAST(props->>'$.k' AS BIGINT) AS volume FROM events""",
    "lines": """
SELECT p_brand AS stock_symbol, l_shipdate AS "timestamp", CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
       CAST(l_quantity AS BIGINT) AS quantity,
       (CAST(l_orderkey AS HUGEINT) * 8 + l_linenumber) * 10000000000
         + CAST(round(l_extendedprice * 100) AS BIGINT) AS seq
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "stock_prices": """
SELECT stock_symbol, "timestamp", arg_min(price, seq) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, seq) AS close, CAST(sum(quantity) AS BIGINT) AS volume
FROM lines GROUP BY stock_symbol, "timestamp\"""",
    "transactions": """
SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                 CAST(l_suppkey AS VARCHAR), CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR),
                 CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), l_returnflag) AS transaction_id,
       CAST(c_nationkey AS VARCHAR) AS portfolio_id, p_brand AS stock_symbol,
       CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS transaction_type, l_returnflag AS flag,
       CAST(l_quantity AS DECIMAL(12,0)) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
       l_shipdate AS transaction_date
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey""",
    "brands": """
SELECT DISTINCT p_brand AS stock_symbol, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS n FROM part""",
    "securities": f"""
SELECT stock_symbol, 'Company ' || n AS name, {_case('n % 4', _CODES)} AS market_code,
       {_case('n % 4', _COUNTRIES)} AS country_code,
       CASE WHEN n % 9 <> 0 THEN {_case('n % 4', _CURRENCIES)} END AS quote_currency,
       CASE WHEN n % 5 <> 0 THEN {_case('n % 11', SECTORS)} END AS gics_sector,
       CASE WHEN n % 7 = 0 THEN 'Special Situations' END AS gics_sector_override
FROM brands WHERE n % 13 <> 0""",
    "security_view": """
SELECT stock_symbol, COALESCE(gics_sector_override, gics_sector, 'Unknown') AS gics_sector,
       replace(lower(gics_sector), ' ', '_') AS gics_sector_code, COALESCE(country_code, 'Unknown') AS country_code,
       COALESCE(quote_currency, 'USD') AS quote_currency, COALESCE(market_code, 'Unknown') AS market_code
FROM securities""",
    "stocks": f"""
SELECT 'stk-' || n AS id, stock_symbol AS symbol, 'Company ' || n AS name, {_case('n % 4', _CODES)} AS exchange,
       'raw ' || n AS sector, {_case('n % 4', _COUNTRIES)} AS country_code,
       CASE WHEN n % 9 <> 0 THEN {_case('n % 4', _CURRENCIES)} END AS quote_currency,
       CASE WHEN n % 5 <> 0 THEN n % 11 + 1 END AS gics_sector_id, CASE WHEN n % 6 <> 0 THEN n % 4 + 1 END AS market_id,
       CASE WHEN n % 7 = 0 THEN 'Special Situations' END AS gics_sector_override,
       TIMESTAMP '2024-02-01' AS updated_at FROM brands""",
    "rates": f"""
SELECT substr(pair, 1, 3) AS base_currency, substr(pair, 4, 3) AS quote_currency, ts AS "timestamp",
       value / 1000 + 1 AS rate
FROM (SELECT {_PAIR} AS pair, ts, value FROM events) WHERE pair IS NOT NULL""",
    "latest_rates": """
SELECT base_currency, quote_currency, arg_max(rate, "timestamp") AS rate FROM rates GROUP BY ALL""",
    "portfolios": """
SELECT CAST(n_nationkey AS VARCHAR) AS portfolio_id, n_name AS name FROM nation UNION ALL SELECT 'idle', 'IDLE'""",
    "holdings": """
SELECT portfolio_id, stock_symbol,
       sum(CASE WHEN transaction_type = 'BUY' THEN quantity ELSE -quantity END) AS q,
       sum(CASE WHEN transaction_type = 'BUY' THEN quantity * price ELSE -quantity * price END) AS cost
FROM transactions GROUP BY portfolio_id, stock_symbol
HAVING sum(CASE WHEN transaction_type = 'BUY' THEN quantity ELSE -quantity END) > 0""",
    "last_close": """
SELECT stock_symbol, arg_max(close, "timestamp") AS close FROM stock_prices GROUP BY stock_symbol""",
    "positions": """
SELECT portfolio_id, h.stock_symbol, q, cost, close, CAST(q AS DECIMAL(15,0)) * close AS value
FROM holdings h JOIN last_close p ON h.stock_symbol = p.stock_symbol""",
    "days": """
SELECT CAST(unnest(range(TIMESTAMP '1995-01-01', TIMESTAMP '2002-01-01', INTERVAL 1 DAY)) AS DATE) AS day""",
    "held_days": """
SELECT portfolio_id, stock_symbol, day, q FROM (
  SELECT *, sum(change) OVER w AS q, lead(since, 1, DATE '2002-01-01') OVER w AS until FROM (
    SELECT portfolio_id, stock_symbol, CAST(transaction_date AS DATE) AS since,
           sum(CASE WHEN transaction_type = 'BUY' THEN quantity ELSE -quantity END) AS change
    FROM transactions GROUP BY ALL) WINDOW w AS (PARTITION BY portfolio_id, stock_symbol ORDER BY since))
JOIN days ON day >= since AND day < until WHERE q > 0""",
    "close_days": """
SELECT stock_symbol, day, close FROM (
  SELECT stock_symbol, CAST("timestamp" AS DATE) AS since, close,
         lead(CAST("timestamp" AS DATE), 1, DATE '2002-01-01') OVER (PARTITION BY stock_symbol ORDER BY "timestamp") AS until
  FROM stock_prices) JOIN days ON day >= since AND day < until""",
    "flows": """
SELECT portfolio_id, CAST(transaction_date AS DATE) AS day,
       sum(CASE WHEN transaction_type = 'BUY' THEN quantity * price ELSE -quantity * price END) AS flow
FROM transactions GROUP BY ALL""",
    "day_totals": """
SELECT portfolio_id, day, sum(CAST(q AS DECIMAL(15,0)) * close) AS value
FROM held_days JOIN close_days USING (stock_symbol, day) GROUP BY ALL""",
    "day_values": """
SELECT portfolio_id, day, value, COALESCE(flow, 0) AS flow,
       CASE WHEN lag(day) OVER w = day - 1 THEN CAST(value - COALESCE(flow, 0) - lag(value) OVER w AS DOUBLE)
            / CAST(lag(value) OVER w AS DOUBLE) * 100 END AS pct
FROM day_totals LEFT JOIN flows USING (portfolio_id, day) WINDOW w AS (PARTITION BY portfolio_id ORDER BY day)""",
    "numbered_closes": """
SELECT *, row_number() OVER (PARTITION BY stock_symbol ORDER BY "timestamp") AS rn FROM stock_prices""",
    "numbered_ticks": """
SELECT *, row_number() OVER (PARTITION BY stock_symbol ORDER BY "timestamp") AS rn FROM ticks""",
    "quotes": """
SELECT a, b, arg_max(rate, own) AS rate FROM (
  SELECT base_currency AS a, quote_currency AS b, 1 AS own, rate FROM latest_rates
  UNION ALL SELECT quote_currency, base_currency, 0, 1.0::DOUBLE / rate FROM latest_rates) GROUP BY ALL""",
    "routes": """
SELECT a, b, rate, 1 AS hops, [a, b] AS path FROM quotes
UNION ALL SELECT r.a, q.b, r.rate * q.rate, hops + 1, list_append(path, q.b)
FROM routes r JOIN quotes q ON r.b = q.a WHERE NOT list_contains(path, q.b)""",
    "crossed": """
SELECT a, b, rate, hops, path FROM routes QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY hops, path) = 1""",
    "ordered_trades": """
SELECT *, row_number() OVER (PARTITION BY portfolio_id, stock_symbol ORDER BY transaction_date, transaction_id) AS rn
FROM transactions""",
    "walk": """
SELECT portfolio_id, stock_symbol, CAST(0 AS BIGINT) AS rn, CAST(0 AS DOUBLE) AS quantity,
       CAST(0 AS DOUBLE) AS average, CAST(0 AS DOUBLE) AS gain FROM transactions GROUP BY portfolio_id, stock_symbol
UNION ALL
SELECT w.portfolio_id, w.stock_symbol, t.rn,
       CASE WHEN t.transaction_type = 'BUY' THEN w.quantity + t.quantity
            ELSE greatest(w.quantity - t.quantity, 0) END,
       CASE WHEN t.transaction_type = 'BUY'
            THEN (w.quantity * w.average + CAST(t.quantity AS DOUBLE) * CAST(t.price AS DOUBLE)) / (w.quantity + t.quantity)
            ELSE w.average END,
       CASE WHEN t.transaction_type = 'SELL'
            THEN w.gain + least(w.quantity, t.quantity) * (CAST(t.price AS DOUBLE) - w.average) ELSE w.gain END
FROM walk w JOIN ordered_trades t
  ON t.portfolio_id = w.portfolio_id AND t.stock_symbol = w.stock_symbol AND t.rn = w.rn + 1""",
    "weighted_all": """
SELECT portfolio_id, stock_symbol, arg_max(quantity, rn) AS quantity, arg_max(average, rn) AS average_cost,
       arg_max(gain, rn) AS realized_gain FROM walk GROUP BY portfolio_id, stock_symbol""",
    "weighted": "SELECT * FROM weighted_all WHERE quantity > 0",
    "valued": """
SELECT portfolio_id, p.stock_symbol, q, cost, close, value, gics_sector, gics_sector_code, country_code,
       s.quote_currency, market_code,
       CASE WHEN s.quote_currency = '{base}' THEN 1.0::DOUBLE
            WHEN d.rate IS NOT NULL THEN 1.0::DOUBLE / d.rate
            WHEN i.rate IS NOT NULL THEN i.rate ELSE 1.0::DOUBLE END AS fx
FROM positions p LEFT JOIN security_view s ON p.stock_symbol = s.stock_symbol
     LEFT JOIN latest_rates d ON d.base_currency = '{base}' AND d.quote_currency = s.quote_currency
     LEFT JOIN latest_rates i ON i.quote_currency = '{base}' AND i.base_currency = s.quote_currency""",
    "tickers": """
SELECT p_partkey, p_brand, p_name, replace(p_name, ' ', '-') || CASE p_size % 5 {suffixes} ELSE '' END AS ticker
FROM part""".replace("{suffixes}", " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(MARKETS))),
    "feed": """
SELECT stock_symbol, "timestamp", CASE WHEN volume % 17 <> 3 THEN CAST(close AS DOUBLE) END AS open,
       CAST(close AS DOUBLE) AS high, CAST(close AS DOUBLE) AS low,
       CASE WHEN volume % 13 <> 5 THEN CAST(close AS DOUBLE) END AS close,
       CASE WHEN volume >= 10 THEN volume ELSE 0 END AS volume FROM ticks""",
    "listed": f"""
SELECT p_partkey // 100 AS watchlist_id, {_case('n % 12', [*SECTORS, 'New Energy'])} AS sector,
       {_case('n % 5', [*_COUNTRIES, 'XX'])} AS region, ticker
FROM (SELECT *, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS n FROM tickers)""",
    "flat": f"""
SELECT watchlist_id, upper(ticker) AS stock_symbol, replace(lower(sector), ' ', '_') AS gics_sector_code,
       sector AS gics_sector_override, CASE WHEN region <> 'XX' THEN region END AS country_code,
       CASE region {' '.join(f"WHEN '{c}' THEN '{x}'" for c, x in zip(_COUNTRIES, _CURRENCIES))} END AS quote_currency,
       CASE region {' '.join(f"WHEN '{c}' THEN '{x}'" for c, x in zip(_COUNTRIES, _CODES))} END AS market_code, region
FROM listed""",
}

_NEEDS = {
    "stock_prices": ["lines"],
    "last_close": ["stock_prices"],
    "securities": ["brands"],
    "security_view": ["securities"],
    "stocks": ["brands"],
    "latest_rates": ["rates"],
    "holdings": ["transactions"],
    "positions": ["holdings", "last_close"],
    "held_days": ["transactions", "days"],
    "close_days": ["stock_prices", "days"],
    "flows": ["transactions"],
    "day_totals": ["held_days", "close_days"],
    "day_values": ["day_totals", "flows"],
    "numbered_closes": ["stock_prices"],
    "numbered_ticks": ["ticks"],
    "quotes": ["latest_rates"],
    "routes": ["quotes"],
    "crossed": ["routes"],
    "ordered_trades": ["transactions"],
    "walk": ["ordered_trades"],
    "weighted_all": ["walk"],
    "weighted": ["weighted_all"],
    "valued": ["positions", "security_view", "latest_rates"],
    "feed": ["ticks"],
    "listed": ["tickers"],
    "flat": ["listed"],
}


def _sql(body: str, *ctes: str, base: str = "AUD") -> str:
    """``WITH`` the named subqueries and all they need, then ``body``."""
    wanted: set[str] = set()

    def need(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in _NEEDS.get(name, []):
                need(other)

    for name in ctes:
        need(name)
    parts = [f"{n} AS ({CTES[n].replace('{base}', base).strip()})" for n in CTES if n in wanted]
    return f"WITH RECURSIVE {', '.join(parts)} {body.strip()}" if parts else body.strip()


_BY = 'PARTITION BY stock_symbol ORDER BY "timestamp"'


def _mean(p: int) -> str:
    frame = f"({_BY} ROWS BETWEEN {p - 1} PRECEDING AND CURRENT ROW)"
    return f"CAST(sum(close) OVER {frame} AS DOUBLE) / count(*) OVER {frame}"


_MEANS = {f"sma_{p}": p for p in (20, 50, 200)} | {f"ema_{p}": p for p in (12, 26)}


def _indicators(table: str, zero_loss: str = "NULL") -> str:
    """All indicators of ``table`` as nested subqueries."""
    means = ", ".join(f"{_mean(p)} AS {n}" for n, p in _MEANS.items())
    frame14 = f"({_BY} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)"
    frame20 = f"({_BY} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    return f"""
(SELECT *, ema_12 - ema_26 AS macd,
        avg(ema_12 - ema_26) OVER ({_BY} ROWS BETWEEN 8 PRECEDING AND CURRENT ROW) AS macd_signal,
        CASE WHEN loss = 0 THEN {zero_loss} ELSE 100.0::DOUBLE - 100.0::DOUBLE / (1.0::DOUBLE + gain / loss) END AS rsi_14
 FROM (SELECT *, CAST(sum(CASE WHEN change > 0 THEN change ELSE 0 END) OVER {frame14} AS DOUBLE) AS gain,
              CAST(sum(CASE WHEN change < 0 THEN -change ELSE 0 END) OVER {frame14} AS DOUBLE) AS loss,
              {means}, stddev_samp(CAST(close AS DOUBLE)) OVER {frame20} AS spread
       FROM (SELECT stock_symbol, "timestamp", close, close - lag(close) OVER ({_BY}) AS change FROM {table})))"""


_ALL_INDICATORS = """
SELECT stock_symbol, "timestamp", sma_20, sma_50, sma_200, ema_12, ema_26, rsi_14, macd,
       round(macd_signal, 4) AS macd_signal, round(sma_20 + 2 * spread, 3) AS bollinger_upper,
       round(sma_20 - 2 * spread, 3) AS bollinger_lower FROM {source}"""

_BARS = """
SELECT date_trunc('day', "timestamp") AS bucket, stock_symbol, CAST(arg_min(close, "timestamp") AS DOUBLE) AS open,
       CAST(max(close) AS DOUBLE) AS high, CAST(min(close) AS DOUBLE) AS low,
       CAST(arg_max(close, "timestamp") AS DOUBLE) AS close, CAST(sum(volume) AS BIGINT) AS volume
FROM ticks GROUP BY ALL"""


def _returns(table: str) -> str:
    return f"""
SELECT stock_symbol, "timestamp", CAST(close AS DOUBLE) AS close, CAST(prev AS DOUBLE) AS prev_close,
       CASE WHEN prev <> 0 THEN CAST(close - prev AS DOUBLE) / CAST(prev AS DOUBLE) END AS daily_return
FROM (SELECT *, lag(close) OVER ({_BY}) AS prev FROM {table}) WHERE prev IS NOT NULL"""


def _falls(source: str, keys: str, order: str, value: str) -> str:
    """The worst fall from a running maximum, in per cent."""
    peak = f"max({value}) OVER (PARTITION BY {keys} ORDER BY {order})"
    return f"""
SELECT {keys}, 100 * max((peak - v) / peak) AS max_drawdown
FROM (SELECT {keys}, CAST({peak} AS DOUBLE) AS peak, CAST({value} AS DOUBLE) AS v FROM {source}) GROUP BY ALL"""


def _means_so_far(table: str, value: str, names: dict[str, int]) -> str:
    """Recursive means of ``value`` by a walk over the numbered rows."""
    first = ", ".join(f"CAST({value} AS DOUBLE) AS {n}" for n in names)
    then = ", ".join(f"2.0::DOUBLE / {p + 1} * {value} + (1 - 2.0::DOUBLE / {p + 1}) * w.{n}" for n, p in names.items())
    return f"""
SELECT t.stock_symbol, t."timestamp", t.rn, {first} FROM {table} t WHERE rn = 1
UNION ALL SELECT t.stock_symbol, t."timestamp", t.rn, {then}
FROM {{walk}} w JOIN {table} t ON t.stock_symbol = w.stock_symbol AND t.rn = w.rn + 1"""


CTES["means"] = _means_so_far("numbered_closes", "t.close", {"ema_12": 12, "ema_26": 26}).replace("{walk}", "means")
CTES["tick_means"] = _means_so_far("numbered_ticks", "t.close", {"ema_12": 12, "ema_26": 26}).replace("{walk}", "tick_means")
CTES["tick_signal"] = _means_so_far("tick_means", "(t.ema_12 - t.ema_26)", {"signal": 9}).replace("{walk}", "tick_signal")
_NEEDS |= {"means": ["numbered_closes"], "tick_means": ["numbered_ticks"], "tick_signal": ["tick_means"]}


def _risk(where: str, annualize: bool, falls: str | None = None, owners: str = "holdings") -> str:
    volatility = "d * sqrt(252::DOUBLE)" if annualize else "d * 100"
    drawdown = "CAST(0 AS DOUBLE)" if falls is None else "COALESCE(round(max_drawdown, 6), 0)"
    joined = "" if falls is None else f"LEFT JOIN ({falls}) USING (portfolio_id)"
    owners = "holdings h" if owners == "holdings" else f"(SELECT portfolio_id, stock_symbol FROM {owners} LEFT JOIN holdings USING (portfolio_id)) h"
    return f"""
SELECT portfolio_id, round(v, 6) AS volatility,
       round(CASE WHEN v > 0 THEN (m - 0.02::DOUBLE) / v ELSE 0 END, 6) AS sharpe_ratio,
       {drawdown} AS max_drawdown, round(m, 6) AS avg_annual_return
FROM (SELECT portfolio_id, {volatility} AS v, a * 252 AS m FROM (
  SELECT portfolio_id, COALESCE(stddev_samp(r), 0) AS d, COALESCE(avg(r), 0) AS a
  FROM {owners} LEFT JOIN (
    SELECT stock_symbol, CAST(close - prev AS DOUBLE) / CAST(prev AS DOUBLE) AS r
    FROM (SELECT *, lag(close) OVER ({_BY}) AS prev FROM stock_prices WHERE {where}) WHERE prev IS NOT NULL
  ) p ON h.stock_symbol = p.stock_symbol GROUP BY portfolio_id)) {joined}"""


_SNAPSHOT = """
(SELECT stock_symbol, "timestamp", price AS current_price, sma, rsi, sma + 2 * dev AS bb_upper, sma - 2 * dev AS bb_lower,
        ((sma + 2 * dev) - (sma - 2 * dev)) / sma * 100 AS bb_width_pct
 FROM (SELECT stock_symbol, max("timestamp") AS "timestamp", CAST(max(CASE WHEN rn = 1 THEN close END) AS DOUBLE) AS price,
              CAST(sum(CASE WHEN rn <= 14 THEN close END) AS DOUBLE) / 14 AS sma,
              stddev_pop(CASE WHEN rn <= 14 THEN CAST(close AS DOUBLE) END) AS dev,
              CASE WHEN count(change) < 14 THEN 50::DOUBLE
                   WHEN sum(CASE WHEN rn <= 14 AND change < 0 THEN -change ELSE 0 END) = 0 THEN 100::DOUBLE
                   ELSE 100.0::DOUBLE - 100.0::DOUBLE / (1.0::DOUBLE
                        + CAST(sum(CASE WHEN rn <= 14 AND change > 0 THEN change ELSE 0 END) AS DOUBLE)
                        / CAST(sum(CASE WHEN rn <= 14 AND change < 0 THEN -change ELSE 0 END) AS DOUBLE)) END AS rsi
       FROM (SELECT *, close - lead(close) OVER (PARTITION BY stock_symbol ORDER BY rn) AS change
             FROM (SELECT *, row_number() OVER (PARTITION BY stock_symbol ORDER BY "timestamp" DESC) AS rn FROM {table})
             WHERE rn <= 30)
       GROUP BY stock_symbol HAVING count(*) >= 14))"""

def _half_up(numerator: str, denominator: str) -> str:
    """Quotient of integers rounded to an integer, halves away from zero."""
    return (
        f"sign({numerator}) * sign({denominator}) * ((2 * abs({numerator}) + abs({denominator})) "
        f"// (2 * abs({denominator})))"
    )


_REPORT = f"""
SELECT portfolio_id, symbol, CAST(q AS DOUBLE) AS quantity,
       CAST({_half_up('cost_cents', 'units')} AS DOUBLE) / 100 AS avg_cost, CAST(close AS DOUBLE) AS current_price,
       CAST(value_cents AS DOUBLE) / 100 AS market_value, CAST(value_cents - cost_cents AS DOUBLE) / 100 AS unrealized_pnl,
       CAST({_half_up('(10000 * (value_cents - cost_cents))', 'cost_cents')} AS DOUBLE) / 100 AS pnl_pct
FROM (SELECT portfolio_id, stock_symbol AS symbol, q, close, CAST(q AS HUGEINT) AS units,
             CAST(cost * 100 AS HUGEINT) AS cost_cents, CAST(value * 100 AS HUGEINT) AS value_cents FROM positions)"""

_VERIFIED = """
(SELECT portfolio_id, w.stock_symbol, quantity, average_cost, CAST(close AS DOUBLE) AS current_price,
        quantity * average_cost AS total_cost, quantity * CAST(close AS DOUBLE) AS current_value,
        (CAST(close AS DOUBLE) - average_cost) / average_cost * 100 AS pnl_pct
 FROM weighted w JOIN last_close p ON w.stock_symbol = p.stock_symbol)"""

_WEIGHTED = """
SELECT portfolio_id, stock_symbol, quantity, round(average_cost, 6) AS average_cost FROM weighted"""

_CORRECTED = """
SELECT stock_symbol, "timestamp", CAST(CASE WHEN "timestamp" >= TIMESTAMP '2000-01-01' THEN close + 1 ELSE close END
       AS DOUBLE) AS close, volume FROM {table}
UNION ALL
SELECT stock_symbol, "timestamp" + INTERVAL 3652 DAYS, CAST(close AS DOUBLE), volume FROM {table}
WHERE "timestamp" >= TIMESTAMP '2000-01-01'"""


def _by_suffix(values, otherwise: str) -> str:
    whens = " ".join(f"WHEN '{s}' THEN '{v}'" for s, v in zip(MARKETS, values))
    return f"CASE upper(right(ticker, 3)) {whens} ELSE {otherwise} END"


_FLAT_COLUMNS = """watchlist_id, stock_symbol, gics_sector_code, gics_sector_override, country_code, quote_currency,
       market_code"""


def _flat(where: str = "TRUE") -> str:
    return f"""
SELECT {_FLAT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY watchlist_id, stock_symbol ORDER BY gics_sector_override, region) AS rn
  FROM flat WHERE {where}) WHERE rn = 1"""


_COUNTED = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_OPERATIONAL_SECTORS = " UNION ALL ".join(f"SELECT {i + 1} AS id, '{s}' AS name" for i, s in enumerate(SECTORS))
_OPERATIONAL_MARKETS = " UNION ALL ".join(f"SELECT {i + 1} AS id, '{m}' AS code" for i, m in enumerate(_CODES))

_PUBLISHED = f"""
SELECT 'stock_prices' AS table_name, stock_symbol AS id, "timestamp" AS at, CAST(close * 100 AS BIGINT) AS amount, volume AS units,
       CAST(NULL AS VARCHAR) AS label FROM stock_prices
UNION ALL SELECT 'transactions', transaction_id, transaction_date, CAST(price * 100 AS BIGINT), CAST(quantity AS BIGINT),
       concat_ws('/', portfolio_id, stock_symbol, transaction_type) FROM transactions
UNION ALL SELECT 'securities', symbol, NULL, NULL, NULL, concat_ws('/', k.name, COALESCE(g.name, gics_sector_override, sector),
       replace(lower(g.name), ' ', '_'), m.code, quote_currency)
  FROM stocks k LEFT JOIN ({_OPERATIONAL_SECTORS}) g ON gics_sector_id = g.id LEFT JOIN ({_OPERATIONAL_MARKETS}) m ON market_id = m.id
UNION ALL SELECT 'exchange_rates', base_currency || quote_currency, "timestamp", CAST(round(rate * 1000000) AS BIGINT), NULL, NULL FROM rates"""

ORACLE: dict[str, str] = {
    "current_holdings": _sql(
        """SELECT portfolio_id, stock_symbol, CAST(q AS DOUBLE) AS total_quantity, CAST(cost AS DOUBLE) AS total_cost,
        CAST(cost AS DOUBLE) / CAST(q AS DOUBLE) AS average_cost FROM holdings""",
        "holdings",
    ),
    "holdings_strict": _sql(
        """SELECT portfolio_id, stock_symbol, CAST(q AS DOUBLE) AS total_quantity, CAST(cost AS DOUBLE) AS total_cost,
        CAST(cost AS DOUBLE) / CAST(q AS DOUBLE) AS average_cost
        FROM (SELECT portfolio_id, stock_symbol,
                     sum(CASE flag WHEN 'N' THEN quantity WHEN 'R' THEN -quantity END) AS q,
                     sum(CASE flag WHEN 'N' THEN quantity * price WHEN 'R' THEN -quantity * price END) AS cost
              FROM transactions GROUP BY portfolio_id, stock_symbol) WHERE q > 0""",
        "transactions",
    ),
    "position_values": _sql(
        """SELECT stock_symbol, portfolio_id, CAST(q AS DOUBLE) AS total_quantity, CAST(cost AS DOUBLE) AS total_cost,
        CAST(cost AS DOUBLE) / CAST(q AS DOUBLE) AS average_cost, CAST(close AS DOUBLE) AS current_price,
        CAST(value AS DOUBLE) AS market_value, CAST(value - cost AS DOUBLE) AS unrealized_gain,
        CASE WHEN cost <> 0 THEN CAST(value - cost AS DOUBLE) / CAST(cost AS DOUBLE) * 100 END AS unrealized_gain_pct
        FROM (SELECT h.*, p.close, CAST(q AS DECIMAL(15,0)) * p.close AS value FROM holdings h JOIN
              (SELECT stock_symbol, arg_max(close, "timestamp") AS close FROM stock_prices
               WHERE "timestamp" <= TIMESTAMP '2000-01-01' GROUP BY stock_symbol) p
              ON h.stock_symbol = p.stock_symbol)""",
        "holdings",
        "stock_prices",
    ),
    "portfolio_value": _sql(
        """SELECT portfolio_id, CAST(v AS DOUBLE) AS total_value, CAST(c AS DOUBLE) AS total_cost,
        CAST(v - c AS DOUBLE) AS unrealized_gain,
        CASE WHEN c > 0 THEN CAST(v - c AS DOUBLE) / CAST(c AS DOUBLE) * 100 ELSE 0 END AS unrealized_gain_pct
        FROM (SELECT f.portfolio_id, COALESCE(sum(value), 0) AS v, COALESCE(sum(cost), 0) AS c
              FROM portfolios f LEFT JOIN positions p ON f.portfolio_id = p.portfolio_id GROUP BY f.portfolio_id)""",
        "portfolios",
        "positions",
    ),
    "portfolio_returns": _sql(
        """SELECT portfolio_id, s AS start_value, e AS end_value, e - s AS total_return,
        CASE WHEN s > 0 THEN (e - s) / s * 100 ELSE 0 END AS total_return_pct
        FROM (SELECT portfolio_id, CAST(COALESCE(sum(CAST(q AS DECIMAL(15,0)) * a), 0) AS DOUBLE) AS s,
                     CAST(COALESCE(sum(CAST(q AS DECIMAL(15,0)) * b), 0) AS DOUBLE) AS e
              FROM (SELECT * FROM portfolios LEFT JOIN holdings USING (portfolio_id)) h LEFT JOIN (
                SELECT stock_symbol, arg_max(close, "timestamp") FILTER ("timestamp" <= TIMESTAMP '1997-01-01') AS a,
                       arg_max(close, "timestamp") FILTER ("timestamp" <= TIMESTAMP '1999-06-30') AS b
                FROM stock_prices GROUP BY stock_symbol) p ON h.stock_symbol = p.stock_symbol GROUP BY portfolio_id)""",
        "holdings",
        "stock_prices",
        "portfolios",
    ),
    "daily_portfolio_values": _sql(
        """SELECT portfolio_id, CAST(day AS TIMESTAMP) AS day, round(CAST(value AS DOUBLE), 2) AS total_value,
        round(CAST(flow AS DOUBLE), 2) AS net_flow, round(pct, 6) AS daily_return_pct FROM day_values""",
        "day_values",
    ),
    "portfolio_drawdowns": _sql(
        f"SELECT portfolio_id, round(max_drawdown, 6) AS max_drawdown FROM ({_falls('day_totals', 'portfolio_id', 'day', 'value')})",
        "day_totals",
    ),
    "tick_drawdowns": _sql(
        f"""SELECT stock_symbol, round(max_drawdown, 6) AS max_drawdown
        FROM ({_falls('ticks', 'stock_symbol', '"timestamp"', 'close')})""",
        "ticks",
    ),
    "risk_metrics": _sql(
        _risk(
            "\"timestamp\" BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-06-30'",
            False,
            _falls("(SELECT * FROM day_totals WHERE day BETWEEN DATE '1997-01-01' AND DATE '1999-06-30')", "portfolio_id", "day", "value"),
        ),
        "holdings",
        "stock_prices",
        "day_totals",
    ),
    "risk_metrics_annualized": _sql(
        _risk("TRUE", True, owners="portfolios"), "holdings", "stock_prices", "portfolios"
    ),
    "daily_returns": _sql(_returns("stock_prices"), "stock_prices"),
    "tick_returns": _sql(_returns("ticks"), "ticks"),
    "latest_prices": _sql("SELECT stock_symbol, CAST(close AS DOUBLE) AS current_price FROM last_close", "last_close"),
    "latest_prices_asof": _sql(
        """SELECT stock_symbol, CAST(close AS DOUBLE) AS current_price FROM (
        SELECT *, row_number() OVER (PARTITION BY stock_symbol ORDER BY "timestamp" DESC) AS rn FROM stock_prices
        WHERE "timestamp" <= TIMESTAMP '2000-01-01') WHERE rn = 1""",
        "stock_prices",
    ),
    "latest_fx": _sql("SELECT * FROM latest_rates", "latest_rates"),
    "fx_multiplier": _sql(
        """SELECT b.base_currency, s.stock_symbol, s.quote_currency,
        CASE WHEN s.quote_currency = b.base_currency THEN 1.0::DOUBLE WHEN d.rate IS NOT NULL THEN 1.0::DOUBLE / d.rate
             WHEN i.rate IS NOT NULL THEN i.rate ELSE 1.0::DOUBLE END AS fx_multiplier
        FROM security_view s CROSS JOIN (SELECT 'AUD' AS base_currency UNION ALL SELECT 'USD') b
        LEFT JOIN latest_rates d ON d.base_currency = b.base_currency AND d.quote_currency = s.quote_currency
        LEFT JOIN latest_rates i ON i.quote_currency = b.base_currency AND i.base_currency = s.quote_currency""",
        "security_view",
        "latest_rates",
    ),
    "holdings_base_value": _sql(
        """SELECT stock_symbol, portfolio_id, CAST(q AS DOUBLE) AS total_quantity, CAST(cost AS DOUBLE) AS total_cost,
        CAST(cost AS DOUBLE) / CAST(q AS DOUBLE) AS average_cost, CAST(close AS DOUBLE) AS current_price,
        CAST(value AS DOUBLE) AS local_market_value, gics_sector, gics_sector_code, country_code, quote_currency,
        market_code, fx AS fx_multiplier, round(CAST(value AS DOUBLE) * fx, 4) AS market_value_base FROM valued""",
        "valued",
    ),
    "sector_allocation": _sql(
        """SELECT portfolio_id, gics_sector, round(v, 2) AS market_value_base,
        round(CASE WHEN sum(v) OVER (PARTITION BY portfolio_id) > 0
              THEN v / sum(v) OVER (PARTITION BY portfolio_id) * 100 ELSE 0 END, 6) AS weight_pct,
        CAST(q AS DOUBLE) AS total_quantity, round(f, 8) AS avg_fx_rate
        FROM (SELECT portfolio_id, gics_sector, sum(CAST(value AS DOUBLE) * fx) AS v, sum(q) AS q, avg(fx) AS f
              FROM valued GROUP BY portfolio_id, gics_sector)""",
        "valued",
    ),
    "region_allocation": _sql(
        """SELECT portfolio_id, country_code, market_code, round(v, 2) AS market_value_base,
        round(CASE WHEN sum(v) OVER (PARTITION BY portfolio_id) > 0
              THEN v / sum(v) OVER (PARTITION BY portfolio_id) * 100 ELSE 0 END, 6) AS weight_pct
        FROM (SELECT portfolio_id, country_code, market_code, sum(CAST(value AS DOUBLE) * fx) AS v
              FROM valued GROUP BY portfolio_id, country_code, market_code)""",
        "valued",
        base="USD",
    ),
    "securities_view": _sql("SELECT * FROM security_view", "security_view"),
    "weighted_holdings": _sql(_WEIGHTED, "weighted"),
    "stream_holdings_state": _sql(_WEIGHTED, "weighted"),
    "verify_holdings": _sql(
        f"""SELECT portfolio_id, stock_symbol, quantity, round(average_cost, 6) AS average_cost, current_price,
        round(total_cost, 2) AS total_cost, current_value, round(pnl_pct, 6) AS pnl_pct FROM {_VERIFIED}""",
        "weighted",
        "last_close",
    ),
    "verified_totals": _sql(
        f"""SELECT portfolio_id, round(c, 2) AS total_cost, round(v, 2) AS current_value, round(v - c, 2) AS pnl,
        round(CASE WHEN c > 0 THEN (v - c) / c * 100 ELSE 0 END, 6) AS pnl_pct
        FROM (SELECT portfolio_id, sum(total_cost) AS c, sum(current_value) AS v FROM {_VERIFIED} GROUP BY portfolio_id)""",
        "weighted",
        "last_close",
    ),
    "holdings_report": _sql(_REPORT, "positions"),
    "holdings_totals_rollup": _sql(
        f"""SELECT portfolio_id, symbol, CAST(c AS DOUBLE) AS cost, CAST(v AS DOUBLE) AS value, CAST(v - c AS DOUBLE) AS pnl,
        round(CASE WHEN c > 0 THEN CAST(v - c AS DOUBLE) / CAST(c AS DOUBLE) * 100 ELSE 0 END, 6) AS pnl_pct
        FROM (SELECT portfolio_id, CASE WHEN GROUPING(symbol) = 1 THEN 'TOTAL' ELSE symbol END AS symbol,
                     sum(CAST(avg_cost AS DECIMAL(14,2)) * CAST(quantity AS DECIMAL(14,0))) AS c,
                     sum(CAST(market_value AS DECIMAL(24,2))) AS v
              FROM ({_REPORT}) GROUP BY GROUPING SETS ((portfolio_id, symbol), (portfolio_id)))""",
        "positions",
    ),
    "holdings_listing": _sql(
        """SELECT p.name, k.name AS stock_name, stock_symbol, quantity, round(average_cost, 6) AS average_cost,
        round(quantity * average_cost, 2) AS total_cost
        FROM weighted w JOIN portfolios p ON w.portfolio_id = p.portfolio_id JOIN stocks k ON k.symbol = w.stock_symbol""",
        "weighted",
        "portfolios",
        "stocks",
    ),
    "equal_allocation": _sql(
        """SELECT stock_symbol, 'BUY' AS transaction_type, quantity, CAST(price AS DOUBLE) AS price, bought_at AS transaction_date
        FROM (SELECT stock_symbol, price, bought_at, CAST(floor(2000000::DOUBLE / n / CAST(price AS DOUBLE)) AS BIGINT) AS quantity
              FROM (SELECT stock_symbol, any_value(bought_at) AS bought_at, any_value(n) AS n, arg_max(close, "timestamp") AS price
                    FROM stock_prices CROSS JOIN (SELECT max("timestamp") - INTERVAL 7 DAYS AS bought_at,
                                                         count(DISTINCT stock_symbol) AS n FROM stock_prices)
                    WHERE "timestamp" <= bought_at GROUP BY stock_symbol)) WHERE quantity > 0""",
        "stock_prices",
    ),
    "portfolio_metrics": _sql(
        f"""SELECT v.portfolio_id, TIMESTAMP '2002-01-01' AS calculation_date, total_value, total_cost,
        round(COALESCE(realized, 0), 2) AS realized_gains, unrealized_gains,
        CASE WHEN total_cost > 0 THEN unrealized_gains / total_cost * 100 ELSE 0 END AS total_return_pct,
        volatility, sharpe_ratio, max_drawdown AS max_drawdown_pct, round(pct, 6) AS daily_return_pct
        FROM (SELECT f.portfolio_id, CAST(COALESCE(sum(value), 0) AS DOUBLE) AS total_value,
                     CAST(COALESCE(sum(cost), 0) AS DOUBLE) AS total_cost,
                     CAST(COALESCE(sum(value - cost), 0) AS DOUBLE) AS unrealized_gains
              FROM portfolios f LEFT JOIN positions p ON f.portfolio_id = p.portfolio_id GROUP BY f.portfolio_id) v
        LEFT JOIN ({_risk('TRUE', False, _falls('day_totals', 'portfolio_id', 'day', 'value'), 'portfolios')}) r
          ON v.portfolio_id = r.portfolio_id
        LEFT JOIN (SELECT portfolio_id, arg_max(pct, day) AS pct FROM day_values WHERE pct IS NOT NULL GROUP BY portfolio_id) d
          ON v.portfolio_id = d.portfolio_id
        LEFT JOIN (SELECT portfolio_id, sum(realized_gain) AS realized FROM weighted_all GROUP BY portfolio_id) g
          ON v.portfolio_id = g.portfolio_id""",
        "portfolios",
        "positions",
        "stock_prices",
        "weighted_all",
        "day_values",
    ),
    "cross_rates": _sql(
        """SELECT a AS from_currency, b AS to_currency, rate, CAST(hops AS BIGINT) AS hops,
        array_to_string(path, '>') AS path FROM crossed""",
        "crossed",
    ),
    "fx_multiplier_cross": _sql(
        """SELECT base_currency, stock_symbol, s.quote_currency,
        CASE WHEN s.quote_currency = base_currency THEN 1.0::DOUBLE ELSE rate END AS fx_multiplier
        FROM (SELECT stock_symbol, quote_currency FROM security_view UNION ALL SELECT 'UNQUOTED', 'XAU') s
        CROSS JOIN (SELECT unnest(['SGD', 'USD']) AS base_currency)
        LEFT JOIN crossed ON a = s.quote_currency AND b = base_currency""",
        "security_view",
        "crossed",
    ),
    "ema_recursive": _sql(
        """SELECT m.stock_symbol, m."timestamp", CAST(close AS DOUBLE) AS close, round(ema_12, 4) AS ema_12,
        round(ema_26, 4) AS ema_26 FROM means m JOIN numbered_closes c ON m.stock_symbol = c.stock_symbol AND m.rn = c.rn""",
        "means",
    ),
    "macd_recursive_ticks": _sql(
        """SELECT m.stock_symbol, m."timestamp", CAST(close AS DOUBLE) AS close, round(ema_12, 4) AS ema_12,
        round(ema_26, 4) AS ema_26, round(ema_12 - ema_26, 4) AS macd, round(signal, 4) AS macd_signal
        FROM tick_means m JOIN numbered_ticks c ON m.stock_symbol = c.stock_symbol AND m.rn = c.rn
        JOIN tick_signal s ON m.stock_symbol = s.stock_symbol AND m.rn = s.rn""",
        "tick_signal",
    ),
    "sma": _sql(
        f"""SELECT stock_symbol, "timestamp", CAST(close AS DOUBLE) AS close, {_mean(20)} AS sma_20, {_mean(50)} AS sma_50,
        {_mean(200)} AS sma_200 FROM stock_prices""",
        "stock_prices",
    ),
    "ema_simple": _sql(
        f"""SELECT stock_symbol, "timestamp", CAST(close AS DOUBLE) AS close, {_mean(12)} AS ema_12, {_mean(26)} AS ema_26
        FROM stock_prices""",
        "stock_prices",
    ),
    "rsi": _sql(
        f"""SELECT stock_symbol, "timestamp", CAST(close AS DOUBLE) AS close, rsi_14
        FROM {_indicators('stock_prices', '100')}""",
        "stock_prices",
    ),
    "bollinger": _sql(
        f"""SELECT stock_symbol, "timestamp", CAST(close AS DOUBLE) AS close,
        round(sma_20 + 2 * spread, 3) AS bollinger_upper, round(sma_20 - 2 * spread, 3) AS bollinger_lower
        FROM {_indicators('stock_prices')}""",
        "stock_prices",
    ),
    "macd": _sql(
        f"""SELECT stock_symbol, "timestamp", CAST(close AS DOUBLE) AS close, ema_12, ema_26, macd,
        round(macd_signal, 4) AS macd_signal FROM {_indicators('stock_prices')}""",
        "stock_prices",
    ),
    "all_indicators": _sql(_ALL_INDICATORS.format(source=_indicators("stock_prices")), "stock_prices"),
    "all_indicators_ticks": _sql(_ALL_INDICATORS.format(source=_indicators("ticks")), "ticks"),
    "store_indicators": _sql(
        f"""SELECT stock_symbol, "timestamp", rsi_14, {', '.join(
            f'CAST(CAST({c} AS DECIMAL(20,6)) AS DOUBLE) AS {c}'
            for c in ('sma_20', 'sma_50', 'sma_200', 'ema_12', 'ema_26', 'macd'))}, {', '.join(
            f'CAST(round(CAST({v} AS DECIMAL(20,6)), 3) AS DOUBLE) AS {c}' for c, v in (
                ('macd_signal', 'macd_signal'), ('bollinger_upper', 'sma_20 + 2 * spread'), ('bollinger_lower', 'sma_20 - 2 * spread')))}
        FROM {_indicators('ticks')}""",
        "ticks",
    ),
    "indicator_snapshot": _sql(
        f"""SELECT stock_symbol, "timestamp", current_price, sma, rsi, round(bb_upper, 4) AS bb_upper,
        round(bb_lower, 4) AS bb_lower, round(bb_width_pct, 4) AS bb_width_pct
        FROM {_SNAPSHOT.format(table='stock_prices')}""",
        "stock_prices",
    ),
    "signals": _sql(
        f"""SELECT stock_symbol, "timestamp",
        CASE WHEN rsi > 70 THEN 'overbought' WHEN rsi < 30 THEN 'oversold' ELSE 'neutral' END AS rsi_signal,
        CASE WHEN current_price > bb_upper THEN 'above_upper' WHEN current_price < bb_lower THEN 'below_lower'
             ELSE 'within' END AS band_signal,
        CASE WHEN current_price > sma THEN 'bullish' ELSE 'bearish' END AS trend_signal
        FROM {_SNAPSHOT.format(table='ticks')}""",
        "ticks",
    ),
    "daily_bars": _sql(_BARS, "ticks"),
    "stream_daily_bars": _sql(_BARS, "ticks"),
    "bars_refresh_window": _sql(
        f"""SELECT * FROM ({_BARS}) WHERE bucket >= TIMESTAMP '2024-01-17 12:00:00'
        AND bucket + INTERVAL 1 DAY <= TIMESTAMP '2024-01-20 11:00:00'""",
        "ticks",
    ),
    "stream_upsert_prices": _sql(
        'SELECT stock_symbol, "timestamp", CAST(close AS DOUBLE) AS close, volume FROM ticks', "ticks"
    ),
    "asof_join": _sql(
        """SELECT t.transaction_id, t.stock_symbol, t.transaction_date, CAST(p.close AS DOUBLE) AS previous_close,
        p."timestamp" AS previous_date FROM transactions t ASOF LEFT JOIN stock_prices p
        ON t.stock_symbol = p.stock_symbol AND t.transaction_date > p."timestamp\"""",
        "transactions",
        "stock_prices",
    ),
    "asof_join_events": """SELECT e.event_id, e.user_id, e.ts, p.value AS last_purchase FROM events e
        ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase') p
        ON e.user_id = p.user_id AND e.ts >= p.ts""",
    "asof_join_one_key": """SELECT e.event_id, e.ts, p.event_id AS error_id, p.value AS error_value FROM events e
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') p ON e.ts >= p.ts""",
    "latest_n_prices": _sql(
        """SELECT stock_symbol, "timestamp", CAST(close AS DOUBLE) AS close, rn FROM (
        SELECT *, row_number() OVER (PARTITION BY stock_symbol ORDER BY "timestamp" DESC) AS rn FROM stock_prices)
        WHERE rn <= 10""",
        "stock_prices",
    ),
    "portfolio_transactions": _sql(
        """SELECT transaction_id, portfolio_id, stock_symbol, transaction_type, CAST(quantity AS DOUBLE) AS quantity,
        CAST(price AS DOUBLE) AS price, transaction_date FROM transactions WHERE portfolio_id = '7'""",
        "transactions",
    ),
    "prices_range": _sql(
        """SELECT stock_symbol, "timestamp", CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
        CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume FROM stock_prices
        WHERE stock_symbol IN ('Brand#3', 'Brand#12', 'Brand#21')
        AND "timestamp" BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-06-30'""",
        "stock_prices",
    ),
    "held_prices": _sql(
        """SELECT stock_symbol, "timestamp", CAST(close AS DOUBLE) AS close FROM stock_prices
        WHERE stock_symbol IN (SELECT stock_symbol FROM holdings)""",
        "stock_prices",
        "holdings",
    ),
    "price_summary": _sql(
        """SELECT stock_symbol, count(close) AS records, CAST(min(close) AS DOUBLE) AS min_price,
        CAST(max(close) AS DOUBLE) AS max_price, CAST(sum(close) AS DOUBLE) / count(close) AS avg_price
        FROM stock_prices GROUP BY stock_symbol""",
        "stock_prices",
    ),
    "coverage_summary": _sql(
        """SELECT b.stock_symbol, count("timestamp") AS price_count, min("timestamp") AS first_date,
        max("timestamp") AS last_date FROM brands b LEFT JOIN
        stock_prices p ON b.stock_symbol = p.stock_symbol
        GROUP BY b.stock_symbol""",
        "brands",
        "stock_prices",
    ),
    "portfolio_invested": _sql(
        """SELECT p.portfolio_id, p.name, count(t.transaction_id) AS transactions,
        CAST(COALESCE(sum(CASE WHEN t.transaction_type = 'BUY' THEN t.quantity * t.price ELSE 0 END), 0) AS DOUBLE) AS invested
        FROM portfolios p LEFT JOIN transactions t ON p.portfolio_id = t.portfolio_id GROUP BY p.portfolio_id, p.name""",
        "portfolios",
        "transactions",
    ),
    "top_portfolio": _sql(
        """SELECT p.portfolio_id, p.name, count(t.transaction_id) AS transactions
        FROM portfolios p LEFT JOIN transactions t ON p.portfolio_id = t.portfolio_id GROUP BY p.portfolio_id, p.name
        ORDER BY 3 DESC, 1 LIMIT 1""",
        "portfolios",
        "transactions",
    ),
    "table_counts": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _COUNTED),
    "load_totals": _sql(
        """SELECT s.stock_symbol, count(t.close) AS records
        FROM (SELECT stock_symbol FROM ticks UNION SELECT stock_symbol FROM securities) s
        LEFT JOIN ticks t ON s.stock_symbol = t.stock_symbol GROUP BY s.stock_symbol
        UNION ALL SELECT '__fx__', count(*) FROM rates UNION ALL SELECT '__total__', count(*) FROM ticks""",
        "ticks",
        "securities",
        "rates",
    ),
    "infer_market_codes": _sql(
        f"""SELECT p_partkey, ticker, {_by_suffix(_CODES, 'NULL')} AS market_code,
        {_by_suffix(_COUNTRIES, 'NULL')} AS country_code, {_by_suffix(_CURRENCIES, "'USD'")} AS quote_currency
        FROM tickers""",
        "tickers",
    ),
    "sector_codes": "SELECT p_partkey, replace(lower(p_name), ' ', '_') AS sector_code FROM part",
    "fx_pair_split": """SELECT substr(c, 1, 3) AS base_currency, substr(c, 4, 3) AS quote_currency, count(*) AS tickers
        FROM (SELECT replace(upper(t), '=X', '') AS c FROM (
              SELECT event_type || '=x' AS t FROM events UNION ALL SELECT c_mktsegment FROM customer))
        WHERE length(c) >= 6 GROUP BY ALL""",
    "normalize_ohlcv": _sql(
        """SELECT upper(stock_symbol) AS stock_symbol, "timestamp", open, high, low, close, volume, close AS adjusted_close
        FROM feed WHERE close IS NOT NULL AND open IS NOT NULL""",
        "feed",
    ),
    "rejected_rows": _sql(
        """SELECT upper(stock_symbol) AS stock_symbol, "timestamp", close, volume FROM feed
        WHERE close IS NOT NULL AND open IS NULL""",
        "feed",
    ),
    "landed_feed": _sql(
        """SELECT stock_symbol, "timestamp", CAST(close AS DOUBLE) AS open, CAST(close AS DOUBLE) AS high, CAST(close AS DOUBLE) AS low,
        CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume FROM ticks
        WHERE volume % 19 <> 3 AND volume % 23 <> 5 AND volume % 29 <> 2""",
        "ticks",
    ),
    "quarantined_feed": _sql(
        """SELECT stock_symbol, reason, count(*) AS records FROM (
          SELECT CASE WHEN volume % 19 = 3 OR volume % 23 = 5 THEN upper(stock_symbol) END AS stock_symbol,
                 CASE WHEN volume % 19 = 3 OR volume % 23 = 5 THEN 'malformed' ELSE 'no symbol' END AS reason FROM ticks
          WHERE volume % 19 = 3 OR volume % 23 = 5 OR volume % 29 = 2) GROUP BY ALL""",
        "ticks",
    ),
    "landed_source": _sql(
        """SELECT stock_symbol, "timestamp", CAST(close AS DOUBLE) AS open, CAST(close AS DOUBLE) AS high, CAST(close AS DOUBLE) AS low,
        CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume FROM ticks WHERE stock_symbol = 'click' AND close >= 20""",
        "ticks",
    ),
    "landed_source_stream": _sql(
        """SELECT upper(stock_symbol) AS stock_symbol, "timestamp", CAST(close AS DOUBLE) AS close, volume FROM ticks""", "ticks"
    ),
    "stream_dedup_prices": _sql(
        """SELECT stock_symbol, "timestamp", CAST(CASE WHEN volume % 7 = 1 THEN close + 1 ELSE close END AS DOUBLE) AS close, volume
        FROM ticks""",
        "ticks",
    ),
    "wide_feed": _sql(
        f"""SELECT bucket AS "timestamp", stock_symbol, open, high, low, close, CAST(volume AS DOUBLE) AS volume
        FROM ({_BARS})""",
        "ticks",
    ),
    "normalize_fx": _sql("SELECT * FROM rates", "rates"),
    "watchlist_flat": _sql(_flat(), "flat"),
    "watchlist_regions": _sql(_flat("region IN ('AU', 'SG')"), "flat"),
    "dq_watchlist": _sql(
        f"""SELECT watchlist_id, stock_symbol, concat_ws(',', CASE WHEN gics_sector_code = 'new_energy' THEN 'sector' END,
        CASE WHEN market_code IS NULL THEN 'market' END,
        CASE WHEN NOT ends_with(stock_symbol, suffix) THEN 'suffix' END) AS problems
        FROM (SELECT *, CASE market_code {' '.join(f"WHEN '{m}' THEN '{s}'" for m, s in zip(_CODES, MARKETS))} END AS suffix
              FROM ({_flat()}))
        WHERE gics_sector_code = 'new_energy' OR market_code IS NULL OR NOT ends_with(stock_symbol, suffix)""",
        "flat",
    ),
    "upsert_prices": _sql(_CORRECTED.format(table="stock_prices"), "stock_prices"),
    "lake_upsert_prices": _sql(_CORRECTED.format(table="stock_prices"), "stock_prices"),
    "upsert_fx": _sql('SELECT base_currency, quote_currency, "timestamp", rate * 2 AS rate FROM rates', "rates"),
    "insert_if_absent": _sql(
        """SELECT base_currency, quote_currency, "timestamp",
        CASE WHEN "timestamp" < TIMESTAMP '2024-01-20' THEN rate ELSE rate * 2 END AS rate FROM rates""",
        "rates",
    ),
    "update_by_ids": _sql(
        """SELECT id, symbol, CASE WHEN hit THEN 'Changed' ELSE sector END AS sector,
        CASE WHEN NOT hit THEN quote_currency END AS quote_currency,
        CASE WHEN hit THEN TIMESTAMP '2024-03-01' ELSE updated_at END AS updated_at
        FROM (SELECT *, CAST(split_part(id, '-', 2) AS INTEGER) % 3 = 0 AS hit FROM stocks)""",
        "stocks",
    ),
    "stored_writes": _sql(
        """SELECT base_currency, quote_currency, "timestamp",
        CASE WHEN "timestamp" < TIMESTAMP '2024-01-20' THEN rate ELSE rate * 2 END AS rate FROM rates WHERE base_currency <> 'NZD'
        UNION ALL SELECT 'appended', NULL, NULL, count(*) FROM rates WHERE "timestamp" < TIMESTAMP '2024-01-20'
        UNION ALL SELECT 'inserted', NULL, NULL, count(*) FROM rates WHERE "timestamp" >= TIMESTAMP '2024-01-20'
        UNION ALL SELECT 'all left', NULL, NULL, 0""",
        "rates",
    ),
    "coalesce_update": _sql(
        """SELECT k.id, k.symbol, COALESCE(s.gics_sector, k.sector) AS sector,
        COALESCE(s.quote_currency, k.quote_currency) AS quote_currency,
        COALESCE(s.gics_sector, k.gics_sector_override) AS gics_sector_override,
        CASE WHEN s.stock_symbol IS NOT NULL THEN TIMESTAMP '2024-03-01' ELSE k.updated_at END AS updated_at
        FROM stocks k LEFT JOIN securities s ON k.symbol = s.stock_symbol""",
        "stocks",
        "securities",
    ),
    "register_securities": _sql(
        f"""SELECT upper(symbol) AS symbol, name, exchange,
        CASE WHEN hit THEN 'Utilities' ELSE sector END AS sector, CASE WHEN hit THEN 'SG' ELSE country_code END AS country_code,
        CASE WHEN hit THEN 'SGD' ELSE quote_currency END AS quote_currency,
        CASE WHEN hit THEN 4 ELSE gics_sector_id END AS gics_sector_id, CASE WHEN hit THEN 4 ELSE market_id END AS market_id,
        CASE WHEN hit THEN 'Utilities' ELSE gics_sector_override END AS gics_sector_override,
        CASE WHEN hit THEN TIMESTAMP '2024-03-01' ELSE updated_at END AS updated_at
        FROM (SELECT *, CAST(split_part(symbol, '#', 2) AS INTEGER) % 2 = 0 AS hit FROM stocks)
        UNION ALL
        SELECT upper(stock_symbol) || '.NEW', upper(stock_symbol) || '.NEW', 'SGX', 'Utilities', 'SG', 'SGD', 4, 4, 'Utilities',
               TIMESTAMP '2024-03-01' FROM brands WHERE n % 2 = 1
        UNION ALL
        SELECT upper(ticker), upper(ticker), COALESCE({_by_suffix(_CODES, 'NULL')}, ''), '', {_by_suffix(_COUNTRIES, 'NULL')},
               {_by_suffix(_CURRENCIES, "'USD'")}, 1, CAST({_by_suffix(range(1, 5), 'NULL')} AS INTEGER), NULL, TIMESTAMP '2024-03-01'
        FROM (SELECT DISTINCT ticker FROM tickers)""",
        "stocks",
        "brands",
        "tickers",
    ),
    "delete_by_ids": _sql(
        """SELECT transaction_id, portfolio_id, CAST(quantity AS DOUBLE) AS quantity FROM transactions
        WHERE transaction_type <> 'SELL'""",
        "transactions",
    ),
    "export_prices": _sql(
        """SELECT stock_symbol, "timestamp", CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
        CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume FROM stock_prices
        WHERE "timestamp" BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-06-30'""",
        "stock_prices",
    ),
    "export_transactions": _sql(
        """SELECT transaction_id, portfolio_id, stock_symbol, transaction_type, CAST(quantity AS DOUBLE) AS quantity,
        CAST(price AS DOUBLE) AS price, transaction_date FROM transactions
        WHERE transaction_date <= TIMESTAMP '1999-06-30'""",
        "transactions",
    ),
    "export_securities": _sql(
        f"""SELECT k.symbol AS stock_symbol, k.name, k.exchange, k.country_code, k.quote_currency,
        COALESCE(g.name, k.gics_sector_override, k.sector) AS gics_sector,
        replace(lower(g.name), ' ', '_') AS gics_sector_code, m.code AS market_code, k.gics_sector_override
        FROM stocks k LEFT JOIN ({_OPERATIONAL_SECTORS}) g ON k.gics_sector_id = g.id
        LEFT JOIN ({_OPERATIONAL_MARKETS}) m ON k.market_id = m.id""",
        "stocks",
    ),
    "export_fx": _sql("SELECT * FROM rates WHERE \"timestamp\" >= TIMESTAMP '2024-01-20'", "rates"),
    "incremental_export": _sql(_PUBLISHED, "stock_prices", "transactions", "stocks", "rates"),
    "full_export": _sql(_PUBLISHED, "stock_prices", "transactions", "stocks", "rates"),
    "full_export_counts": _sql(
        """SELECT 'stock_prices' AS table_name, count(*) AS row_count FROM stock_prices
        UNION ALL SELECT 'transactions', count(*) FROM transactions UNION ALL SELECT 'securities', count(*) FROM stocks
        UNION ALL SELECT 'exchange_rates', count(*) FROM rates""",
        "stock_prices",
        "transactions",
        "stocks",
        "rates",
    ),
    "etl_run": _sql(
        """, daily AS (SELECT upper(stock_symbol) AS s, "timestamp" AS bucket, CAST(close AS DOUBLE) AS close FROM ticks),
        bought AS (SELECT s, floor(100000::DOUBLE / n / p) AS q, p FROM (
          SELECT s, any_value(n) AS n, arg_max(close, bucket) AS p FROM daily CROSS JOIN
            (SELECT max(bucket) - INTERVAL 7 DAYS AS bought_at, count(DISTINCT s) AS n FROM daily) WHERE bucket <= bought_at GROUP BY s)
          WHERE floor(100000::DOUBLE / n / p) > 0)
        SELECT s AS item, count(*) AS records, CAST(NULL AS DOUBLE) AS amount FROM daily GROUP BY s
        UNION ALL SELECT '__fx__', count(*), NULL FROM daily UNION ALL SELECT '__total__', count(*), NULL FROM daily
        UNION ALL SELECT '__rejected__', 0, NULL UNION ALL SELECT '__transactions__', count(*), NULL FROM bought
        UNION ALL SELECT '__value__p1', 1, round(sum(q * c), 2) FROM bought
          JOIN (SELECT s, arg_max(close, bucket) AS c FROM daily GROUP BY s) l ON bought.s = l.s""",
        "ticks",
    ),
    "dq_nulls": _sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {n} AS null_count FROM transactions"
            for c, n in [
                (c, "count(*) FILTER (transaction_type <> 'BUY')" if c == "price" else "count(*) FILTER (FALSE)")
                for c in (
                    "transaction_id portfolio_id stock_symbol transaction_type quantity price commission "
                    "transaction_date ingestion_timestamp"
                ).split()
            ]
        ),
        "transactions",
    ),
    "dq_domain": """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem
        WHERE l_returnflag NOT IN ('A', 'R')""",
    "dq_unique": """SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_orphans": _sql(
        """SELECT transaction_id, portfolio_id, stock_symbol FROM transactions
        WHERE stock_symbol NOT IN (SELECT stock_symbol FROM securities)""",
        "transactions",
        "securities",
    ),
    "dq_defaults": _sql(
        "SELECT stock_symbol, COALESCE(quote_currency, 'USD') AS quote_currency, gics_sector FROM securities", "securities"
    ),
    "dq_empty_feed": _sql(
        """SELECT stock_symbol FROM (SELECT stock_symbol FROM securities UNION SELECT stock_symbol FROM ticks)
        WHERE stock_symbol NOT IN (SELECT stock_symbol FROM stock_prices)""",
        "securities",
        "ticks",
        "stock_prices",
    ),
    "dq_reconcile": _sql(
        """SELECT COALESCE(w.portfolio_id, h.portfolio_id) AS portfolio_id,
        COALESCE(w.stock_symbol, h.stock_symbol) AS stock_symbol, w.quantity AS weighted_quantity,
        CAST(h.q AS DOUBLE) AS net_quantity, COALESCE(w.quantity, 0) - COALESCE(CAST(h.q AS DOUBLE), 0) AS difference
        FROM weighted w FULL JOIN holdings h ON w.portfolio_id = h.portfolio_id AND w.stock_symbol = h.stock_symbol
        WHERE COALESCE(w.quantity, 0) <> COALESCE(CAST(h.q AS DOUBLE), 0)""",
        "weighted",
        "holdings",
    ),
}
