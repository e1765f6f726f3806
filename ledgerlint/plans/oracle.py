"""SQL equivalents of the registered queries, for DuckDB.

Queries without an entry have no plain SQL form: file digests, the isolation
forest and runs that use it.
"""

from __future__ import annotations

from ledgerlint.config import (
    BASKET_PERCENTILES,
    CAP_LABELS,
    EU_COUNTRIES,
    HISTOGRAM_BINS,
    NORMALITY_ALPHA,
    NORMALITY_SAMPLE,
    WATERFALL_STEPS,
)
from ledgerlint.functions import normal
from ledgerlint.operators import normality
from ledgerlint.plans.queries import CONFIG, SALT
from ledgerlint.sources.schema import LINE_COLUMNS

COLUMNS = ", ".join(LINE_COLUMNS)
ORDER = "invoicedate, source_year, description, price, quantity, customer_id, country"
NULLS_FIRST = ", ".join(f"{c.strip()} NULLS FIRST" for c in ORDER.split(","))
EU = ", ".join(f"'{name}'" for name in EU_COUNTRIES)

TX = f"""
base AS (
  SELECT l_orderkey AS ok, l_partkey AS pk, l_linenumber AS ln,
         CAST(l_quantity AS BIGINT) AS q, l_extendedprice AS ep,
         o_orderdate AS od, o_custkey AS ck, c_nationkey AS nk, p_name AS pn
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
),
single AS (
  SELECT ok,
    CASE WHEN ok % 20 = 0 THEN concat('C', CAST(ok AS VARCHAR))
         ELSE CAST(ok AS VARCHAR) END AS invoice,
    concat('P', CAST(pk % 500 AS VARCHAR)) AS stockcode,
    CASE (ok + ln) % 97 WHEN 0 THEN concat('Test sample ', pn) WHEN 1 THEN 'manual'
         WHEN 2 THEN 'ADJUST bad debt' WHEN 3 THEN NULL ELSE pn END AS description,
    CASE WHEN (ok + pk) % 501 = 0 THEN 1000
         WHEN ok % 20 = 0 OR ok % 50 = 7 OR (ok % 40 = 11 AND ln = 3) THEN -q
         ELSE q END AS quantity,
    CAST(od AS TIMESTAMP) AS invoicedate,
    CASE WHEN (ok + 2 * pk) % 211 = 0 THEN 0e0 ELSE ep / 10e0 END AS price,
    CASE WHEN ck % 4 = 3 THEN NULL ELSE CAST(ck AS VARCHAR) END AS customer_id,
    CASE nk WHEN 1 THEN 'EIRE' WHEN 2 THEN 'Germany' WHEN 3 THEN 'France'
         WHEN 4 THEN 'Netherlands' WHEN 5 THEN 'Switzerland' WHEN 6 THEN 'Australia'
         WHEN 7 THEN NULL ELSE 'United Kingdom' END AS country,
    CASE WHEN od < TIMESTAMP '1998-01-01 00:00:00' THEN '1995-1997'
         ELSE '1998-2001' END AS source_year
  FROM base
),
tx AS (
  SELECT {COLUMNS} FROM single
  UNION ALL SELECT {COLUMNS} FROM single WHERE ok % 83 = 0
)"""

# Null-safe conditions.
CREDIT = "coalesce(starts_with(invoice, 'C'), false)"
PLACEHOLDER = "coalesce(abs(quantity) = 1000, false)"
KEYWORD = "coalesce(regexp_matches(description, 'TEST|MANUAL|ADJUST', 'i'), false)"
TECHNICAL = f"({PLACEHOLDER} OR {KEYWORD})"
EXTREME = "coalesce(price > 10000, false)"
NEGATIVE = "coalesce(quantity < 0, false)"
ZERO_SALE = f"(coalesce(price = 0, false) AND NOT {CREDIT})"
NEGATIVE_SALE = f"({NEGATIVE} AND NOT {CREDIT})"
BASKET = "CASE WHEN quantity > 0 THEN quantity * price ELSE 0e0 END"
BUCKET = f"""CASE WHEN country IS NULL THEN 'Unknown' WHEN country = 'United Kingdom' THEN 'UK'
  WHEN country IN ({EU}) THEN 'EU' ELSE 'NonEU' END"""
SURROGATE = "concat('anon_', coalesce(lower(country), 'unknown'))"

FLAGS = {
    "extreme_quantity": PLACEHOLDER,
    "extreme_price": EXTREME,
    "negative_quantity_sale": NEGATIVE_SALE,
    "zero_price_sale": ZERO_SALE,
    "technical_keyword": KEYWORD,
}


def _first(column: str, alias: str | None = None) -> str:
    return (
        f"first({column} ORDER BY {NULLS_FIRST}) FILTER (WHERE {column} IS NOT NULL)"
        f" AS {alias or column}"
    )


CARRIED = [c for c in LINE_COLUMNS if c not in ("invoice", "stockcode", "quantity")]

COLLAPSED = f"""
distinct_lines AS (SELECT DISTINCT {COLUMNS} FROM tx),
collapsed AS (
  SELECT invoice, stockcode, CAST(sum(quantity) AS BIGINT) AS quantity,
         {", ".join(_first(c) for c in CARRIED)}
  FROM distinct_lines
  WHERE invoice IS NOT NULL AND stockcode IS NOT NULL
  GROUP BY invoice, stockcode
)"""

# The cleaning steps one after another.
STEPS = f"""{COLLAPSED},
s2 AS (SELECT * FROM collapsed WHERE NOT {TECHNICAL}),
s3 AS (SELECT * FROM s2 WHERE price <= 10000),
s4 AS (SELECT * FROM s3 WHERE NOT {ZERO_SALE}),
repaired AS (
  SELECT invoice FROM s4 GROUP BY invoice
  HAVING bool_and({NEGATIVE}) AND NOT starts_with(invoice, 'C')
),
s5 AS (
  SELECT * REPLACE (CASE WHEN invoice IN (SELECT invoice FROM repaired)
                         THEN concat('C', invoice) ELSE invoice END AS invoice)
  FROM s4
),
s6 AS (SELECT * FROM s5 WHERE NOT {NEGATIVE_SALE}),
s7 AS (SELECT * FROM s6 WHERE customer_id IS NOT NULL),
s7i AS (
  SELECT * REPLACE (coalesce(customer_id, {SURROGATE}) AS customer_id),
         CAST(customer_id IS NULL AS INTEGER) AS missing_id
  FROM s6
)"""


def _caps(source: str) -> str:
    """Valued lines of ``source`` and their caps."""
    return f"""
valued AS (SELECT *, {BASKET} AS basket_value FROM {source}),
caps AS (
  SELECT
    quantile_cont(price, {CONFIG.price_cap_q}) FILTER (WHERE NOT {CREDIT}) AS price_cap,
    quantile_cont(basket_value, {CONFIG.basket_cap_q})
      FILTER (WHERE NOT {CREDIT} AND basket_value > 0) AS basket_cap
  FROM valued
)"""


CAP_ROW = """
  SELECT round(any_value(price_cap), 4) AS price_cap,
         round(any_value(basket_cap), 4) AS basket_cap,
         count(*) FILTER (WHERE price > price_cap) AS price_capped_count,
         count(*) FILTER (WHERE basket_value > basket_cap) AS basket_capped_count
  FROM valued, caps"""

CAPPED = """
  * REPLACE (round(CASE WHEN price > price_cap THEN price_cap ELSE price END, 4) AS price,
             round(CASE WHEN basket_value > basket_cap THEN basket_cap
                        ELSE basket_value END, 4) AS basket_value)"""


def _clean(source: str) -> str:
    return f"""
WITH {TX}, {STEPS}, {_caps(source)}
SELECT {CAPPED.replace("*", "* EXCLUDE (price_cap, basket_cap)", 1)},
       {BUCKET} AS country_bucket, CAST({CREDIT} AS INTEGER) AS is_cancelled
FROM valued, caps"""


def _select(body: str, extra: str = "") -> str:
    return f"WITH {TX}{extra} {body}"


def _kept(condition: str) -> str:
    return _select(f"SELECT {COLUMNS} FROM tx WHERE {condition}")


def _pct(part: str, whole: str, digits: int = 2) -> str:
    return f"round({part} * 100.0e0 / {whole}, {digits})"


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


COUNTS = {
    "initial": "tx",
    "collapse_duplicates": "collapsed",
    "drop_technical": "s2",
    "drop_extreme_prices": "s3",
    "drop_zero_price": "s4",
    "drop_negative_non_credit": "s6",
    "handle_missing_id": "s7",
    "isolation_forest": "s7",
}

WATERFALL = f"""
WITH {TX}, {STEPS},
counts AS ({_union([
    f"SELECT CAST({i} AS INTEGER) AS step_no, '{step}' AS step, "
    f"count(*) AS rows_remaining FROM {COUNTS[step]}"
    for i, step in enumerate(WATERFALL_STEPS)
])})
SELECT step_no, step, rows_remaining,
       coalesce(lag(rows_remaining) OVER (ORDER BY step_no) - rows_remaining, 0)
         AS rows_removed
FROM counts"""


def _metric(name: str, value: str, source: str = "") -> str:
    return f"SELECT '{name}' AS metric, CAST({value} AS DOUBLE) AS value {source}"


def _lost(before: str, after: str) -> str:
    return f"(SELECT count(*) FROM {before}) - (SELECT count(*) FROM {after})"


SUMMARY = f"""
WITH {TX}, {STEPS}, {_caps("s7")}, cap_row AS ({CAP_ROW})
{_union([
    _metric("initial_rows", "count(*)", "FROM tx"),
    _metric("final_rows", "count(*)", "FROM s7"),
    _metric("retention_pct",
            "round((SELECT count(*) FROM s7) * 100e0 / (SELECT count(*) FROM tx), 1)"),
    _metric("exact_duplicates", _lost("tx", "distinct_lines")),
    _metric("collapsed_lines", _lost("distinct_lines", "collapsed")),
    _metric("drop_technical", _lost("collapsed", "s2")),
    _metric("drop_extreme_prices", _lost("s2", "s3")),
    _metric("drop_zero_price", _lost("s3", "s4")),
    _metric("invoices_repaired", "count(*)", "FROM repaired"),
    _metric("drop_negative_non_credit", _lost("s5", "s6")),
    _metric("handle_missing_id", _lost("s6", "s7")),
    _metric("isolation_forest", "0"),
    _metric("price_cap", "price_cap", "FROM cap_row"),
    _metric("basket_cap", "basket_cap", "FROM cap_row"),
    _metric("price_capped_count", "price_capped_count", "FROM cap_row"),
    _metric("basket_capped_count", "basket_capped_count", "FROM cap_row"),
    _metric("column_count", str(len(LINE_COLUMNS) + 3)),
    _metric("price_cap_q", str(CONFIG.price_cap_q)),
    _metric("basket_cap_q", str(CONFIG.basket_cap_q)),
    _metric("isolation_contam", "0"),
])}"""


def _assertions(source: str) -> str:
    bad_price = f"coalesce(price <= 0, false) AND NOT {CREDIT}"
    in_range = (
        f"coalesce(invoicedate BETWEEN TIMESTAMP '{CONFIG.date_min}' "
        f"AND TIMESTAMP '{CONFIG.date_max}', false)"
    )
    counts = {
        "unique_invoice_stockcode": f"(SELECT count(*) FROM {source}) - (SELECT count(*) "
        f"FROM (SELECT DISTINCT invoice, stockcode FROM {source}))",
        "positive_sale_price": f"(SELECT count(*) FROM {source} WHERE {bad_price})",
        "date_in_range": f"(SELECT count(*) FROM {source} WHERE NOT {in_range})",
    }
    span = (
        "(SELECT strftime(min(invoicedate), '%Y-%m-%d %H:%M:%S') || ' to ' || "
        f"strftime(max(invoicedate), '%Y-%m-%d %H:%M:%S') FROM {source})"
    )
    rows = _union(
        [
            f"SELECT '{name}' AS \"check\", CAST({n} AS BIGINT) AS violations, "
            f"{span if name == 'date_in_range' else chr(39) * 2} AS observed"
            for name, n in counts.items()
        ]
    )
    return f"SELECT \"check\", violations, violations = 0 AS passed, observed FROM ({rows})"


def _load_checks(year: str) -> str:
    where = f"FROM tx WHERE source_year = '{year}'"
    first, last = "min(year(invoicedate))", "max(year(invoicedate))"
    checks = [
        ("not_empty", "error", "count(*) > 0", "count(*)"),
        ("required_columns", "error", "count(*) >= 0", "''"),
        ("invoice_not_all_null", "error", "count(invoice) > 0", "count(invoice)"),
        ("enough_rows", "warning", "count(*) >= 1000", "count(*)"),
        ("some_valid_date", "warning", f"{first} IS NOT NULL", first),
        ("usual_years", "warning",
         f"coalesce({first} >= 2000 AND {last} <= 2025, {first} IS NULL)",
         f"concat_ws('-', {first}, {last})"),
    ]
    return _union(
        [
            f"SELECT '{year}' AS source, '{name}' AS \"check\", '{severity}' AS severity, "
            f"{passed} AS passed, CAST({observed} AS VARCHAR) AS observed {where}"
            for name, severity, passed, observed in checks
        ]
    )


LOAD_CHECKS = _select(
    _union(
        [
            "SELECT 'all' AS source, 'same_columns' AS \"check\", 'warning' AS severity, "
            "true AS passed, '' AS observed",
            _load_checks("1995-1997"),
            _load_checks("1998-2001"),
        ]
    )
)

TYPES = dict(
    zip(
        LINE_COLUMNS,
        ("string", "string", "string", "bigint", "timestamp_ntz", "double",
         "string", "string", "string"),
    )
)
SCHEMA_ORDER = f"{NULLS_FIRST}, invoice NULLS FIRST, stockcode NULLS FIRST"
SCHEMA_OVERVIEW = _select(
    _union(
        [
            f"SELECT '{c}' AS column_name, '{TYPES[c]}' AS data_type, "
            f"(SELECT string_agg(v, ', ' ORDER BY rn) FROM (SELECT CAST({c} AS VARCHAR) AS v, "
            f"row_number() OVER (ORDER BY {SCHEMA_ORDER}) AS rn FROM tx "
            f"WHERE {c} IS NOT NULL QUALIFY rn <= 3)) AS example_values, "
            f"CAST({len(LINE_COLUMNS)} AS BIGINT) AS total_columns, "
            f"(SELECT count(*) FROM tx) AS total_rows"
            for c in LINE_COLUMNS
        ]
    )
)

NULL_COUNTS = _union(
    [
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        f"{_pct(f'(count(*) - count({c}))', 'count(*)')} AS null_pct, "
        f"count({c}) AS non_null_count FROM tx"
        for c in LINE_COLUMNS
    ]
)

UNIQUE_COUNTS = _union(
    [
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS unique_count, "
        f"{_pct(f'count(DISTINCT {c})', 'count(*)')} AS unique_pct, "
        f"count(*) AS total_count FROM tx"
        for c in LINE_COLUMNS
    ]
)

SANITY = {
    "missing_customer_id": "customer_id IS NULL",
    "nonpositive_quantity_sale": f"quantity <= 0 AND NOT {CREDIT}",
    "nonpositive_price_sale": f"price <= 0 AND NOT {CREDIT}",
    "credit_note": CREDIT,
}
SANITY_METRICS = _union(
    [
        f"SELECT '{name}' AS metric, count(*) FILTER (WHERE {c}) AS row_count, "
        f"{_pct(f'count(*) FILTER (WHERE {c})', 'count(*)')} AS row_pct FROM tx"
        for name, c in SANITY.items()
    ]
)

ANOMALY_SUMMARY = f"""
, counts AS ({_union([
    f"SELECT '{name}' AS flag, count(*) FILTER (WHERE {c}) AS row_count, "
    "count(*) AS total_count FROM tx"
    for name, c in FLAGS.items()
])}),
both_parts AS (
  SELECT * FROM counts
  UNION ALL SELECT 'total', CAST(sum(row_count) AS BIGINT), max(total_count) FROM counts
)"""

ANOMALY_EXAMPLES = _union(
    [
        f"SELECT * FROM (SELECT '{name}' AS flag, CAST(row_number() OVER (ORDER BY "
        f"{SCHEMA_ORDER}) AS INTEGER) AS example_no, invoice, stockcode, description, "
        f"quantity, price, customer_id FROM tx WHERE {c}) WHERE example_no <= 5"
        for name, c in FLAGS.items()
    ]
)

METRIC = """
, metric AS (
  SELECT invoice, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS total_quantity,
         avg(price) AS mean_price, count(*) AS line_count,
         coalesce(sum(quantity), 0) * avg(price) AS basket_value
  FROM tx WHERE invoice IS NOT NULL GROUP BY invoice
)"""

VALUES = f"""{METRIC},
vals AS (
  SELECT 'Quantity' AS variable, CAST(quantity AS DOUBLE) AS value FROM tx
  UNION ALL SELECT 'Unit Price', price FROM tx
  UNION ALL SELECT 'Basket Value', basket_value FROM tx JOIN metric USING (invoice)
)"""

# Prices and quantities that are null, infinite or negative; NaN is null once read.
TRAPS = """,
coded AS (SELECT *, CAST(substr(stockcode, 2) AS BIGINT) AS code FROM tx),
traps AS (
  SELECT * EXCLUDE (code) REPLACE (
    CASE (code * 7 + abs(quantity)) % 101 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'inf'::DOUBLE
         WHEN 3 THEN -price WHEN 4 THEN '-inf'::DOUBLE ELSE price END AS price,
    CASE WHEN (code + abs(quantity)) % 103 = 0 THEN NULL ELSE quantity END AS quantity)
  FROM coded
)"""
SANITY_METRICS_TRAPS = f"WITH {TX}{TRAPS} {SANITY_METRICS.replace('FROM tx', 'FROM traps')}"
FINITE_TRAPS = f"""
WITH {TX}{TRAPS}{METRIC.replace("tx", "traps")},
vals AS (
  SELECT 'Quantity' AS variable, CAST(quantity AS DOUBLE) AS value FROM traps
  UNION ALL SELECT 'Unit Price', price FROM traps
  UNION ALL SELECT 'Basket Value', basket_value FROM traps JOIN metric USING (invoice)
)
SELECT variable, count(*) AS row_count, round(min(value), 4) AS low, round(max(value), 4) AS high,
       round(avg(value), 4) AS mean
FROM vals WHERE value IS NOT NULL AND isfinite(value) GROUP BY variable"""

ROLLUP = f"""
, rollup_all AS (
  SELECT invoice, coalesce(sum(quantity * price), 0e0) AS basket_value,
         CAST(sum(quantity) AS BIGINT) AS total_quantity,
         {", ".join(
             _first(c).replace("country NULLS FIRST)", "country NULLS FIRST, stockcode NULLS FIRST)")
             for c in ("customer_id", "country", "invoicedate")
         )}
  FROM tx WHERE quantity > 0 AND invoice IS NOT NULL GROUP BY invoice
)"""

BASKET_VALS = f"""{ROLLUP},
vals AS (SELECT 'Sales Basket' AS variable, basket_value AS value FROM rollup_all)"""


def _histogram(values: str, transform: str = "value", where: str = "true") -> str:
    return f"""
WITH {TX}{values},
x AS (SELECT variable, {transform} AS v FROM vals WHERE {where}),
bounds AS (
  SELECT variable, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / {HISTOGRAM_BINS} AS w
  FROM x GROUP BY variable
),
counts AS (
  SELECT variable, CAST(least(floor((v - lo) / w), {HISTOGRAM_BINS - 1}) AS INTEGER) AS bin,
         count(*) AS n
  FROM x JOIN bounds USING (variable) GROUP BY ALL
),
grid AS (
  SELECT variable, CAST(range AS INTEGER) AS bin, lo, hi, w
  FROM bounds, range({HISTOGRAM_BINS})
)
SELECT variable, bin, round(lo + bin * w, 4) AS bin_low,
       round(CASE WHEN bin = {HISTOGRAM_BINS - 1} THEN hi ELSE lo + (bin + 1) * w END, 4)
         AS bin_high,
       coalesce(n, 0) AS row_count
FROM grid LEFT JOIN counts USING (variable, bin)"""


def _boxplot(values: str) -> str:
    return f"""
WITH {TX}{values},
q AS (
  SELECT variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
         quantile_cont(value, 0.75) AS q3, count(*) AS row_count
  FROM vals GROUP BY variable
),
f AS (SELECT *, q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM q),
w AS (
  SELECT variable, min(value) FILTER (WHERE value BETWEEN lo AND hi) AS a,
         max(value) FILTER (WHERE value BETWEEN lo AND hi) AS b,
         count(*) FILTER (WHERE value NOT BETWEEN lo AND hi) AS outlier_count
  FROM vals JOIN f USING (variable) GROUP BY variable
)
SELECT variable, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       round(least(a, q1), 4) AS whisker_low, round(greatest(b, q3), 4) AS whisker_high,
       outlier_count, row_count
FROM f JOIN w USING (variable)"""


def _horner(coefficients: tuple[float, ...], x: str) -> str:
    out = repr(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = f"({out} * {x} + {c!r})"
    return f"({out})".replace("e-", "E-")


def _normal_quantile(p: str) -> str:
    """The formula of ``normal_quantile``; ``p`` is used many times: name a column."""
    r = f"sqrt(-ln(least({p}, 1e0 - {p})))"

    def ratio(table: tuple, x: str) -> str:
        return f"{_horner(table[0], x)} / {_horner(table[1], x)}"

    return (
        f"CASE WHEN abs({p} - 0.5e0) <= 0.425e0 THEN ({p} - 0.5e0) * "
        f"{ratio(normal.CENTRE, f'(0.180625e0 - ({p} - 0.5e0) * ({p} - 0.5e0))')} "
        f"ELSE sign({p} - 0.5e0) * CASE WHEN {r} <= 5e0 THEN {ratio(normal.NEAR_TAIL, f'({r} - 1.6e0)')} "
        f"ELSE {ratio(normal.FAR_TAIL, f'({r} - 5e0)')} END END"
    )


QQ_POINTS = f"""
WITH {TX}{VALUES},
ranked AS (
  SELECT variable, value, row_number() OVER (PARTITION BY variable ORDER BY value) AS i,
         count(*) OVER (PARTITION BY variable) AS n
  FROM vals
),
placed AS (
  SELECT *, CASE WHEN i = n THEN pow(0.5e0, 1e0 / n) WHEN i = 1 THEN 1e0 - pow(0.5e0, 1e0 / n)
                 ELSE (i - 0.3175e0) / (n + 0.365e0) END AS p
  FROM ranked WHERE n > 3
),
quantiles AS (SELECT *, {_normal_quantile("p")} AS t FROM placed),
line AS (
  SELECT variable, regr_slope(value, t) AS slope, regr_intercept(value, t) AS intercept,
         corr(value, t) AS r
  FROM quantiles GROUP BY variable
)
SELECT q.variable, round(value, 7) AS sample, min(i) AS first_rank, max(i) AS last_rank,
       round(avg(t), 6) + 0e0 AS theoretical, round(any_value(slope), 4) AS slope,
       round(any_value(intercept), 4) AS intercept, round(any_value(r), 6) AS r
FROM quantiles q JOIN line USING (variable) GROUP BY q.variable, value"""


def _poly_sql(coefficients: tuple[float, ...], u: str) -> str:
    return " + ".join(f"({c!r}) * pow({u}, {i})" for i, c in enumerate(coefficients))


_WEIGHTED = f"""
WITH {TX}
, metric AS (
  SELECT invoice, coalesce(sum(quantity), 0) * avg(price) AS basket_value
  FROM tx WHERE invoice IS NOT NULL GROUP BY invoice
),
drawn AS (
  SELECT md5(concat_ws('|', '42', coalesce(invoice, ''), coalesce(stockcode, ''),
                       coalesce(CAST(quantity AS VARCHAR), ''))) AS draw,
         CAST(quantity AS DOUBLE) AS q, price, basket_value
  FROM tx LEFT JOIN metric USING (invoice)
),
vals AS (
  SELECT 'Quantity' AS variable, draw, q AS value FROM drawn
  UNION ALL SELECT 'Unit Price', draw, price FROM drawn
  UNION ALL SELECT 'Basket Value', draw, basket_value FROM drawn
),
sample AS (
  SELECT variable, value, row_number() OVER (PARTITION BY variable ORDER BY draw, value) AS k
  FROM vals WHERE value IS NOT NULL AND isfinite(value)
),
ranked AS (
  SELECT variable, value, row_number() OVER (PARTITION BY variable ORDER BY value) AS i,
         count(*) OVER (PARTITION BY variable) AS n
  FROM sample WHERE k <= {NORMALITY_SAMPLE}
),
placed AS (SELECT *, (i - 0.375e0) / (n + 0.25e0) AS p FROM ranked WHERE n > 5),
scored AS (SELECT *, {_normal_quantile("p")} AS m FROM placed),
ends AS (
  SELECT variable, any_value(n) AS n, sum(m * m) AS square,
         max(m) FILTER (WHERE i = n) AS m1, max(m) FILTER (WHERE i = n - 1) AS m2
  FROM scored GROUP BY variable
),
outer_weights AS (
  SELECT *, m1 / sqrt(square) + {_poly_sql(normality._LAST_WEIGHT, "(1e0 / sqrt(n))")} AS a1,
         m2 / sqrt(square) + {_poly_sql(normality._NEXT_WEIGHT, "(1e0 / sqrt(n))")} AS a2
  FROM ends
),
weighted AS (
  SELECT s.variable, s.value,
         CASE WHEN i = s.n THEN a1 WHEN i = 1 THEN -a1 WHEN i = s.n - 1 THEN a2 WHEN i = 2 THEN -a2
              ELSE m / sqrt((square - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2))
         END AS a
  FROM scored s JOIN outer_weights USING (variable)
)
"""

SHAPIRO = f"""{_WEIGHTED}
SELECT variable, count(*) AS sample_size,
       round(least(pow(sum(a * value), 2) / (var_pop(value) * count(*)), 1e0), 6) AS statistic
FROM weighted GROUP BY variable"""


def _normal_tail(z: str) -> str:
    """Probability above ``z``: Taylor's series near 0, else Laplace's continued fraction."""
    density = f"(exp(-0.5e0 * {z} * {z}) / sqrt(2e0 * pi()))"
    fraction = f"abs({z})"
    for k in range(60, 0, -1):
        fraction = f"(abs({z}) + {k}e0 / {fraction})"
    series = "1e0"
    for k in range(40, 0, -1):
        series = f"(1e0 + {z} * {z} / {2 * k + 1}e0 * {series})"
    far = f"{density} / {fraction}"
    return (
        f"CASE WHEN abs({z}) < 2.5e0 THEN 0.5e0 - {density} * {z} * {series} "
        f"WHEN {z} > 0 THEN {far} ELSE 1e0 - {far} END"
    )


# Royston's approximation for samples of twelve and more.
NORMALITY = f"""{_WEIGHTED},
tested AS (
  SELECT variable, count(*) AS sample_size,
         least(pow(sum(a * value), 2) / (var_pop(value) * count(*)), 1e0) AS statistic
  FROM weighted GROUP BY variable
),
scaled AS (
  SELECT *, (ln(1e0 - statistic) - ({_poly_sql(normality._LARGE_MEAN, "ln(sample_size)")}))
         / exp({_poly_sql(normality._LARGE_LOG_SD, "ln(sample_size)")}) AS z
  FROM tested
),
proven AS (SELECT *, {_normal_tail("z")} AS p FROM scaled)
SELECT variable, round(p, 6) AS p_value, round(statistic, 6) AS statistic,
       CASE WHEN p < {NORMALITY_ALPHA} THEN 'No' ELSE 'Yes' END AS is_normal, sample_size, '' AS notes
FROM proven"""


CAP_IMPACT = f"""{ROLLUP},
impact AS ({_union([
    f"SELECT {p}e0 AS percentile, '{CAP_LABELS[p]}' AS approach, t AS threshold, "
    "count(*) FILTER (WHERE basket_value > t) AS affected_count, count(*) AS total "
    f"FROM rollup_all, (SELECT quantile_cont(basket_value, {p / 100}) AS t FROM rollup_all) "
    "GROUP BY t"
    for p in BASKET_PERCENTILES
])}),
impact_rows AS (
  SELECT percentile, approach, round(threshold, 4) AS threshold, affected_count,
         {_pct("affected_count", "total")} AS affected_pct
  FROM impact
)"""

PSI = f"""
, edges AS (
  SELECT unnest(quantile_cont(price, [{", ".join(str(i / 10) for i in range(1, 10))}])) AS e
  FROM tx WHERE source_year = '1995-1997'
),
placed AS (
  SELECT source_year = '1995-1997' AS expected,
         (SELECT count(*) FROM edges WHERE price > e) AS bucket
  FROM tx
),
counts AS (
  SELECT CAST(range AS INTEGER) AS bucket,
         count(*) FILTER (WHERE expected) AS expected_count,
         count(*) FILTER (WHERE NOT expected) AS actual_count
  FROM range(10) LEFT JOIN placed ON range = placed.bucket GROUP BY range
),
shares AS (
  SELECT *, greatest(expected_count * 1e0 / sum(expected_count) OVER (), 1e-6) AS es,
         greatest(actual_count * 1e0 / sum(actual_count) OVER (), 1e-6) AS acs
  FROM counts
)"""

THRESHOLDS = """
WITH scored AS (
  SELECT (doc_id * 7919 % 1000) / 1000e0 AS score, quality AS target FROM labels
  WHERE quality IS NOT NULL
),
grid AS (SELECT range / 100e0 AS t FROM range(101)),
c AS (
  SELECT t, count(*) FILTER (WHERE score >= t AND target = 1) AS tp,
         count(*) FILTER (WHERE score >= t AND target <> 1) AS fp,
         count(*) FILTER (WHERE score < t AND target <> 1) AS tn,
         count(*) FILTER (WHERE score < t AND target = 1) AS fn
  FROM grid, scored GROUP BY t
)
SELECT round(t, 6) AS threshold, tp, fp, tn, fn,
       round(tp * 1e0 / nullif(tp + fp, 0), 6) AS precision,
       round(tp * 1e0 / nullif(tp + fn, 0), 6) AS recall,
       round(2e0 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1,
       round((tp + fp) * 1e0 / nullif(tp + fp + tn + fn, 0), 6) AS flag_rate
FROM c"""

FULL_RETURN = f"""
, sold AS (
  SELECT row_number() OVER () AS id, invoice, customer_id, stockcode, invoicedate, quantity
  FROM tx WHERE NOT {CREDIT} AND quantity > 0 AND invoice IS NOT NULL
),
credits AS (
  SELECT customer_id, stockcode, invoicedate, -quantity AS returned
  FROM tx WHERE {CREDIT} AND quantity < 0
),
matched AS (
  SELECT id, any_value(invoice) AS invoice,
         coalesce(sum(returned) >= any_value(quantity), false) AS ok
  FROM sold LEFT JOIN credits
    ON sold.customer_id = credits.customer_id AND sold.stockcode = credits.stockcode
   AND credits.invoicedate >= sold.invoicedate
  GROUP BY id
)"""

_STAT = "basket_value"

ORACLE_SQL: dict[str, str] = {
    "combine_years": _select("SELECT * FROM tx"),
    "load_checks": LOAD_CHECKS,
    "load_metadata": _select(
        "SELECT source_year, CAST(grouping(source_year) AS INTEGER) AS is_total, "
        "count(*) AS row_count FROM tx GROUP BY ROLLUP (source_year)"
    ),
    "exact_dedupe": _select("SELECT DISTINCT * FROM tx"),
    "collapse_lines": _select("SELECT * FROM collapsed", "," + COLLAPSED),
    "drop_technical": _kept(f"NOT {TECHNICAL}"),
    "drop_extreme_price": _kept("price <= 10000"),
    "drop_zero_price": _kept(f"NOT {ZERO_SALE}"),
    "fix_credit_prefix": _select(
        "SELECT * REPLACE (CASE WHEN invoice IN (SELECT invoice FROM bad) "
        "THEN concat('C', invoice) ELSE invoice END AS invoice) FROM tx",
        f", bad AS (SELECT invoice FROM tx GROUP BY invoice "
        f"HAVING bool_and({NEGATIVE}) AND NOT starts_with(invoice, 'C'))",
    ),
    "drop_negative_sales": _kept(f"NOT {NEGATIVE_SALE}"),
    "drop_missing_customer": _kept("customer_id IS NOT NULL"),
    "impute_missing_customer": _select(
        f"SELECT * REPLACE (coalesce(customer_id, {SURROGATE}) AS customer_id), "
        "CAST(customer_id IS NULL AS INTEGER) AS missing_id FROM tx"
    ),
    "basket_value": _select(f"SELECT *, round({BASKET}, 4) AS basket_value FROM tx"),
    "cap_thresholds": _select(CAP_ROW, "," + _caps("tx")),
    "cap_thresholds_refined": _select(CAP_ROW, "," + _caps("tx")),
    "apply_caps": _select(
        f"SELECT {CAPPED.replace('*', '* EXCLUDE (price_cap, basket_cap)', 1)} "
        "FROM valued, caps",
        "," + _caps("tx"),
    ),
    "country_bucket": _select(f"SELECT *, {BUCKET} AS country_bucket FROM tx"),
    "country_bucket_counts": _select(
        f"SELECT {BUCKET} AS country_bucket, count(*) AS row_count FROM tx GROUP BY 1"
    ),
    "is_cancelled": _select(f"SELECT *, CAST({CREDIT} AS INTEGER) AS is_cancelled FROM tx"),
    "is_cancelled_counts": _select(
        f"SELECT count(*) FILTER (WHERE {CREDIT}) AS cancelled_count, "
        f"count(*) AS total_count, "
        f"{_pct(f'count(*) FILTER (WHERE {CREDIT})', 'count(*)')} AS cancelled_pct FROM tx"
    ),
    "final_assertions": _select(_assertions("tx")),
    "waterfall": WATERFALL,
    "cleaning_summary": SUMMARY,
    "clean_orders": _clean("s7"),
    "clean_orders_imputed": _clean("s7i"),
    "clean_orders_checks": _select(_assertions("s7"), "," + STEPS),
    "schema_overview": SCHEMA_OVERVIEW,
    "null_counts": _select(NULL_COUNTS),
    "high_null_columns": _select(f"SELECT * FROM ({NULL_COUNTS}) WHERE null_pct > 20"),
    "unique_counts": _select(UNIQUE_COUNTS),
    "sanity_metrics": _select(SANITY_METRICS),
    "duplicate_rows": _select(
        "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_count, "
        "CAST(sum(n) AS BIGINT) AS total_count, "
        f"{_pct('sum(n - 1)', 'sum(n)')} AS duplicate_pct "
        f"FROM (SELECT count(*) AS n FROM tx GROUP BY {COLUMNS})"
    ),
    "date_coverage": _select(
        "SELECT strftime(min(invoicedate), '%Y-%m-%d') AS date_min, "
        "strftime(max(invoicedate), '%Y-%m-%d') AS date_max, "
        "date_sub('day', min(invoicedate), max(invoicedate)) AS duration_days FROM tx"
    ),
    "top_countries": _select(
        "SELECT country, count(*) AS row_count, "
        f"{_pct('count(*)', '(SELECT count(*) FROM tx)')} AS row_pct, "
        "(SELECT count(DISTINCT country) FROM tx) AS total_countries "
        "FROM tx WHERE country IS NOT NULL GROUP BY country "
        "ORDER BY row_count DESC, country LIMIT 10"
    ),
    "anomaly_flags": _select(
        "SELECT *, " + ", ".join(f"{c} AS {n}" for n, c in FLAGS.items()) + " FROM tx"
    ),
    "anomaly_summary": _select(
        f"SELECT flag, row_count, {_pct('row_count', 'total_count', 4)} AS row_pct "
        "FROM both_parts",
        ANOMALY_SUMMARY,
    ),
    "anomaly_examples": _select(ANOMALY_EXAMPLES),
    "invoice_basket_metric": _select(
        "SELECT * REPLACE (round(mean_price, 7) AS mean_price, "
        "round(basket_value, 7) + 0e0 AS basket_value) FROM metric",
        METRIC,
    ),
    "lines_with_basket": _select(
        "SELECT tx.*, round(metric.basket_value, 7) + 0e0 AS basket_value "
        "FROM tx LEFT JOIN metric USING (invoice)",
        METRIC,
    ),
    "histogram": _histogram(VALUES),
    "histogram_log10": _histogram(VALUES, "log10(value)", "value > 0"),
    "boxplot_stats": _boxplot(VALUES),
    "boxplot_stats_refined": _boxplot(VALUES),
    "qq_points": QQ_POINTS,
    "shapiro_statistics": SHAPIRO,
    "normality_tests": NORMALITY,
    "csv_round_trip": _select(
        "SELECT count(*) AS rows_read, CAST(sum(quantity) AS BIGINT) AS quantity, "
        "CAST(sum(CAST(round(price * 1000) AS BIGINT)) AS BIGINT) AS price_thousandths, "
        "count(customer_id) AS customers, count(description) AS descriptions, "
        "strftime(min(invoicedate), '%Y-%m-%d %H:%M:%S') AS first_date FROM tx"
    ),
    "reuse_or_build": _select(
        "SELECT '1 first years' AS step, 'built' AS action, "
        "count(*) FILTER (WHERE source_year = '1995-1997') AS row_count FROM tx "
        "UNION ALL SELECT '2 no change', 'reused', count(*) FILTER (WHERE source_year = '1995-1997') FROM tx "
        "UNION ALL SELECT '3 last years added', 'rebuilt', count(*) FROM tx "
        "UNION ALL SELECT '4 last years changed', 'rebuilt', "
        "count(*) FILTER (WHERE source_year = '1995-1997' OR quantity > 0) FROM tx"
    ),
    "row_rules_stream": _select(
        f"SELECT *, round({BASKET}, 4) AS basket_value, {BUCKET} AS country_bucket, "
        f"CAST({CREDIT} AS INTEGER) AS is_cancelled FROM tx "
        f"WHERE NOT {TECHNICAL} AND price <= 10000 AND NOT {ZERO_SALE}"
    ),
    "anomaly_flags_stream": _select(
        "SELECT *, " + ", ".join(f"{c} AS {n}" for n, c in FLAGS.items()) + " FROM tx"
    ),
    "drop_technical_traps": _select(f"SELECT * FROM traps WHERE NOT {TECHNICAL}", TRAPS),
    "drop_extreme_price_traps": _select("SELECT * FROM traps WHERE price <= 10000", TRAPS),
    "drop_zero_price_traps": _select(f"SELECT * FROM traps WHERE NOT {ZERO_SALE}", TRAPS),
    "basket_value_traps": _select(f"SELECT *, round({BASKET}, 4) + 0e0 AS basket_value FROM traps", TRAPS),
    "sanity_metrics_traps": SANITY_METRICS_TRAPS,
    "finite_values_traps": FINITE_TRAPS,
    "round_trip": _select(
        "SELECT count(*) AS rows_written, count(*) AS rows_read, 0 AS differing FROM tx"
    ),
    "isolation_forest_counts": _select(
        f"SELECT count(*) FILTER (WHERE {CREDIT}) AS credit_lines, "
        f"count(*) FILTER (WHERE {CREDIT}) AS credit_kept, "
        f"count(*) FILTER (WHERE NOT {CREDIT}) AS sale_lines, true AS within_share FROM tx"
    ),
    "basket_rollup": _select(
        "SELECT * REPLACE (round(basket_value, 4) AS basket_value) FROM rollup_all", ROLLUP
    ),
    "basket_percentiles": _select(
        _union(
            [
                f"SELECT {p}e0 AS percentile, "
                f"round(quantile_cont(basket_value, {p / 100}), 4) AS basket_value "
                "FROM rollup_all"
                for p in BASKET_PERCENTILES
            ]
        ),
        ROLLUP,
    ),
    "top_baskets": _select(
        f"SELECT invoice, round({_STAT}, 4) AS basket_value FROM rollup_all "
        f"ORDER BY {_STAT} DESC, invoice LIMIT 5".replace(
            f"ORDER BY {_STAT}", f"ORDER BY rollup_all.{_STAT}"
        ),
        ROLLUP,
    ),
    "basket_stats": _select(
        "SELECT count(*) AS basket_count, round(avg(basket_value), 4) AS mean_value, "
        "round(median(basket_value), 4) AS median_value, "
        "round(stddev_samp(basket_value), 4) AS std_value, "
        "round(stddev_samp(basket_value) / avg(basket_value), 4) "
        "AS coefficient_of_variation FROM rollup_all",
        ROLLUP,
    ),
    "cap_impact": _select("SELECT * FROM impact_rows", CAP_IMPACT),
    "recommended_cap": _select(
        "SELECT * FROM impact_rows WHERE percentile = 99.5", CAP_IMPACT
    ),
    "basket_histogram": _histogram(BASKET_VALS),
    "basket_boxplot": _boxplot(BASKET_VALS),
    "psi": _select(
        "SELECT round(sum((acs - es) * ln(acs / es)), 6) AS psi FROM shares", PSI
    ),
    "psi_buckets": _select(
        "SELECT bucket, expected_count, actual_count, round(es, 6) AS expected_share, "
        "round(acs, 6) AS actual_share, "
        "round((acs - es) * ln(acs / es), 6) AS contribution FROM shares",
        PSI,
    ),
    "threshold_metrics": THRESHOLDS,
    "pseudonymise": _select(
        f"SELECT * REPLACE (sha256('{SALT}' || customer_id) AS customer_id, "
        "CAST(date_trunc('day', invoicedate) AS TIMESTAMP) AS invoicedate) FROM tx"
    ),
    "full_basket_return": _select(
        "SELECT invoice, CAST(bool_and(ok) AS INTEGER) AS full_basket_return "
        "FROM matched GROUP BY invoice",
        FULL_RETURN,
    ),
}
ORACLE_SQL["lines_with_basket_hot"] = ORACLE_SQL["lines_with_basket"]
