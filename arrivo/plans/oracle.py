"""DuckDB SQL for the registered queries (the correctness oracle).

The tables are DuckDB views over the same Parquet files. Every SQL text
states its result independently of Spark: plain joins, ``dense_rank`` for
dictionary codes, date arithmetic for the calendar, ``min_by`` for the
nearest holiday and ``list_reduce`` for the ordered fold. Where a step's
outcome depends on the data (which column the missing-value policy drops),
the decision is verified by its own query (``missing_decisions``) and the
downstream SQL states the resulting column list.
"""

from __future__ import annotations

from arrivo.layout import INTERACTION_NAMES
from arrivo.sources.tables import TRIP_COLUMNS

TRIPS = """
trips AS MATERIALIZED (
  SELECT
    CAST(year(l.l_shipdate) AS INTEGER) AS trip_year,
    CAST(month(l.l_shipdate) AS INTEGER) AS trip_month,
    CAST(day(l.l_shipdate) AS INTEGER) AS trip_day,
    CAST(isodow(l.l_shipdate) AS INTEGER) AS trip_dow,
    s.s_name AS carrier,
    CAST(l.l_partkey AS INTEGER) AS route_num,
    CASE WHEN l.l_linenumber = 6 THEN 'NA' ELSE CAST(l.l_partkey AS VARCHAR) END AS vehicle_id,
    CASE WHEN l.l_linenumber = 7 AND l.l_tax > 0.04 THEN NULL
         ELSE 30 + 10 * l.l_linenumber END AS sched_minutes,
    CASE WHEN o.o_orderkey % 50 = 0 THEN 'NA'
         ELSE CAST(3 * (CAST(round(100 * l.l_discount) AS INTEGER) - 5) + 4 * CAST(l.l_linenumber AS INTEGER)
                   + CAST(trunc(l.l_quantity / 2) AS INTEGER) + 2 * CAST(month(l.l_shipdate) AS INTEGER)
                   + CAST(trunc(l.l_extendedprice / 10000) AS INTEGER) - 40 AS VARCHAR) END AS arr_delay,
    CASE WHEN o.o_orderkey % 25 = 3 THEN 'NA'
         ELSE CAST(CAST(round(100 * l.l_discount) AS INTEGER) - 5 AS VARCHAR) END AS dep_delay,
    CASE WHEN o.o_orderkey % 10 < 4 THEN 'NA' ELSE o.o_orderpriority END AS cancel_code,
    sn.n_name AS origin,
    cn.n_name AS dest,
    CAST(l.l_quantity AS INTEGER) AS distance,
    CAST(l.l_linenumber AS VARCHAR) AS taxi_out,
    CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 1 ELSE 0 END AS cancelled,
    o.o_orderkey AS o_orderkey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
)"""

STRING_COLUMNS = {"carrier", "vehicle_id", "arr_delay", "dep_delay", "cancel_code", "origin",
                  "dest", "taxi_out"}
TEXT_TO_INT = ("arr_delay", "taxi_out", "dep_delay")
FILTERED_COLUMNS = [c for c in TRIP_COLUMNS if c not in ("vehicle_id", "cancelled")]

FILTERED = """
filtered AS (SELECT * EXCLUDE (vehicle_id, cancelled) FROM trips WHERE cancelled = 0)"""


def _to_int(c: str) -> str:
    return f"CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INTEGER)"


def _missing(c: str) -> str:
    return f"{c} = 'NA'" if c in STRING_COLUMNS else f"{c} IS NULL"


def _keep(c: str) -> str:
    return f"{c} <> 'NA'" if c in STRING_COLUMNS else f"{c} IS NOT NULL"


def _policy_chain(columns) -> tuple[list[str], str]:
    ctes = ["s0 AS MATERIALIZED (SELECT * FROM filtered)"]
    for i, c in enumerate(columns):
        ctes.append(f"d{i} AS MATERIALIZED (SELECT count(*) AS seen, "
                    f"CAST(count_if({_missing(c)}) AS BIGINT) AS miss "
                    f"FROM s{i})")
        ctes.append(f"s{i + 1} AS MATERIALIZED (SELECT s{i}.* FROM s{i}, d{i} WHERE "
                    f"(d{i}.seen > 0 AND 10 * d{i}.miss >= 3 * d{i}.seen) OR ({_keep(c)}))")
    return ctes, f"s{len(columns)}"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(x.strip() for x in ctes)


def missing_decisions_sql() -> str:
    ctes, _ = _policy_chain(FILTERED_COLUMNS)
    sel = "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, seen AS rows_seen, "
        f"miss AS missing, CASE WHEN seen > 0 AND 10 * miss >= 3 * seen THEN 'drop_column' "
        f"ELSE 'drop_rows' END AS action FROM d{i}"
        for i, c in enumerate(FILTERED_COLUMNS))
    return _with(TRIPS, FILTERED, *ctes) + "\n" + sel


# columns dropped by the policy on the trips mapping (verified by missing_decisions)
POLICY_DROPS = ("cancel_code",)


def _cleaned_ctes() -> list[str]:
    ctes, last = _policy_chain(FILTERED_COLUMNS)
    return [TRIPS, FILTERED, *ctes,
            f"cleaned AS (SELECT * EXCLUDE ({', '.join(POLICY_DROPS)}) FROM {last})"]


def missing_policy_sql() -> str:
    return _with(*_cleaned_ctes()) + "\nSELECT * FROM cleaned"


def missing_profile_sql() -> str:
    parts = []
    for i, c in enumerate(TRIP_COLUMNS):
        na = f"CAST(count_if({c} = 'NA') AS BIGINT)" if c in STRING_COLUMNS else "CAST(0 AS BIGINT)"
        parts.append(f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, "
                     f"{na} AS na_count, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
                     f"count(*) AS row_count FROM trips")
    return _with(TRIPS) + "\n" + "\nUNION ALL\n".join(parts)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _nth(month: int, weekday: int, n: int) -> str:
    """The n-th weekday (ISO number) of a month of year y."""
    first = f"make_date(y, {month}, 1)"
    return f"make_date(y, {month}, CAST(1 + ({weekday} - isodow({first}) + 7) % 7 + {7 * (n - 1)} AS INTEGER))"


# The holidays in array order, as SQL of the year y
HOLIDAYS = (
    ("Sundance festival", "make_date(y, 1, 29)"),
    ("Independence Day", "make_date(y, 7, 4)"),
    ("US Open tennis", "make_date(y, 8, 27)"),
    ("Halloween", "make_date(y, 10, 31)"),
    ("New Year's Eve", "make_date(y, 12, 31)"),
    ("Christmas", "make_date(y, 12, 25)"),
    ("Veterans Day", "make_date(y, 11, 11)"),
    ("Juneteenth", "make_date(y, 6, 19)"),
    ("Easter (approximate)", "make_date(y, 4, 4)"),
    ("Super Bowl", _nth(2, 7, 1)),
    ("Masters golf", _nth(4, 7, 2)),
    ("Boston Marathon", _nth(4, 1, 3)),
    ("Thanksgiving", _nth(11, 4, 4)),
    ("Labor Day", _nth(9, 1, 1)),
    ("Columbus Day", _nth(10, 1, 2)),
    ("MLK Day", _nth(1, 1, 3)),
    ("Presidents' Day", _nth(2, 1, 3)),
    ("Burning Man", _nth(9, 1, 1)),
    ("Mardi Gras", "CAST(make_date(y, 4, 4) - 47 AS DATE)"),
    ("Memorial Day", "CAST(make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER) AS DATE)"),
)


def holidays_cte(years_sql: str) -> str:
    rows = "\nUNION ALL\n".join(
        f"SELECT y AS year, CAST({i + 1} AS INTEGER) AS holiday_no, {_sql_str(name)} AS "
        f"holiday_name, {e} AS holiday_date FROM years" for i, (name, e) in enumerate(HOLIDAYS))
    return f"years AS ({years_sql}),\nhol AS (\n{rows}\n)"


def holiday_calendar_sql() -> str:
    return (_with(TRIPS, holidays_cte("SELECT DISTINCT trip_year AS y FROM trips"))
            + "\nSELECT * FROM hol")


def _diff(d: str, h: str) -> str:
    return f"date_diff('day', {d}, {h})"


def nearest_cte(dates: str) -> str:
    """prox(trip_year, trip_month, trip_day, proximity) for distinct dates."""
    d = "make_date(dd.trip_year, dd.trip_month, dd.trip_day)"
    diff = _diff(d, "hol.holiday_date")
    return (f"dd AS (SELECT DISTINCT trip_year, trip_month, trip_day FROM {dates}),\n"
            f"prox AS (SELECT dd.trip_year, dd.trip_month, dd.trip_day, "
            f"CAST(min_by({diff}, abs({diff}) * 2 + CASE WHEN {diff} > 0 THEN 1 ELSE 0 END) "
            f"AS INTEGER) AS proximity FROM dd, hol "
            f"GROUP BY dd.trip_year, dd.trip_month, dd.trip_day)")


def holiday_nearest_sql() -> str:
    return (_with(TRIPS, holidays_cte("SELECT DISTINCT trip_year AS y FROM trips"),
                  nearest_cte("trips"))
            + "\nSELECT t.trip_year, t.trip_month, t.trip_day, p.proximity FROM trips t "
              "JOIN prox p USING (trip_year, trip_month, trip_day)")


def holiday_scan_sql() -> str:
    d = "make_date(dd.trip_year, dd.trip_month, dd.trip_day)"
    diff = _diff(d, "h")
    scan = (f"dd AS (SELECT DISTINCT trip_year, trip_month, trip_day FROM trips),\n"
            f"hl AS (SELECT list(holiday_date ORDER BY year, holiday_no) AS l FROM hol),\n"
            f"prox AS (SELECT dd.trip_year, dd.trip_month, dd.trip_day, CAST(list_reduce(hl.l, "
            f"lambda acc, h: CASE WHEN abs({diff}) < acc THEN {diff} ELSE acc END, "
            f"CAST(999 AS BIGINT)) AS INTEGER) AS proximity FROM dd, hl)")
    return (_with(TRIPS, holidays_cte("SELECT DISTINCT trip_year AS y FROM trips"), scan)
            + "\nSELECT t.trip_year, t.trip_month, t.trip_day, p.proximity FROM trips t "
              "JOIN prox p USING (trip_year, trip_month, trip_day)")


def _dict_cte(name: str, key_sql: str) -> str:
    return (f"{name} AS (SELECT k, dense_rank() OVER (ORDER BY k) - 1 AS code "
            f"FROM (SELECT DISTINCT k FROM ({key_sql}) WHERE k IS NOT NULL))")


def _replace(cols, repl: dict) -> str:
    return ", ".join(f"{repl[c]} AS {c}" if c in repl else c for c in cols)


def encode_sql(columns, dict_name: str, base: str = "trips", base_columns=TRIP_COLUMNS) -> str:
    keys = " UNION ".join(f"SELECT CAST({c} AS VARCHAR) AS k FROM {base}" for c in columns)
    joins = " ".join(
        f"LEFT JOIN {dict_name} j{i} ON CAST(b.{c} AS VARCHAR) = j{i}.k"
        for i, c in enumerate(columns))
    repl = {c: f"coalesce(j{i}.code, -1)" for i, c in enumerate(columns)}
    sel = ", ".join(f"{repl[c]} AS {c}" if c in repl else f"b.{c}" for c in base_columns)
    return f"{_dict_cte(dict_name, keys)}", f"SELECT {sel} FROM {base} b {joins}"


def _encoded(columns, dict_name):
    cte, sel = encode_sql(columns, dict_name)
    return _with(TRIPS, cte) + "\n" + sel


DIM = """
dim AS (SELECT CAST(p_partkey AS VARCHAR) AS tailnum, p_type AS model, p_brand AS engine_type
        FROM part WHERE p_size % 10 <> 0
        UNION ALL
        SELECT CAST(p_partkey AS VARCHAR), p_type || ' II', p_brand
        FROM part WHERE p_size BETWEEN 41 AND 43)"""

DIM_COLUMNS = [c for c in TRIP_COLUMNS if c != "vehicle_id"] + ["model", "engine_type"]

DIM_JOINED = """
joined AS (SELECT t.* EXCLUDE (vehicle_id), d.model, d.engine_type
           FROM trips t JOIN dim d ON t.vehicle_id = d.tailnum)"""


def encode_dim_sql() -> str:
    c1 = _dict_cte("dm", "SELECT model AS k FROM joined")
    c2 = _dict_cte("de", "SELECT engine_type AS k FROM joined")
    repl = {"model": "coalesce(dm.code, -1)", "engine_type": "coalesce(de.code, -1)"}
    sel = ", ".join(f"{repl[c]} AS {c}" if c in repl else f"b.{c}" for c in DIM_COLUMNS)
    return (_with(TRIPS, DIM, DIM_JOINED, c1, c2) + f"\nSELECT {sel} FROM joined b "
            "LEFT JOIN dm ON b.model = dm.k LEFT JOIN de ON b.engine_type = de.k")


def _cast_cte(src: str = "trips", name: str = "casted") -> str:
    return (f"{name} AS (SELECT * REPLACE ("
            + ", ".join(f"{_to_int(c)} AS {c}" for c in TEXT_TO_INT) + f") FROM {src})")


def interactions_sql() -> str:
    keys = "SELECT origin AS k FROM casted UNION SELECT dest AS k FROM casted"
    a = INTERACTION_NAMES
    return (_with(TRIPS, _cast_cte(), _dict_cte("ap", keys))
            + f"""
, enc AS (SELECT c.o_orderkey, c.arr_delay, c.trip_month, c.trip_day, c.dep_delay, c.taxi_out,
                 coalesce(o.code, -1) AS origin, coalesce(d.code, -1) AS dest
          FROM casted c LEFT JOIN ap o ON c.origin = o.k LEFT JOIN ap d ON c.dest = d.k)
SELECT o_orderkey, arr_delay, trip_month, trip_day, dep_delay, taxi_out, origin, dest,
       CAST(dep_delay AS BIGINT) * taxi_out AS {a[0]},
       CAST(origin AS BIGINT) * dest AS {a[1]},
       CAST(trip_month AS BIGINT) * trip_day AS {a[2]},
       CAST(dep_delay AS BIGINT) * origin AS {a[3]}
FROM enc""")


def squares_columns_sql() -> str:
    cols = ["trip_month", "trip_day", "dep_delay", "taxi_out", "origin", "dest"]
    sq = ", ".join(f"CAST({c} AS BIGINT) * {c} AS {c}Squared" for c in cols)
    return f"SELECT *, {sq} FROM ({interactions_sql()})"


# ---- the prepared frame: clean -> cast -> encode -> proximity -> interactions
PREPARED_COLUMNS = ["trip_year", "trip_month", "trip_day", "trip_dow", "carrier", "route_num",
                    "sched_minutes", "arr_delay", "dep_delay", "origin", "dest", "distance",
                    "taxi_out", "o_orderkey", "proximityToHoliday", *INTERACTION_NAMES]
FEATURES = [c for c in PREPARED_COLUMNS if c not in ("arr_delay", "o_orderkey")]


def _bucket(key: str, n: int) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT % {n})"


def prepared_ctes() -> list[str]:
    a = INTERACTION_NAMES
    airports = "SELECT origin AS k FROM c2 UNION SELECT dest AS k FROM c2"
    return [
        *_cleaned_ctes(),
        _cast_cte("cleaned", "c1"),
        "c2 AS MATERIALIZED (SELECT * FROM c1 WHERE arr_delay IS NOT NULL)",
        _dict_cte("d_air", airports),
        _dict_cte("d_car", "SELECT carrier AS k FROM c2"),
        _dict_cte("d_rt", "SELECT CAST(route_num AS VARCHAR) AS k FROM c2"),
        holidays_cte("SELECT DISTINCT trip_year AS y FROM c2"),
        nearest_cte("c2"),
        f"""enc AS (SELECT c2.trip_year, c2.trip_month, c2.trip_day, c2.trip_dow,
            coalesce(ca.code, -1) AS carrier, coalesce(rt.code, -1) AS route_num,
            c2.sched_minutes, c2.arr_delay, c2.dep_delay,
            coalesce(ao.code, -1) AS origin, coalesce(ad.code, -1) AS dest,
            c2.distance, c2.taxi_out, c2.o_orderkey, p.proximity AS proximityToHoliday
          FROM c2
          LEFT JOIN d_car ca ON c2.carrier = ca.k
          LEFT JOIN d_rt rt ON CAST(c2.route_num AS VARCHAR) = rt.k
          LEFT JOIN d_air ao ON c2.origin = ao.k
          LEFT JOIN d_air ad ON c2.dest = ad.k
          JOIN prox p ON c2.trip_year = p.trip_year AND c2.trip_month = p.trip_month
                     AND c2.trip_day = p.trip_day)""",
        f"""prepared AS MATERIALIZED (SELECT *,
            CAST(dep_delay AS BIGINT) * taxi_out AS {a[0]},
            CAST(origin AS BIGINT) * dest AS {a[1]},
            CAST(trip_month AS BIGINT) * trip_day AS {a[2]},
            CAST(dep_delay AS BIGINT) * origin AS {a[3]},
            {_bucket('o_orderkey', 100)} AS bucket
          FROM enc)""",
    ]


def assemble_sql() -> str:
    cols = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in FEATURES)
    return _with(*prepared_ctes()) + f"\nSELECT o_orderkey, arr_delay, {cols} FROM prepared"


def _stats_cte() -> str:
    parts = ", ".join(f"avg({f}) AS m{i}, stddev_samp({f}) AS s{i}" for i, f in enumerate(FEATURES))
    return f"stats AS (SELECT {parts} FROM prepared WHERE bucket >= 1)"


def standard_scale_sql() -> str:
    sel = "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{f}' AS feature, round(m{i}, 4) AS mean, "
        f"round(s{i}, 4) AS std FROM stats" for i, f in enumerate(FEATURES))
    return _with(*prepared_ctes(), _stats_cte()) + "\n" + sel


# Years in which an as-built rule is a week early (or, being a
# first occurrence, has no date), as far as the data reaches
AS_BUILT_EARLY = {
    "Labor Day": (1991, 1996, 2002), "Thanksgiving": (1991, 1996, 2002), "MLK Day": (1991, 2002),
    "Presidents' Day": (1994, 2000, 2005), "Boston Marathon": (1997, 2003), "Columbus Day": (1992, 1998),
}


def holiday_calendar_as_built_sql() -> str:
    """The right rules with two months swapped and Memorial Day left out, and
    the early years taken from the table."""
    swapped = {"Labor Day": _nth(10, 1, 1), "Burning Man": _nth(10, 1, 1), "Columbus Day": _nth(9, 1, 2)}
    rows = []
    for name, e in HOLIDAYS:
        if name == "Memorial Day":
            continue
        e = swapped.get(name, e)
        rule = "Labor Day" if name == "Burning Man" else name
        if rule in AS_BUILT_EARLY:
            early = "NULL" if rule == "Labor Day" else f"CAST({e} - 7 AS DATE)"
            e = f"CASE WHEN y IN {AS_BUILT_EARLY[rule]} THEN {early} ELSE {e} END"
        rows.append(f"SELECT y AS year, CAST({len(rows) + 1} AS INTEGER) AS holiday_no, {_sql_str(name)} AS "
                    f"holiday_name, {e} AS holiday_date FROM years")
    return (_with(TRIPS, "years AS (SELECT DISTINCT trip_year AS y FROM trips)") + "\n" + "\nUNION ALL\n".join(rows))


def apply_fitted_sql() -> str:
    """Codes of the trips to the first places, applied to all trips. The
    policy's decisions are those of all rows (``missing_decisions``); its
    filters and the codes are restated here."""
    kept = " AND ".join(_keep(c) for c in FILTERED_COLUMNS if c not in POLICY_DROPS)
    fit = "(SELECT * FROM c2 WHERE dest < 'NATION_2')"
    return (_with(
        TRIPS, DIM, DIM_JOINED.replace("FROM trips t", "FROM (SELECT DISTINCT * FROM trips) t"),
        f"kept AS (SELECT * FROM joined WHERE cancelled = 0 AND {kept})",
        _cast_cte("kept", "c1"), "c2 AS MATERIALIZED (SELECT * FROM c1 WHERE arr_delay IS NOT NULL)",
        _dict_cte("ap", f"SELECT origin AS k FROM {fit} UNION SELECT dest AS k FROM {fit}"),
        _dict_cte("dm", f"SELECT model AS k FROM {fit}"),
        holidays_cte("SELECT DISTINCT trip_year AS y FROM c2"), nearest_cte("c2")) + """
SELECT c2.o_orderkey, c2.arr_delay, coalesce(o.code, -1) AS origin, coalesce(d.code, -1) AS dest, c2.distance,
       c2.taxi_out, coalesce(dm.code, -1) AS model, p.proximity AS "proximityToHoliday"
FROM c2 LEFT JOIN ap o ON c2.origin = o.k LEFT JOIN ap d ON c2.dest = d.k LEFT JOIN dm ON c2.model = dm.k
JOIN prox p ON c2.trip_year = p.trip_year AND c2.trip_month = p.trip_month AND c2.trip_day = p.trip_day""")


def _one_feature_ctes(feature: str = "taxi_out") -> str:
    """x: the scaled feature, y: the label, over training and hold-out rows."""
    return _with(*prepared_ctes()) + f"""
, st AS (SELECT avg({feature}) AS m, stddev_samp({feature}) AS s FROM prepared WHERE bucket >= 1)
, xy AS (SELECT ({feature} - m) / s AS x, arr_delay AS y, bucket,
                {_bucket('o_orderkey', 3)} AS fold FROM prepared, st)
, tr AS (SELECT * FROM xy WHERE bucket >= 1)"""


def lr_fit_sql() -> str:
    return _one_feature_ctes() + """
SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept FROM tr"""


def lr_elastic_sql() -> str:
    """Soft threshold: the ridge part of the penalty is relative to the
    label's standard deviation, the lasso part is not."""
    return _one_feature_ctes() + """
, mo AS (SELECT covar_pop(x, y) AS c, var_pop(x) AS v, stddev_pop(y) AS sy, avg(y) AS my, avg(x) AS mx FROM tr)
, gr AS (SELECT reg, mix, sign(c) * greatest(abs(c) - reg * mix, 0) / (v + reg * (1 - mix) / sy) AS w, my, mx
         FROM mo, unnest([0.1, 0.2, 0.3]::DOUBLE[]) a(reg), unnest([0.5, 0.8, 1.0]::DOUBLE[]) b(mix))
SELECT reg AS reg_param, mix AS elastic_net, round(w, 3) AS slope, round(my - w * mx, 3) AS intercept FROM gr"""


def cv_mean_rmse_sql() -> str:
    return _one_feature_ctes() + """
, fm AS (SELECT k, avg(y) AS m FROM tr, range(3) r(k) WHERE fold <> k GROUP BY k)
SELECT round(avg(e), 5) AS avg_rmse
FROM (SELECT sqrt(avg(power(y - m, 2))) AS e FROM tr JOIN fm ON tr.fold = fm.k GROUP BY fold)"""


def rf_stump_sql() -> str:
    """Best split by the sum of squares within the two sides."""
    return _with(*prepared_ctes()) + """
, tr AS (SELECT dep_delay AS x, arr_delay AS y FROM prepared WHERE bucket >= 1)
, cut AS (SELECT c.x AS point, sum(power(t.y, 2)) FILTER (t.x <= c.x) - power(sum(t.y) FILTER (t.x <= c.x), 2)
                 / count(*) FILTER (t.x <= c.x)
               + sum(power(t.y, 2)) FILTER (t.x > c.x) - power(sum(t.y) FILTER (t.x > c.x), 2)
                 / count(*) FILTER (t.x > c.x) AS sse,
               avg(t.y) FILTER (t.x <= c.x) AS lo, avg(t.y) FILTER (t.x > c.x) AS hi
          FROM (SELECT DISTINCT x FROM tr) c, tr t GROUP BY c.x HAVING count(*) FILTER (t.x > c.x) > 0)
, best AS (SELECT * FROM cut ORDER BY sse, point LIMIT 1)
SELECT dep_delay, round(CASE WHEN dep_delay <= point THEN lo ELSE hi END, 6) AS prediction
FROM (SELECT DISTINCT dep_delay FROM prepared), best"""


def _best_split_ctes(rows: str, name: str) -> str:
    """``name``(side, f, v, lo, hi): for each side of ``rows`` (side, x1, x2,
    y) the split x_f <= v with the least sum of squares, and both means."""
    return f"""
{name}_long AS (SELECT side, 1 AS f, x1 AS v, y FROM {rows} UNION ALL SELECT side, 2, x2, y FROM {rows}),
{name}_cuts AS (SELECT t.side, c.f, c.v,
    count(*) FILTER (t.v <= c.v) AS nl, count(*) FILTER (t.v > c.v) AS nr,
    sum(t.y) FILTER (t.v <= c.v) AS sl, sum(t.y) FILTER (t.v > c.v) AS sr, sum(power(t.y, 2)) AS q
  FROM (SELECT DISTINCT f, v FROM {name}_long) c JOIN {name}_long t ON t.f = c.f GROUP BY t.side, c.f, c.v),
{name} AS (SELECT side, f, v, sl / nl AS lo, sr / nr AS hi FROM {name}_cuts WHERE nl > 0 AND nr > 0
  QUALIFY row_number() OVER (PARTITION BY side ORDER BY q - power(sl, 2) / nl - power(sr, 2) / nr, f, v) = 1)"""


def rf_two_levels_sql() -> str:
    goes = "CASE WHEN CASE {0}.f WHEN 1 THEN {1}.x1 ELSE {1}.x2 END <= {0}.v THEN {2} ELSE {3} END"
    return _with(
        *prepared_ctes(),
        "top_rows AS (SELECT 0 AS side, dep_delay AS x1, taxi_out AS x2, arr_delay AS y FROM prepared WHERE bucket >= 1)",
        _best_split_ctes("top_rows", "top"),
        f"low_rows AS (SELECT {goes.format('top', 'r', 0, 1)} AS side, r.x1, r.x2, r.y FROM top_rows r, top)",
        _best_split_ctes("low_rows", "low"),
        "points AS (SELECT DISTINCT dep_delay AS x1, taxi_out AS x2 FROM prepared)") + f"""
SELECT p.x1 AS dep_delay, p.x2 AS taxi_out, round({goes.format('low', 'p', 'low.lo', 'low.hi')}, 6) AS prediction
FROM points p CROSS JOIN top JOIN low ON low.side = {goes.format('top', 'p', 0, 1)}"""


def scan_rejects_sql() -> str:
    """Line lengths and texts as the query writes them."""
    late = ", ".join(f"'{c}'" for c in TRIP_COLUMNS[10:])
    return _with(TRIPS) + f"""
SELECT c AS column_name, 'missing_field' AS reject, count(*) AS lines
FROM trips, unnest([{late}]) u(c) WHERE o_orderkey % 97 = 0 GROUP BY c
UNION ALL
SELECT CAST(NULL AS VARCHAR), 'extra_field', count(*) FROM trips
WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 = 1 HAVING count(*) > 0
UNION ALL
SELECT 'distance', 'bad_value', count(*) FROM trips
WHERE o_orderkey % 97 <> 0 AND o_orderkey % 83 = 2 HAVING count(*) > 0"""


def encode_unseen_sql() -> str:
    fit = "(SELECT * FROM trips WHERE dest < 'NATION_2')"
    return _with(
        TRIPS, _dict_cte("ap", f"SELECT origin AS k FROM {fit} UNION SELECT dest AS k FROM {fit}"),
        *[_dict_cte(n, f"SELECT CAST({c} AS VARCHAR) AS k FROM {fit}") for n, c in (
            ("ca", "carrier"), ("rt", "route_num"), ("cc", "cancel_code"), ("ve", "vehicle_id"))]) + """
SELECT t.o_orderkey, coalesce(ca.code, -1) AS carrier, coalesce(o.code, -1) AS origin, coalesce(d.code, -1) AS dest,
       coalesce(rt.code, -1) AS route_num, coalesce(cc.code, -1) AS cancel_code, coalesce(ve.code, -1) AS vehicle_id
FROM trips t LEFT JOIN ca ON t.carrier = ca.k LEFT JOIN ap o ON t.origin = o.k LEFT JOIN ap d ON t.dest = d.k
LEFT JOIN rt ON CAST(t.route_num AS VARCHAR) = rt.k LEFT JOIN cc ON t.cancel_code = cc.k
LEFT JOIN ve ON t.vehicle_id = ve.k"""


def score_one_feature_sql() -> str:
    return _one_feature_ctes() + """
, f AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b, count(*) AS n FROM tr)
SELECT 'linear' AS algorithm, round(sqrt(avg(power(y - a * x - b, 2))), 5) AS rmse,
       any_value(n) AS train_rows, count(*) AS test_rows FROM xy, f WHERE bucket < 1"""


def scored_rows_sql() -> str:
    return _one_feature_ctes().replace("arr_delay AS y, bucket", "arr_delay AS y, o_orderkey, bucket") + """
, f AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM tr)
SELECT 'first-run' AS run_id, round(sqrt(avg(power(y - a * x - b, 2))), 5) AS rmse, count(*) AS test_rows,
       min(o_orderkey) AS least_key FROM xy, f WHERE bucket < 1"""


def scaled_squares_sql() -> str:
    names = list(FEATURES) + [f"{f}Squared" for f in FEATURES if "interaction" not in f.lower()]
    scaled = [f"CASE WHEN s{i} = 0 THEN 0.0 ELSE ({f} - m{i}) / s{i} END"
              for i, f in enumerate(FEATURES)]
    exprs = scaled + [f"({scaled[i]}) * ({scaled[i]})" for i, f in enumerate(FEATURES)
                      if "interaction" not in f.lower()]
    sums = ", ".join(f"sum({e}) AS t{i}" for i, e in enumerate(exprs))
    sel = "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{n}' AS feature, round(t{i}, 4) + 0.0 AS "
        f"total FROM sums" for i, n in enumerate(names))
    return (_with(*prepared_ctes(), _stats_cte())
            + f", sums AS (SELECT {sums} FROM prepared, stats WHERE bucket >= 1)\n" + sel)


def rmse_sql() -> str:
    return (_with(*prepared_ctes())
            + ", m AS (SELECT avg(arr_delay) AS m FROM prepared WHERE bucket >= 1)\n"
              "SELECT round(sqrt(avg(power(arr_delay - m.m, 2))), 6) AS rmse, "
              "count(*) AS test_rows FROM prepared, m WHERE bucket < 1")


def oracle_sql() -> dict[str, str]:
    a = TRIP_COLUMNS
    return {
        "contract_scan": _with(TRIPS) + "\nSELECT *, cancel_code AS extracode FROM trips",
        "scan_rejects": scan_rejects_sql(),
        "dedup_rows": _with(TRIPS) + "\nSELECT DISTINCT * FROM trips",
        "dedup_signature": _with(TRIPS) + "\nSELECT trip_month, carrier, origin, taxi_out FROM "
                                          "(SELECT DISTINCT * FROM trips)",
        "drop_and_filter": _with(TRIPS, FILTERED) + "\nSELECT * FROM filtered",
        "missing_profile": missing_profile_sql(),
        "missing_decisions": missing_decisions_sql(),
        "missing_policy": missing_policy_sql(),
        "cast_text_to_int": _with(TRIPS, _cast_cte()) + "\nSELECT * FROM casted",
        "date_key": _with(TRIPS) + """
SELECT trip_year, trip_month, trip_day,
       CAST(trip_day AS VARCHAR) || '-' || CAST(trip_month AS VARCHAR) || '-' ||
       CAST(trip_year AS VARCHAR) AS date_key,
       make_date(trip_year, trip_month, trip_day) AS trip_date
FROM trips""",
        "dim_join": _with(TRIPS, DIM, DIM_JOINED) + "\nSELECT * FROM joined",
        "dim_lookup": _with(TRIPS) + """
, places AS (SELECT n.n_name AS code, r.r_name AS city
             FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT t.o_orderkey, t.trip_year, t.origin, t.dest, po.city AS origin_city, pd.city AS dest_city
FROM trips t LEFT JOIN places po ON t.origin = po.code LEFT JOIN places pd ON t.dest = pd.code""",
        "category_keys": _with(TRIPS, _dict_cte(
            "ap", "SELECT origin AS k FROM trips UNION SELECT dest AS k FROM trips"))
        + "\nSELECT k AS key, code FROM ap",
        "encode_shared": _encoded(["origin", "dest"], "ap"),
        "encode_single": _encoded(["carrier"], "ca"),
        "encode_int_key": _encoded(["route_num"], "rt"),
        "encode_dim": encode_dim_sql(),
        "holiday_calendar": holiday_calendar_sql(),
        "holiday_nearest": holiday_nearest_sql(),
        "holiday_scan": holiday_scan_sql(),
        "holiday_calendar_as_built": holiday_calendar_as_built_sql(),
        "dim_join_salted": _with(TRIPS, DIM) + "\nSELECT t.o_orderkey, t.taxi_out, d.model, d.engine_type "
                                               "FROM trips t JOIN dim d ON t.vehicle_id = d.tailnum",
        "dim_lookup_salted": _with(TRIPS) + """
SELECT t.o_orderkey, t.dest, CASE WHEN r.r_name = 'ASIA' THEN 'later' ELSE r.r_name END AS dest_city
FROM trips t JOIN nation n ON t.dest = n.n_name JOIN region r ON n.n_regionkey = r.r_regionkey""",
        "encode_one_airport": _with(TRIPS, _dict_cte("ap", "SELECT dest AS k FROM trips"))
        + "\nSELECT t.o_orderkey, ap.code AS dest, t.taxi_out FROM trips t JOIN ap ON t.dest = ap.k",
        "encode_salted": _with(TRIPS, _dict_cte("ap", "SELECT origin AS k FROM trips UNION SELECT dest FROM trips"),
                               _dict_cte("ca", "SELECT carrier AS k FROM trips")) + """
SELECT t.o_orderkey, ca.code AS carrier, o.code AS origin, d.code AS dest
FROM trips t JOIN ca ON t.carrier = ca.k JOIN ap o ON t.origin = o.k JOIN ap d ON t.dest = d.k""",
        "assemble_skips": _with(TRIPS, _cast_cte()) + """
SELECT o_orderkey, taxi_out, dep_delay, sched_minutes, distance FROM casted
WHERE dep_delay IS NOT NULL AND sched_minutes IS NOT NULL AND distance IS NOT NULL""",
        "encode_unseen_salted": encode_unseen_sql(),
        "dim_lookup_unmatched": _with(TRIPS) + """
SELECT t.o_orderkey, t.origin, t.dest, r.r_name AS dest_city
FROM trips t JOIN nation n ON t.dest = n.n_name
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey AND r.r_name IN ('ASIA', 'EUROPE')""",
        "apply_fitted": apply_fitted_sql(),
        "apply_stored": apply_fitted_sql(),
        "lr_fit": lr_fit_sql(),
        "lr_elastic": lr_elastic_sql(),
        "cv_mean_rmse": cv_mean_rmse_sql(),
        "rf_stump": rf_stump_sql(),
        "rf_two_levels": rf_two_levels_sql(),
        "scored_rows": scored_rows_sql(),
        "score_one_feature": score_one_feature_sql(),
        "interactions": interactions_sql(),
        "squares_columns": squares_columns_sql(),
        "drop_strings": _with(TRIPS, _cast_cte()) + "\nSELECT " + ", ".join(
            c for c in a if c not in ("carrier", "vehicle_id", "cancel_code", "origin", "dest"))
        + " FROM casted",
        "drop_constant": _with(TRIPS) + "\nSELECT * EXCLUDE (cancelled) FROM trips "
                                        "WHERE cancelled = 0",
        "assemble": assemble_sql(),
        "hash_split": _with(TRIPS) + f"""
SELECT o_orderkey, CAST({_bucket('o_orderkey', 100)} AS INTEGER) AS bucket,
       CASE WHEN {_bucket('o_orderkey', 100)} < 1 THEN 'test' ELSE 'train' END AS split
FROM (SELECT DISTINCT o_orderkey FROM trips)""",
        "cv_folds": _with(TRIPS) + f"""
SELECT o_orderkey, CAST({_bucket('o_orderkey', 3)} AS INTEGER) AS fold
FROM (SELECT DISTINCT o_orderkey FROM trips) WHERE {_bucket('o_orderkey', 100)} >= 1""",
        "standard_scale": standard_scale_sql(),
        "scaled_squares": scaled_squares_sql(),
        "rmse": rmse_sql(),
    }
