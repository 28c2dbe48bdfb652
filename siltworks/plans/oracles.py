"""The registered queries once more as plain SQL, written for an independent engine.

Nothing here is shared with the operators except column and level names.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

NUMERIC = ["age", "balance", "day", "duration", "campaign", "pdays", "previous"]
CATEGORICAL = ["job", "marital", "education", "contact", "poutcome", "month"]
BINARY = ["default", "housing", "loan", "deposit"]
ALL = NUMERIC + CATEGORICAL + BINARY
FLAGS = [
    "flag_balance_negativo", "flag_outlier_balance", "flag_outlier_campaign",
    "pdays_flag_nuevo_cliente", "flag_outlier_pdays", "flag_outlier_previous",
]
OUTLIERS = {c: f"flag_outlier_{c}" for c in ("balance", "campaign", "pdays", "previous")}
LEVELS = {
    "job": ["automobile", "building", "furniture", "household", "machinery", "nan"],
    "marital": ["divorced", "married", "single"],
    "contact": ["cellular", "telephone", "unknown"],
    "poutcome": ["failure", "other", "success", "unknown"],
}
ONE_HOT = [f"{c}_{v}" for c, levels in LEVELS.items() for v in levels]
CYCLIC = ["day_sin", "day_cos", "month_sin", "month_cos"]
STANDARD = ["age", "pdays", "previous", "campaign"]
FEATURES = ["balance", *STANDARD, *ONE_HOT, "education", *FLAGS, *CYCLIC, "default", "housing", "loan"]
PHASES = ["ingesta", "limpieza", "transformacion", "validacion", "carga"]
LIMIT = {"ingesta": 10, "limpieza": 15, "transformacion": 30, "validacion": 20, "carga": 5}

RAW = """
li AS (SELECT l_orderkey, COUNT(*) AS n_items FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderstatus, o.o_orderpriority, o.o_totalprice,
         c.c_acctbal, c.c_mktsegment, COALESCE(li.n_items, 0) AS n_items,
         LAG(o.o_orderdate) OVER w AS prev_date, LAG(o.o_orderstatus) OVER w AS prev_status,
         ROW_NUMBER() OVER w - 1 AS n_prev
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN li ON o.o_orderkey = li.l_orderkey
  WINDOW w AS (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey)),
contacts AS MATERIALIZED (
  SELECT o_orderkey AS contact_id,
    CASE WHEN o_orderkey % 97 = 0 THEN 'abc' WHEN o_orderkey % 101 = 0 THEN 'N/A'
         ELSE CAST(18 + o_custkey % 73 AS VARCHAR) END AS age,
    CASE WHEN o_orderkey % 89 = 0 THEN '' WHEN o_orderkey % 211 = 0 THEN '99999.5'
         ELSE CAST(c_acctbal AS VARCHAR) END AS balance,
    CAST(EXTRACT(DAY FROM o_orderdate) AS VARCHAR) AS day,
    CAST(CAST(FLOOR(o_totalprice / 1000) AS BIGINT) AS VARCHAR) AS duration,
    CAST(n_items AS VARCHAR) AS campaign,
    CAST(COALESCE(DATEDIFF('day', prev_date, o_orderdate), -1) AS VARCHAR) AS pdays,
    CAST(n_prev AS VARCHAR) AS previous,
    CASE WHEN o_orderkey % 83 = 0 THEN 'NA' WHEN o_orderkey % 5 = 0 THEN CONCAT(' ', c_mktsegment, ' ')
         ELSE c_mktsegment END AS job,
    CASE o_custkey % 3 WHEN 0 THEN 'married' WHEN 1 THEN 'Single' ELSE ' divorced' END AS marital,
    CASE o_custkey % 4 WHEN 0 THEN 'primary' WHEN 1 THEN 'Secondary' WHEN 2 THEN 'tertiary' ELSE 'unknown' END AS education,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'cellular' WHEN o_orderpriority = '3-MEDIUM' THEN 'telephone'
         ELSE 'unknown' END AS contact,
    CASE WHEN prev_status IS NULL THEN 'unknown' WHEN prev_status = 'F' THEN 'success' WHEN prev_status = 'O' THEN 'failure'
         ELSE 'other' END AS poutcome,
    CASE CAST(EXTRACT(MONTH FROM o_orderdate) AS INT) WHEN 1 THEN 'jan' WHEN 2 THEN 'feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'apr'
         WHEN 5 THEN 'may' WHEN 6 THEN 'jun' WHEN 7 THEN 'jul' WHEN 8 THEN 'aug' WHEN 9 THEN 'sep' WHEN 10 THEN 'oct'
         WHEN 11 THEN 'nov' ELSE ' dec ' END AS month,
    CASE WHEN c_acctbal < 0 THEN 'Yes' ELSE 'no' END AS "default",
    CASE o_orderkey % 4 WHEN 0 THEN 'y' WHEN 1 THEN ' YES' WHEN 2 THEN '0' ELSE 'false' END AS housing,
    CASE WHEN o_orderkey % 79 = 0 THEN 'maybe' WHEN o_orderkey % 6 = 0 THEN 'true' ELSE 'N' END AS loan,
    CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS deposit
  FROM base)"""


def q(name: str) -> str:
    return f'"{name}"'


def cols(items: list[str], sep: str = ",\n  ") -> str:
    return sep.join(items)


TOKENED = "tokened AS (SELECT contact_id, " + cols(
    [f"CASE WHEN {q(c)} NOT IN ('', ' ', 'NA', 'N/A') THEN {q(c)} END AS {q(c)}" for c in ALL]
) + " FROM contacts)"

TYPED = "typed AS MATERIALIZED (SELECT contact_id, " + cols(
    [f"TRY_CAST({q(c)} AS DOUBLE) AS {q(c)}" if c in NUMERIC else q(c) for c in ALL]
) + " FROM tokened)"

TIDY = "tidy AS MATERIALIZED (SELECT contact_id, " + cols(
    [q(c) for c in NUMERIC]
    + [f"COALESCE(LOWER(TRIM({q(c)})), 'nan') AS {q(c)}" for c in CATEGORICAL]
    + [
        f"CASE WHEN LOWER(TRIM({q(c)})) IN ('yes', 'y', '1', 'true') THEN 1e0 "
        f"WHEN LOWER(TRIM({q(c)})) IN ('no', 'n', '0', 'false') THEN 0e0 END AS {q(c)}"
        for c in BINARY
    ]
) + " FROM typed)"


def _quartiles(column: str, source: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, COUNT(v) AS n, QUANTILE_CONT(v, 0.25) AS q1, QUANTILE_CONT(v, 0.5) AS median, "
        f"QUANTILE_CONT(v, 0.75) AS q3 FROM (SELECT {source} AS v FROM typed)"
    )


QUARTILES = "quartiles AS MATERIALIZED (" + " UNION ALL ".join(
    _quartiles(c, "CASE WHEN pdays <> -1 THEN pdays END" if c == "pdays" else c) for c in OUTLIERS
) + ")"
BOUNDS = (
    "bounds AS MATERIALIZED (SELECT *, q1 - 1.5e0 * (q3 - q1) AS lower, q3 + 1.5e0 * (q3 - q1) AS upper FROM quartiles)"
)


def outlier(column: str) -> str:
    special = " AND pdays <> -1" if column == "pdays" else ""
    low, high = (f"(SELECT {end} FROM bounds WHERE column_name = '{column}')" for end in ("lower", "upper"))
    return (
        f"CASE WHEN ({column} < {low} OR {column} > {high}){special} THEN 1 ELSE 0 END AS flag_outlier_{column}"
    )


FLAG_SQL = {
    "flag_balance_negativo": "CASE WHEN balance < 0 THEN 1 ELSE 0 END AS flag_balance_negativo",
    "pdays_flag_nuevo_cliente": "CASE WHEN pdays = -1 THEN 1 ELSE 0 END AS pdays_flag_nuevo_cliente",
    **{f: outlier(c) for c, f in OUTLIERS.items()},
}
CLEAN = "cleaned AS MATERIALIZED (SELECT *, " + cols([FLAG_SQL[f] for f in FLAGS]) + " FROM tidy)"

MONTH_NUMBER = (
    "CASE month " + " ".join(
        f"WHEN '{m}' THEN {i}" for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)
    ) + " END"
)
CYCLIC_SQL = {
    "day_sin": "SIN(2 * PI() * day / 31)",
    "day_cos": "COS(2 * PI() * day / 31)",
    "month_sin": f"SIN(2 * PI() * ({MONTH_NUMBER}) / 12)",
    "month_cos": f"COS(2 * PI() * ({MONTH_NUMBER}) / 12)",
}


def standard(column: str) -> str:
    return f"({column} - (SELECT AVG({column}) FROM typed)) / (SELECT STDDEV_POP({column}) FROM typed)"


ROBUST_SQL = (
    "(balance - (SELECT median FROM quartiles WHERE column_name = 'balance')) / "
    "(SELECT q3 - q1 FROM quartiles WHERE column_name = 'balance')"
)
ORDINAL_SQL = "CASE education WHEN 'primary' THEN 0e0 WHEN 'secondary' THEN 1e0 WHEN 'tertiary' THEN 2e0 ELSE -1e0 END"


def hot(column: str, level: str) -> str:
    return f"CASE WHEN {column} = '{level}' THEN 1e0 ELSE 0e0 END AS {column}_{level}"


ONE_HOT_SQL = {f"{c}_{v}": hot(c, v) for c, levels in LEVELS.items() for v in levels}
FEATURE_SQL = {
    "balance": f"{ROBUST_SQL} AS balance",
    **{c: f"{standard(c)} AS {c}" for c in STANDARD},
    **ONE_HOT_SQL,
    "education": f"{ORDINAL_SQL} AS education",
    **{f: f"CAST({f} AS DOUBLE) AS {f}" for f in FLAGS},
    **{c: f"{sql} AS {c}" for c, sql in CYCLIC_SQL.items()},
    **{b: f"{q(b)} AS {q(b)}" for b in ("default", "housing", "loan")},
}


def features_cte(names: list[str]) -> str:
    return (
        "features AS MATERIALIZED (SELECT contact_id, "
        + cols([FEATURE_SQL[c] for c in names])
        + ", CAST(deposit AS INTEGER) AS y FROM cleaned)"
    )


FEATURE_CTE = features_cte(FEATURES)
TO_RAW = [RAW]
TO_TOKENED = [RAW, TOKENED]
TO_TYPED = [*TO_TOKENED, TYPED]
TO_TIDY = [*TO_TYPED, TIDY]
TO_CLEAN = [*TO_TIDY, QUARTILES, BOUNDS, CLEAN]
TO_FEATURES = [*TO_CLEAN, FEATURE_CTE]


def oracle(name: str, ctes: list[str], select: str) -> None:
    ORACLES[name] = ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + select


def rounded(names: list[str], digits: int = 6) -> str:
    return cols([f"ROUND({q(c)}, {digits}) AS {q(c)}" for c in names])


def text(names: list[str]) -> str:
    return cols([q(c) for c in names])


# ---- sources and ingest -------------------------------------------------------

oracle("scan_delimited_autodetect", TO_TOKENED, "SELECT * FROM tokened")
oracle("null_tokens", TO_TOKENED, "SELECT * FROM tokened")
oracle("normalize_header", TO_RAW, "SELECT * FROM contacts")
oracle("tolerant_numeric_cast", TO_TYPED, f"SELECT contact_id, {text(NUMERIC)} FROM typed")


def _kind(c: str) -> str:
    return "numeric" if c in NUMERIC else "categorical" if c in CATEGORICAL else "binary"


oracle(
    "schema_check",
    TO_TYPED,
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{_kind(c)}' AS logical_type, "
        + ("FALSE AS present, CAST(0 AS BIGINT) AS n_values" if c in ("previous", "poutcome") else f"TRUE AS present, COUNT({q(c)}) AS n_values FROM typed")
        for c in ALL
    ),
)
oracle(
    "null_census",
    [
        *TO_TYPED,
        "per_column AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({q(c)}) AS n_null, COUNT(*) AS n_cells FROM typed" for c in ALL
        ) + ")",
        "counted AS (SELECT * FROM per_column UNION ALL SELECT '*', CAST(SUM(n_null) AS BIGINT), CAST(SUM(n_cells) AS BIGINT) FROM per_column)",
    ],
    "SELECT column_name, n_null, n_cells, ROUND(CAST(n_null AS DOUBLE) / n_cells * 100, 4) AS null_pct FROM counted",
)
oracle(
    "source_readable",
    [],
    "SELECT readable, COUNT(*) AS n_rows, CAST(IF(readable, 0, COUNT(*)) AS BIGINT) AS n_too_long "
    "FROM orders JOIN customer ON o_custkey = c_custkey, (VALUES (TRUE), (FALSE)) f(readable) GROUP BY readable",
)
oracle(
    "table_sample",
    TO_TIDY,
    f"SELECT contact_id, {rounded(NUMERIC)}, {text(CATEGORICAL)}, {rounded(BINARY)} FROM tidy ORDER BY contact_id LIMIT 1",
)
oracle(
    "checkpoint_profile",
    TO_CLEAN,
    " UNION ALL ".join(
        f"SELECT '{label}' AS label, COUNT(*) AS n_rows, {len(names) + 1} AS n_columns, '{','.join(['contact_id', *names])}' AS columns FROM {table}"
        for label, table, names in (("start", "typed", ALL), ("after_binary", "tidy", ALL), ("end", "cleaned", ALL + FLAGS))
    ),
)

# ---- cleaning -----------------------------------------------------------------

oracle("normalize_categoricals", TO_TIDY, f"SELECT contact_id, {text(CATEGORICAL)} FROM tidy")
oracle("binary_tolerant_map", TO_TIDY, f"SELECT contact_id, {text(BINARY)} FROM tidy")
oracle(
    "binary_unmappable_census",
    TO_TIDY,
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (t.{q(c)} = 1) AS n_one, COUNT(*) FILTER (t.{q(c)} = 0) AS n_zero, "
        f"COUNT(*) FILTER (r.{q(c)} IS NOT NULL AND t.{q(c)} IS NULL) AS n_unmappable, "
        f"COALESCE((SELECT STRING_AGG(v, '|' ORDER BY v) FROM (SELECT DISTINCT LOWER(TRIM(b.{q(c)})) AS v FROM typed b "
        f"JOIN tidy d USING (contact_id) WHERE b.{q(c)} IS NOT NULL AND d.{q(c)} IS NULL ORDER BY v LIMIT 5)), '') AS offenders "
        f"FROM typed r JOIN tidy t USING (contact_id)"
        for c in BINARY
    ),
)
oracle("flag_negative", TO_TYPED, f"SELECT contact_id, balance, {FLAG_SQL['flag_balance_negativo']} FROM typed")
oracle("flag_sentinel", TO_TYPED, f"SELECT contact_id, pdays, {FLAG_SQL['pdays_flag_nuevo_cliente']} FROM typed")
oracle(
    "iqr_bounds",
    [*TO_TYPED, QUARTILES, BOUNDS],
    f"SELECT column_name, n, {rounded(['q1', 'median', 'q3', 'lower', 'upper'])} FROM bounds",
)
oracle(
    "flag_outliers_iqr",
    [*TO_TYPED, QUARTILES, BOUNDS],
    f"SELECT contact_id, {cols([outlier(c) for c in ('balance', 'campaign', 'previous')])} FROM typed",
)
oracle("flag_outliers_iqr_excl", [*TO_TYPED, QUARTILES, BOUNDS], f"SELECT contact_id, {outlier('pdays')} FROM typed")
oracle("flag_outliers_allnull", TO_RAW, "SELECT contact_id, 0 AS flag_outlier_balance FROM contacts")
oracle("clean_contacts", TO_CLEAN, "SELECT * FROM cleaned")

# ---- features -----------------------------------------------------------------

oracle("drop_leakage", TO_TIDY, "SELECT * EXCLUDE (duration) FROM tidy")
oracle("target_extract", TO_TIDY, "SELECT contact_id, CAST(deposit AS INTEGER) AS y FROM tidy")
for part in ("day", "month"):
    oracle(
        f"cyclic_{part}",
        TO_TIDY,
        f"SELECT contact_id, ROUND({CYCLIC_SQL[part + '_sin']}, 6) AS {part}_sin, ROUND({CYCLIC_SQL[part + '_cos']}, 6) AS {part}_cos FROM tidy",
    )
oracle("scale_robust", [*TO_TYPED, QUARTILES], f"SELECT contact_id, ROUND({ROBUST_SQL}, 6) AS balance FROM typed")
oracle("scale_standard", TO_TYPED, "SELECT contact_id, " + cols([f"ROUND({standard(c)}, 6) AS {c}" for c in STANDARD]) + " FROM typed")
oracle("one_hot", TO_TIDY, f"SELECT contact_id, {cols(list(ONE_HOT_SQL.values()))} FROM tidy")
oracle("ordinal_encode", TO_TIDY, f"SELECT contact_id, {ORDINAL_SQL} AS education FROM tidy")
oracle(
    "passthrough_features",
    TO_FEATURES,
    f"SELECT contact_id, {rounded([*FLAGS, *CYCLIC, 'default', 'housing', 'loan'])} FROM features",
)
ALL_FEATURES = f"SELECT contact_id, {rounded(FEATURES)}, y FROM features"
oracle("feature_matrix", TO_FEATURES, ALL_FEATURES)
oracle("fitted_params_reuse", TO_FEATURES, ALL_FEATURES)
PARTIAL = [c for c in FEATURES if c != "previous" and c != "flag_outlier_previous" and not c.startswith("poutcome")]
oracle("feature_matrix_partial_schema", TO_FEATURES, f"SELECT contact_id, {rounded(PARTIAL)}, y FROM features")

# ---- validation ---------------------------------------------------------------

CHECK = "SELECT '{scope}' AS scope, '{name}' AS check_name, {column} AS column_name, CAST({value} AS DOUBLE) AS value, {detail} AS detail, '{severity}' AS severity, {ok} AS ok{source}"


def check(scope: str, name: str, value: str, severity: str, ok: str, source: str = "", column: str | None = None, detail: str = "''") -> str:
    quoted = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return CHECK.format(scope=scope, name=name, column=quoted, value=value, severity=severity, ok=ok, source=f" FROM {source}" if source else "", detail=detail)


NULL_COUNT = " + ".join(f"(COUNT(*) - COUNT({q(c)}))" for c in FEATURES)
NULLS = f"(SELECT {NULL_COUNT} FROM features)"
COUNTS = {"raw": "(SELECT COUNT(*) FROM typed)", "clean": "(SELECT COUNT(*) FROM cleaned)", "features": "(SELECT COUNT(*) FROM features)"}
ROW_COUNTS = check(
    "structural", "row_counts", COUNTS["features"], "ERROR",
    f"({COUNTS['raw']} = {COUNTS['clean']} AND {COUNTS['clean']} = {COUNTS['features']})",
    detail="CONCAT('raw=', " + COUNTS["raw"] + ", ' clean=', " + COUNTS["clean"] + ", ' features=', " + COUNTS["features"] + ")",
)
NULL_PCT = f"ROUND(CAST({NULLS} AS DOUBLE) / ({COUNTS['features']} * {len(FEATURES)}) * 100, 4)"
NULL_CELLS = [
    check("structural", "null_cells", NULLS, "ERROR", f"{NULLS} = 0"),
    check("structural", "null_pct", NULL_PCT, "INFO", f"{NULLS} = 0"),
]
oracle("check_row_counts", TO_FEATURES, ROW_COUNTS)
oracle("check_null_cells", TO_FEATURES, " UNION ALL ".join(NULL_CELLS))


def variance(column: str, table: str) -> str:
    return check(
        "structural", "zero_variance", f"ROUND(MAX({q(column)}) - MIN({q(column)}), 6)", "INFO",
        f"NOT (COUNT({q(column)}) > 1 AND MIN({q(column)}) = MAX({q(column)}))", table, column,
    )


oracle(
    "check_zero_variance",
    [*TO_FEATURES, "widened AS (SELECT *, CASE WHEN campaign IS NOT NULL THEN 1e0 END AS constant FROM features)"],
    " UNION ALL ".join(variance(c, "widened") for c in [*FEATURES, "constant"]),
)
oracle(
    "check_numeric_types",
    TO_TIDY,
    " UNION ALL ".join(
        check("structural", "numeric_type", f"COUNT({q(c)})", "ERROR", "FALSE" if c in CATEGORICAL else "TRUE", "tidy", c) for c in ALL
    ),
)
oracle(
    "check_flags_present",
    TO_CLEAN,
    " UNION ALL ".join(
        f"SELECT '{f}' AS column_name, FALSE AS ok, CAST(NULL AS BIGINT) AS n_marked"
        if f == "flag_outlier_campaign"
        else f"SELECT '{f}' AS column_name, TRUE AS ok, CAST(SUM({f}) AS BIGINT) AS n_marked FROM cleaned"
        for f in FLAGS
    ),
)
oracle(
    "check_empty_columns",
    TO_FEATURES,
    " UNION ALL ".join(
        check("structural", "empty_column", "COUNT(NULL)" if c == "balance" else f"COUNT({q(c)})", "ERROR", "FALSE" if c == "balance" else f"COUNT({q(c)}) > 0", "features", c)
        for c in FEATURES
    ),
)
SENTINEL = check(
    "semantic", "sentinel_flag", "SUM(pdays_flag_nuevo_cliente)", "ERROR",
    "COUNT(*) FILTER (pdays = -1) = SUM(pdays_flag_nuevo_cliente)", "cleaned", "pdays",
    "CONCAT('values=', COUNT(*) FILTER (pdays = -1), ' flags=', SUM(pdays_flag_nuevo_cliente))",
)
IDENTITY = [
    check(
        "semantic", "cyclic_identity", f"COUNT(*) FILTER ({c}_sin * {c}_sin + {c}_cos * {c}_cos < 0.9999e0)", "WARNING",
        f"COUNT(*) FILTER ({c}_sin * {c}_sin + {c}_cos * {c}_cos < 0.9999e0) = 0", "features", c,
    )
    for c in ("day", "month")
]
DEBT = check(
    "semantic", "double_debt_pct", "ROUND(CAST(COUNT(*) FILTER (housing = 1 AND loan = 1) AS DOUBLE) / COUNT(*) * 100, 2)",
    "INFO", "TRUE", "cleaned",
)
SHARE = "(MIN(n) / CAST(SUM(n) AS DOUBLE) * 100)"
MINORITY = check(
    "semantic", "minority_class_pct", f"ROUND({SHARE}, 2)", "WARNING", f"{SHARE} >= 20",
    "(SELECT deposit, COUNT(*) AS n FROM cleaned WHERE deposit IS NOT NULL GROUP BY deposit)", "deposit",
)
oracle("check_sentinel_flag", TO_CLEAN, SENTINEL)
oracle("check_cyclic_identity", TO_FEATURES, " UNION ALL ".join(IDENTITY))
oracle("metric_double_debt", TO_CLEAN, DEBT)
oracle("check_minority_class", TO_CLEAN, MINORITY)
STRUCTURAL_ERRORS = [
    ROW_COUNTS,
    *NULL_CELLS,
    *[check("structural", "empty_column", f"COUNT({q(c)})", "ERROR", f"COUNT({q(c)}) > 0", "features", c) for c in FEATURES],
]
CHECKS = "checks AS MATERIALIZED (" + " UNION ALL ".join([*STRUCTURAL_ERRORS, SENTINEL, *IDENTITY, DEBT, MINORITY]) + ")"
oracle(
    "validation_status",
    [*TO_FEATURES, CHECKS],
    "SELECT scope, CASE WHEN COUNT(*) FILTER (NOT ok AND severity = 'ERROR') > 0 THEN 'ERROR' "
    "WHEN COUNT(*) FILTER (NOT ok AND severity = 'WARNING') > 0 THEN 'WARNING' ELSE 'OK' END AS status, "
    "COUNT(*) FILTER (NOT ok AND severity = 'ERROR') AS n_errors, "
    "COUNT(*) FILTER (NOT ok AND severity = 'WARNING') AS n_warnings FROM checks GROUP BY scope",
)

# ---- sinks and publishing -----------------------------------------------------

oracle(
    "sink_parquet_roundtrip",
    TO_FEATURES,
    f"SELECT f.contact_id, {cols([f'ROUND(f.{q(c)}, 6) AS {q(c)}' for c in FEATURES])}, f.y, "
    + cols([f"c.{q(c)} AS {c}_text" for c in CATEGORICAL])
    + " FROM features f JOIN cleaned c USING (contact_id)",
)
oracle("sink_csv_roundtrip", TO_FEATURES, ALL_FEATURES)
RENAMED = {"default": "default_flag", "deposit": "y"}


def published(table: str, names: list[str]) -> str:
    whole = [f"COALESCE(CAST({q(c)} AS INTEGER), 0) AS {RENAMED.get(c, c)}" for c in names]
    return f"SELECT contact_id, {text(NUMERIC + CATEGORICAL)}, {cols(whole)} FROM {table}"


oracle("publish_projection", TO_CLEAN, published("cleaned", BINARY + FLAGS))
oracle(
    "keyed_upsert",
    [*TO_TIDY, f"published AS ({published('tidy', BINARY)})"],
    "SELECT * REPLACE (CASE WHEN loan = 1 THEN campaign + 1 ELSE campaign END AS campaign) FROM published",
)
oracle(
    "load_report",
    TO_TIDY,
    f"SELECT COUNT(*) AS n_rows_features, {len(FEATURES)} AS n_features, COUNT(*) AS n_rows_target, "
    "COUNT(*) FILTER (deposit = 0) AS n_class_0, COUNT(*) FILTER (deposit = 1) AS n_class_1, TRUE AS aligned, 'OK' AS status FROM tidy",
)
oracle(
    "alignment_check",
    TO_TIDY,
    "SELECT COUNT(l.contact_id) AS n_left, COUNT(r.contact_id) AS n_right, "
    "COUNT(*) FILTER (l.contact_id IS NULL OR r.contact_id IS NULL) AS n_unmatched, "
    "COUNT(*) FILTER (l.contact_id IS NULL OR r.contact_id IS NULL) = 0 AS aligned "
    "FROM tidy l FULL JOIN (SELECT contact_id FROM tidy WHERE loan IS NOT NULL) r USING (contact_id)",
)

# ---- run KPIs -----------------------------------------------------------------

PHASE_METRICS = """phase_metrics AS MATERIALIZED (
  SELECT CAST(FLOOR(event_id / 6) AS BIGINT) AS run_id,
    CASE event_id % 6 WHEN 0 THEN 'ingesta' WHEN 1 THEN 'limpieza' WHEN 2 THEN 'transformacion'
      WHEN 3 THEN 'validacion_estructural' WHEN 4 THEN 'validacion_semantica' ELSE 'carga' END AS phase,
    value / 10 AS secs, CASE WHEN event_type <> 'error' THEN 'ok' WHEN event_id % 6 IN (3, 4) THEN 'findings' ELSE 'error' END AS status, ts
  FROM events)"""


def run_log(pipelines: int = 20) -> str:
    return f"""run_log AS MATERIALIZED (
  SELECT run_id, run_id % {pipelines} AS pipeline_id, MIN(ts) AS ts,
    CASE WHEN COUNT(*) < 6 OR BOOL_OR(status = 'error') THEN 'error' WHEN BOOL_OR(status = 'findings') THEN 'warning'
      ELSE 'success' END AS status,
    ROUND(SUM(secs), 6) AS secs, 1000 + run_id % 5000 AS rows_processed,
    (1000 + run_id % 5000) * 80 AS input_bytes, (1000 + run_id % 5000) * 280 AS output_bytes
  FROM phase_metrics GROUP BY run_id)"""


def traffic(value: str, green: float, yellow: float, lower: bool) -> str:
    sign = "<=" if lower else ">="
    return f"CASE WHEN {value} {sign} {green}e0 THEN 'verde' WHEN {value} {sign} {yellow}e0 THEN 'amarillo' ELSE 'rojo' END"


def spent(phase: str) -> str:
    test = "phase LIKE 'validacion%'" if phase == "validacion" else f"phase = '{phase}'"
    return f"ROUND(COALESCE(SUM(secs) FILTER ({test}), 0e0), 4)"


ROLLUP = (
    "sums AS (SELECT run_id, " + cols([f"{spent(p)} AS {p}_secs" for p in PHASES]) + " FROM phase_metrics GROUP BY run_id),\n"
    "rollup_ AS MATERIALIZED (SELECT *, ROUND(" + " + ".join(f"{p}_secs" for p in PHASES) + ", 4) AS total_secs FROM sums)"
)
SLOWEST = (
    "CASE " + " ".join(
        f"WHEN {p}_secs = GREATEST({', '.join(f'{o}_secs' for o in PHASES)}) THEN '{p}'" for p in PHASES
    ) + " END"
)
RATES = (
    "ROUND(CAST(n_success AS DOUBLE) / n_runs * 100, 2) AS success_pct, "
    "ROUND(CAST(n_success + n_warning AS DOUBLE) / n_runs * 100, 2) AS availability_pct"
)
REGISTRY = """registry AS MATERIALIZED (SELECT pipeline_id, COUNT(*) AS n_runs, COUNT(*) FILTER (status = 'success') AS n_success,
  COUNT(*) FILTER (status = 'warning') AS n_warning, COUNT(*) FILTER (status = 'error') AS n_error
  FROM run_log GROUP BY pipeline_id),
latest AS MATERIALIZED (SELECT * FROM run_log QUALIFY ROW_NUMBER() OVER (PARTITION BY pipeline_id ORDER BY ts DESC, run_id DESC) = 1)"""
TO_RUNS = [PHASE_METRICS, run_log(), REGISTRY]
AVAILABILITY = f"""availability AS MATERIALIZED (SELECT *,
  CASE WHEN last_status = 'error' THEN 'rojo' WHEN success_pct < 95 THEN 'amarillo' ELSE 'verde' END AS light
  FROM (SELECT r.*, {RATES}, l.status AS last_status FROM registry r JOIN latest l USING (pipeline_id)))"""

oracle(
    "traffic_light",
    [PHASE_METRICS],
    f"SELECT run_id, phase, secs, {traffic('secs', 3, 6, True)} AS low_light, {traffic('secs', 6, 3, False)} AS high_light FROM phase_metrics",
)
oracle("run_registry", TO_RUNS, "SELECT * FROM registry")
oracle(
    "run_history_last_n",
    [PHASE_METRICS, run_log(5)],
    "SELECT pipeline_id, run_id, STRFTIME(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, status, secs, CAST(age AS INTEGER) AS age FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pipeline_id "
    "ORDER BY ts DESC, run_id DESC) AS age FROM run_log) WHERE age <= 100",
)
oracle("availability_rates", TO_RUNS, f"SELECT *, {RATES} FROM registry")
oracle("kpi_availability", [*TO_RUNS, AVAILABILITY], "SELECT * FROM availability")
oracle("phase_rollup", [PHASE_METRICS, ROLLUP], "SELECT * FROM rollup_")
PER_SECOND = (
    "CASE WHEN total_secs > 0 THEN ROUND(CAST(rows_processed AS DOUBLE) / total_secs, 1) ELSE 0e0 END AS rows_per_sec, "
    "CASE WHEN total_secs > 0 THEN ROUND(CAST(n_features AS DOUBLE) / total_secs, 1) ELSE 0e0 END AS features_per_sec"
)
# features that any table has, and one for each level that occurs
SINGLE = len([f for f in FEATURES if not f.startswith(("job_", "marital_", "contact_", "poutcome_"))])
WIDTH = (
    f"width AS MATERIALIZED (SELECT {SINGLE} + COUNT(DISTINCT job) + COUNT(DISTINCT marital) + COUNT(DISTINCT contact) "
    "+ COUNT(DISTINCT poutcome) AS n_features FROM tidy)"
)
oracle(
    "throughput",
    [*TO_TIDY, WIDTH, PHASE_METRICS, run_log(), ROLLUP],
    f"SELECT run_id, total_secs, rows_processed, {PER_SECOND} FROM rollup_ JOIN run_log USING (run_id), width",
)
oracle("slowest_phase", [PHASE_METRICS, ROLLUP], f"SELECT run_id, {SLOWEST} AS slowest_phase FROM rollup_")
PERFORMANCE = (
    f"performance AS MATERIALIZED (SELECT r.*, rows_processed, {PER_SECOND}, "
    + cols([f"{traffic(f'{p}_secs', LIMIT[p] * 0.6, LIMIT[p], True)} AS {p}_light" for p in PHASES])
    + f", {SLOWEST} AS slowest_phase, {traffic('total_secs', 60, 120, True)} AS light FROM rollup_ r JOIN run_log USING (run_id), width)"
)
oracle("kpi_performance", [*TO_TIDY, WIDTH, PHASE_METRICS, run_log(), ROLLUP, PERFORMANCE], "SELECT * FROM performance")
COST = f"""costs AS MATERIALIZED (SELECT *, {traffic('total_usd', 0.05, 0.1, True)} AS light FROM (
  SELECT *, ROUND(compute_usd + io_usd + storage_usd, 8) AS total_usd FROM (
    SELECT *, ROUND(secs / 3600 * 0.095e0 * 1.15e0, 8) AS compute_usd,
      ROUND(input_bytes / 1073741824e0 * 0.01e0, 8) AS io_usd, ROUND(output_bytes / 1073741824e0 * 0.02e0, 8) AS storage_usd
    FROM run_log)))"""
oracle("cost_attribution", [PHASE_METRICS, run_log(), COST], "SELECT * REPLACE (STRFTIME(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts) FROM costs")
oracle(
    "cost_unit_economics",
    [PHASE_METRICS, run_log(), COST],
    "SELECT *, LEAST(100e0, ROUND(rows_per_cent / 10000 * 100, 1)) AS efficiency_score FROM (SELECT run_id, rows_processed, total_usd, "
    "CASE WHEN rows_processed > 0 THEN ROUND(total_usd / (CAST(rows_processed AS DOUBLE) / 1000), 8) ELSE 0e0 END AS usd_per_1k_rows, "
    "CASE WHEN total_usd > 0 THEN ROUND(rows_processed / (total_usd * 100), 1) ELSE 0e0 END AS rows_per_cent FROM costs)",
)


def by_batch(table: str) -> str:
    return f"(SELECT *, contact_id % 20 AS pipeline_id FROM {table})"


def batch_check(scope: str, name: str, value: str, severity: str, ok: str, table: str, column: str | None = None) -> str:
    """A check of every pipeline's part of a table."""
    one = check(scope, name, value, severity, ok, by_batch(table) + " b GROUP BY pipeline_id", column)
    return one.replace("SELECT ", "SELECT pipeline_id, ", 1)


SAME_COUNT = " AND ".join(f"COUNT(*) = (SELECT COUNT(*) FROM {t} t WHERE t.contact_id % 20 = b.pipeline_id)" for t in ("typed", "cleaned"))
CLASS_COUNTS = "(SELECT contact_id % 20 AS pipeline_id, deposit, COUNT(*) AS n FROM cleaned WHERE deposit IS NOT NULL GROUP BY 1, 2)"
BATCH_CHECKS = "checks AS MATERIALIZED (" + " UNION ALL ".join(
    [
        batch_check("structural", "row_counts", "COUNT(*)", "ERROR", f"({SAME_COUNT})", "features"),
        batch_check("structural", "null_cells", f"({NULL_COUNT})", "ERROR", f"({NULL_COUNT}) = 0", "features"),
        *[batch_check("structural", "empty_column", f"COUNT({q(c)})", "ERROR", f"COUNT({q(c)}) > 0", "features", c) for c in FEATURES],
        batch_check("semantic", "sentinel_flag", "SUM(pdays_flag_nuevo_cliente)", "ERROR", "COUNT(*) FILTER (pdays = -1) = SUM(pdays_flag_nuevo_cliente)", "cleaned", "pdays"),
        *[
            batch_check(
                "semantic", "cyclic_identity", f"COUNT(*) FILTER ({c}_sin * {c}_sin + {c}_cos * {c}_cos < 0.9999e0)", "WARNING",
                f"COUNT(*) FILTER ({c}_sin * {c}_sin + {c}_cos * {c}_cos < 0.9999e0) = 0", "features", c,
            )
            for c in ("day", "month")
        ],
        check("semantic", "minority_class_pct", f"ROUND({SHARE}, 2)", "WARNING", f"{SHARE} >= 20", f"{CLASS_COUNTS} GROUP BY pipeline_id", "deposit").replace(
            "SELECT ", "SELECT pipeline_id, ", 1
        ),
    ]
) + ")"
VERDICT = "CASE WHEN BOOL_OR(NOT ok AND severity = 'ERROR') FILTER (scope = '{0}') THEN 'ERROR' WHEN BOOL_OR(NOT ok AND severity = 'WARNING') FILTER (scope = '{0}') THEN 'WARNING' ELSE 'OK' END AS {0}"
VERDICTS = f"verdicts AS MATERIALIZED (SELECT pipeline_id, {VERDICT.format('structural')}, {VERDICT.format('semantic')} FROM checks GROUP BY pipeline_id)"
oracle(
    "pipeline_status",
    [*TO_FEATURES, BATCH_CHECKS, VERDICTS, PHASE_METRICS],
    "SELECT *, CASE WHEN raised THEN 'error' WHEN structural = 'ERROR' OR semantic = 'ERROR' THEN 'warning' ELSE 'success' END AS status "
    "FROM (SELECT pipeline_id, run_id, raised, CASE WHEN bad_structure THEN 'ERROR' ELSE structural END AS structural, "
    "CASE WHEN bad_meaning THEN 'ERROR' ELSE semantic END AS semantic FROM (SELECT run_id, run_id % 20 AS pipeline_id, "
    "BOOL_OR(status = 'error') OR COUNT(*) < 6 AS raised, BOOL_OR(phase = 'validacion_estructural' AND status = 'findings') AS bad_structure, "
    "BOOL_OR(phase = 'validacion_semantica' AND status = 'findings') AS bad_meaning FROM phase_metrics GROUP BY run_id) "
    "LEFT JOIN verdicts USING (pipeline_id))",
)
oracle(
    "kpi_partial_run",
    [PHASE_METRICS, ROLLUP],
    "SELECT *, 6 - n_recorded AS n_absent, n_recorded < 6 AS partial FROM rollup_ JOIN (SELECT run_id, COUNT(*) AS n_recorded, "
    "COUNT(*) FILTER (status = 'error') AS n_failed, CASE WHEN COUNT(*) < 6 OR BOOL_OR(status = 'error') THEN 'error' "
    "WHEN BOOL_OR(status = 'findings') THEN 'warning' ELSE 'success' END AS outcome FROM phase_metrics GROUP BY run_id) USING (run_id)",
)

# ---- quality KPIs -------------------------------------------------------------


def points(colour: str, red: int, yellow: int) -> str:
    return f"(CASE {colour} WHEN 'rojo' THEN {red} WHEN 'amarillo' THEN {yellow} ELSE 0 END)"


def null_share(table: str, names: list[str]) -> str:
    nulls = " + ".join(f"(COUNT(*) - COUNT({q(c)}))" for c in names)
    return f"CAST({nulls} AS DOUBLE) / (COUNT(*) * {len(names)}) * 100"


VALID_COUNT = " + ".join(
    f"(CASE WHEN COUNT({q(c)}) < COUNT(*) OR (COUNT({q(c)}) > 1 AND MIN({q(c)}) = MAX({q(c)})) THEN 1 ELSE 0 END)" for c in FEATURES
)


INVALID_LIST = "ARRAY_TO_STRING(LIST_SORT(LIST_FILTER([" + ", ".join(
    f"CASE WHEN COUNT({q(c)}) < COUNT(*) OR (COUNT({q(c)}) > 1 AND MIN({q(c)}) = MAX({q(c)})) THEN '{c}' END" for c in FEATURES
) + "], lambda x: x IS NOT NULL)), ',')"


def quality_sql(grouped: bool) -> str:
    """CTEs ending in ``scored`` with one row per batch, or one for the whole table."""
    key = "pipeline_id" if grouped else "0"
    raw, clean, x = (by_batch(t) if grouped else t for t in ("typed", "cleaned", "features"))
    outliers = cols(
        [f"ROUND(CAST(SUM({f}) AS DOUBLE) / COUNT(*) * 100, 2) AS pct_{c}" for c, f in OUTLIERS.items()]
    )
    marked = cols([f"CAST(SUM({f}) AS BIGINT) AS n_{f}, ROUND(CAST(SUM({f}) AS DOUBLE) / COUNT(*) * 100, 2) AS pct_{f}" for f in FLAGS])
    outlier_points = " + ".join(points(traffic(f"pct_{c}", 5, 15, True), 10, 5) for c in OUTLIERS)
    return f"""raw_side AS (SELECT {key} AS g, {null_share('typed', ALL)} AS raw_null FROM {raw} GROUP BY 1),
clean_side AS (SELECT {key} AS g, {null_share('cleaned', ALL + FLAGS)} AS clean_null, {outliers}, {marked} FROM {clean} GROUP BY 1),
x_side AS (SELECT {key} AS g, COUNT(*) AS n_rows, {null_share('features', FEATURES)} AS x_null, {VALID_COUNT} AS n_invalid, {INVALID_LIST} AS invalid_columns, COUNT(*) FILTER (y = 0) AS n0, COUNT(*) FILTER (y = 1) AS n1,
  LEAST(CASE WHEN COUNT(*) FILTER (y = 0) > 0 THEN COUNT(*) FILTER (y = 0) END, CASE WHEN COUNT(*) FILTER (y = 1) > 0 THEN
  COUNT(*) FILTER (y = 1) END) / CAST(COUNT(y) AS DOUBLE) * 100 AS minority FROM {x} GROUP BY 1),
lit AS (SELECT *, {traffic('x_null', 0, 1, True)} AS null_light, {traffic('minority', 20, 10, False)} AS class_light,
  ROUND(({len(FEATURES)} - n_invalid) / {len(FEATURES)}e0 * 100, 2) AS valid_columns_pct, {outlier_points} AS outlier_penalty
  FROM raw_side JOIN clean_side USING (g) JOIN x_side USING (g)),
marked AS (SELECT *, {traffic('valid_columns_pct', 90, 80, False)} AS columns_light FROM lit),
pointed AS (SELECT *, {points('null_light', 30, 10)} + outlier_penalty + {points('class_light', 10, 5)} + {points('columns_light', 15, 7)} AS lost_points FROM marked),
scored AS MATERIALIZED (SELECT *, GREATEST(0, 100 - lost_points) AS quality_score, {traffic('GREATEST(0, 100 - lost_points)', 85, 60, False)} AS light FROM pointed)"""


oracle(
    "kpi_missing_pct",
    [*TO_FEATURES, quality_sql(False)],
    f"SELECT ROUND(raw_null, 4) AS raw_null_pct, ROUND(clean_null, 4) AS clean_null_pct, ROUND(x_null, 4) AS x_null_pct, "
    f"null_light AS light, {points('null_light', 30, 10)} AS penalty FROM scored",
)
oracle(
    "kpi_outlier_pct",
    [
        *TO_CLEAN,
        "shares AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(SUM({f}) AS BIGINT) AS n, ROUND(CAST(SUM({f}) AS DOUBLE) / COUNT(*) * 100, 2) AS pct FROM cleaned"
            for c, f in OUTLIERS.items()
        ) + "), lights AS (SELECT *, " + traffic("pct", 5, 15, True) + " AS light FROM shares)",
    ],
    f"SELECT *, {points('light', 10, 5)} AS penalty FROM lights",
)
oracle(
    "kpi_class_balance",
    [
        *TO_TIDY,
        f"counted AS (SELECT pipeline_id, COUNT(*) FILTER (deposit = 0) AS n_class_0, COUNT(*) FILTER (deposit = 1) AS n_class_1 FROM {by_batch('tidy')} GROUP BY 1)",
        "shares AS (SELECT *, ROUND(n_class_0 / CAST(n_class_0 + n_class_1 AS DOUBLE) * 100, 2) AS class_0_pct, "
        "ROUND(n_class_1 / CAST(n_class_0 + n_class_1 AS DOUBLE) * 100, 2) AS class_1_pct, "
        "ROUND(CAST(GREATEST(n_class_0, n_class_1) AS DOUBLE) / LEAST(n_class_0, n_class_1), 2) AS imbalance_ratio, "
        + traffic("(LEAST(n_class_0, n_class_1) / CAST(n_class_0 + n_class_1 AS DOUBLE) * 100)", 20, 10, False)
        + " AS light FROM counted)",
    ],
    f"SELECT *, {points('light', 10, 5)} AS penalty FROM shares",
)
INVALID_NAMES = "(SELECT STRING_AGG(c, ',' ORDER BY c) FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS c FROM features HAVING COUNT({q(c)}) < COUNT(*) OR (COUNT({q(c)}) > 1 AND MIN({q(c)}) = MAX({q(c)}))"
    for c in FEATURES
) + "))"
oracle(
    "kpi_valid_columns",
    [*TO_FEATURES, quality_sql(False)],
    f"SELECT {len(FEATURES)} AS n_columns, n_invalid, {INVALID_NAMES} AS invalid_columns, valid_columns_pct AS valid_pct, columns_light AS light, "
    f"{points('columns_light', 15, 7)} AS penalty FROM scored",
)
oracle(
    "kpi_quality_score",
    [*TO_FEATURES, quality_sql(False)],
    "SELECT n_rows, ROUND(raw_null, 4) AS raw_null_pct, ROUND(clean_null, 4) AS clean_null_pct, ROUND(x_null, 4) AS x_null_pct, "
    "null_light, class_light, valid_columns_pct, columns_light, outlier_penalty, TRUE AS types_ok, TRUE AS aligned, lost_points, "
    "quality_score, light FROM scored",
)
oracle(
    "kpi_flag_activation",
    TO_CLEAN,
    " UNION ALL ".join(
        f"SELECT '{f}' AS column_name, CAST(SUM({f}) AS BIGINT) AS n, ROUND(CAST(SUM({f}) AS DOUBLE) / COUNT(*) * 100, 2) AS pct FROM cleaned"
        for f in FLAGS
    ),
)

# ---- health -------------------------------------------------------------------

TO_HEALTH = [*TO_FEATURES, WIDTH, quality_sql(True), *TO_RUNS, AVAILABILITY, ROLLUP, PERFORMANCE, COST]
POINTS = "(CASE {0} WHEN 'verde' THEN 100 WHEN 'amarillo' THEN 60 ELSE 0 END)"
HEALTH = f"""parts AS MATERIALIZED (SELECT a.pipeline_id, a.light AS a_light, p.light AS p_light, c.light AS c_light, s.light AS q_light,
  a.success_pct, p.total_secs, c.total_usd, ROUND(s.x_null, 4) AS x_null_pct, {POINTS.format('a.light')} AS availability_score,
  {POINTS.format('p.light')} AS performance_score, s.quality_score, {POINTS.format('c.light')} AS cost_score, l.status, l.rows_processed
  FROM availability a JOIN latest l USING (pipeline_id) JOIN performance p ON p.run_id = l.run_id JOIN costs c ON c.run_id = l.run_id
  JOIN scored s ON s.g = a.pipeline_id),
healthy AS MATERIALIZED (SELECT *, {traffic('health_score', 85, 60, False)} AS health_light FROM (SELECT *,
  ROUND(availability_score * 0.3e0 + performance_score * 0.2e0 + quality_score * 0.4e0 + cost_score * 0.1e0, 1) AS health_score FROM parts))"""
oracle(
    "health_score",
    [*TO_HEALTH, HEALTH],
    "SELECT pipeline_id, availability_score, performance_score, quality_score, cost_score, health_score, health_light FROM healthy",
)
RULES = [
    ("a_light = 'rojo'", "availability_red", "success_pct"),
    ("p_light = 'rojo'", "performance_red", "total_secs"),
    ("q_light = 'rojo'", "quality_red", "quality_score"),
    ("x_null_pct > 0", "nulls_in_features", "x_null_pct"),
    ("c_light = 'rojo'", "cost_red", "total_usd"),
]
CHECK_ALERTS = """check_alerts AS MATERIALIZED (SELECT pipeline_id, CONCAT_WS(':', scope, check_name, CASE scope WHEN 'semantic' THEN column_name END) AS alert,
  CASE scope WHEN 'semantic' THEN 'warning' ELSE 'critical' END AS level,
  COALESCE(MAX(value) FILTER (scope = 'semantic' OR column_name IS NULL), CAST(COUNT(column_name) AS DOUBLE)) AS value
  FROM checks WHERE NOT ok AND ((scope = 'semantic' AND severity = 'WARNING') OR (scope = 'structural' AND severity = 'ERROR')) GROUP BY 1, 2, 3),
alert_counts AS MATERIALIZED (SELECT pipeline_id, CAST(COUNT(*) AS INTEGER) AS n FROM check_alerts GROUP BY 1)"""
TO_ALERTS = [*TO_HEALTH, HEALTH, BATCH_CHECKS, CHECK_ALERTS]
oracle(
    "alerts",
    TO_ALERTS,
    " UNION ALL ".join(
        [
            f"SELECT pipeline_id, '{name}' AS alert, 'red' AS level, ROUND(CAST({value} AS DOUBLE), 6) AS value FROM healthy WHERE {test}"
            for test, name, value in RULES
        ]
        + ["SELECT pipeline_id, alert, level, ROUND(value, 6) FROM check_alerts"]
    ),
)
oracle(
    "kpi_summary",
    TO_ALERTS,
    "SELECT pipeline_id, health_score, health_light, availability_score, performance_score, quality_score, cost_score, "
    + " + ".join(f"(CASE WHEN {test} THEN 1 ELSE 0 END)" for test, _, _ in RULES)
    + " + COALESCE(a.n, 0) AS n_alerts, status, rows_processed, "
    "(SELECT CAST(n_features AS INTEGER) FROM width) AS n_features FROM healthy LEFT JOIN alert_counts a USING (pipeline_id)",
)
oracle(
    "kpi_report_json",
    [*TO_ALERTS, VERDICTS],
    "SELECT h.pipeline_id, TRUE AS availability_available, TRUE AS availability_readable, a.last_status AS availability_status, "
    + cols([f"a.{c} AS availability_{c}" for c in ("n_runs", "n_success", "n_warning", "n_error", "success_pct", "availability_pct", "light")])
    + ", "
    + cols([f"ROUND(p.{c}, 6) AS performance_{c}" for c in ("total_secs", *[f"{x}_secs" for x in PHASES], "rows_per_sec", "features_per_sec")])
    + ", "
    + cols([f"p.{c} AS performance_{c}" for c in (*[f"{x}_light" for x in PHASES], "slowest_phase", "light")])
    + ", s.quality_score AS quality_score, s.light AS quality_light, TRUE AS quality_types_ok, TRUE AS quality_aligned, "
    "ROUND(s.x_null, 4) AS quality_x_null_pct, ROUND(s.raw_null, 4) AS quality_raw_null_pct, ROUND(s.clean_null, 4) AS quality_clean_null_pct, "
    "s.n_rows AS quality_n_rows, s.lost_points AS quality_lost_points, s.outlier_penalty AS quality_outlier_penalty, "
    "ROUND(CAST(s.n0 AS DOUBLE) / (s.n0 + s.n1) * 100, 2) AS quality_class_0_pct, ROUND(CAST(s.n1 AS DOUBLE) / (s.n0 + s.n1) * 100, 2) AS quality_class_1_pct, "
    "ROUND(CAST(GREATEST(s.n0, s.n1) AS DOUBLE) / LEAST(s.n0, s.n1), 2) AS quality_imbalance_ratio, "
    + cols([f"s.{c} AS quality_{c}" for c in ("null_light", "class_light", "valid_columns_pct", "columns_light", "invalid_columns")])
    + ", "
    + cols([f"s.pct_{c} AS quality_outlier_pct_{c}" for c in OUTLIERS])
    + ", "
    + cols([f"s.n_{f} AS quality_n_{f}, s.pct_{f} AS quality_pct_{f}" for f in FLAGS])
    + ", v.structural AS quality_structural_status, v.semantic AS quality_semantic_status, "
    + cols([f"ROUND(c.{x}, 6) AS cost_{x}" for x in ("compute_usd", "io_usd", "storage_usd", "total_usd")])
    + ", ROUND(ROUND(c.total_usd / (CAST(c.rows_processed AS DOUBLE) / 1000), 8), 6) AS cost_usd_per_1k_rows, "
    "ROUND(c.rows_processed / (c.total_usd * 100), 1) AS cost_rows_per_cent, "
    "LEAST(100e0, ROUND(ROUND(c.rows_processed / (c.total_usd * 100), 1) / 10000 * 100, 1)) AS cost_efficiency_score, "
    "c.light AS cost_light, c.rows_processed AS cost_rows_processed, c.input_bytes AS cost_input_bytes, c.output_bytes AS cost_output_bytes, "
    "CAST(w.n_features AS INTEGER) AS cost_n_features, 0.095e0 AS cost_compute_usd_per_hour, 0.01e0 AS cost_io_usd_per_gb, "
    "0.02e0 AS cost_storage_usd_per_gb_month, 1.15e0 AS cost_overhead_factor, "
    "'OK' AS load_status, (SELECT COUNT(*) FROM features) AS load_n_rows_features, CAST(w.n_features AS INTEGER) AS load_n_features, "
    "(SELECT COUNT(*) FROM cleaned) AS load_n_rows_target, (SELECT COUNT(*) FROM cleaned WHERE deposit = 0) AS load_n_class_0, "
    "(SELECT COUNT(*) FROM cleaned WHERE deposit = 1) AS load_n_class_1, TRUE AS load_aligned, "
    "h.health_score AS summary_health_score, h.health_light AS summary_light, "
    + " + ".join(f"(CASE WHEN h.{test} THEN 1 ELSE 0 END)" for test, _, _ in RULES)
    + " + COALESCE(n.n, 0) AS summary_n_alerts, a.last_status AS summary_status, "
    "h.rows_processed AS summary_rows_processed, CAST(w.n_features AS INTEGER) AS summary_n_features "
    "FROM healthy h JOIN availability a USING (pipeline_id) JOIN latest l USING (pipeline_id) JOIN performance p ON p.run_id = l.run_id "
    "JOIN costs c ON c.run_id = l.run_id JOIN scored s ON s.g = h.pipeline_id JOIN verdicts v USING (pipeline_id) "
    "LEFT JOIN alert_counts n USING (pipeline_id), width w",
)
