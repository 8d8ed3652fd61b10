"""The queries of the catalog as SQL for DuckDB, each one statement over the same tables."""

from __future__ import annotations

from precinct.schema import CATEGORICAL, FLAGS, NUMERIC, PIVOT_LABELS, RANKED_LABELS

_INCIDENTS = """
items AS (
  SELECT l_orderkey, CAST(count(*) AS INTEGER) AS total_offense,
         CAST(count(DISTINCT l_suppkey) AS INTEGER) AS total_victim,
         CAST(count(DISTINCT l_returnflag) AS INTEGER) AS total_offender
  FROM lineitem GROUP BY l_orderkey),
incidents AS (
  SELECT o_orderkey AS incident_number, n_name AS state,
         CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_HRF,
         CASE WHEN o_orderkey % 26 = 25 THEN NULL
              WHEN o_orderkey % 26 = 24 THEN 'Unknown'
              WHEN o_orderkey % 26 = 0 THEN 'On or between midnight and 0059'
              ELSE 'On or between ' || lpad(CAST(o_orderkey % 26 AS VARCHAR), 2, '0') || '00 and '
                   || lpad(CAST(o_orderkey % 26 AS VARCHAR), 2, '0') || '59' END AS hour,
         total_offense, total_victim, total_offender,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 4 <> 0 THEN 1 ELSE 0 END AS gun_involvement,
         CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderkey % 5 <> 0 THEN 1 ELSE 0 END AS drug_involvement,
         CASE WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 3 <> 0 THEN 1 ELSE 0 END AS stolen_motor,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS property_value,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS violence_offense,
         CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS theft_offense,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 WHEN o_orderkey % 17 = 0 THEN NULL ELSE 0 END AS drug_offense,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 1 ELSE 0 END AS sex_offense,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 1 ELSE 0 END AS kidnapping_trafficking,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' OR o_totalprice > 450000 THEN 1 ELSE 0 END AS other_offense
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN items ON o_orderkey = l_orderkey)"""

_FEATURES = (
    _INCIDENTS
    + """,
dated AS (
  SELECT *, CAST(try_strptime(CAST(date_HRF AS VARCHAR), '%Y%m%d') AS DATE) AS INCIDENT_DATE,
         violence_offense + theft_offense + drug_offense + sex_offense + kidnapping_trafficking + other_offense
           AS OFFENSE_FLAGS_SUM
  FROM incidents WHERE total_offense > 0),
features AS (
  SELECT incident_number AS A_INCIDENT_ID, state, date_HRF AS INCIDENT_DATE_RAW, INCIDENT_DATE, OFFENSE_FLAGS_SUM,
         CASE WHEN dayofweek(INCIDENT_DATE) IN (5, 6) THEN 'FIN_SEMANA' ELSE 'DIA_SEMANA' END AS TIPO_DIA,
         CASE WHEN hour IS NULL THEN NULL WHEN contains(lower(hour), 'midnight') THEN '00'
              WHEN regexp_extract(hour, '(\\d{2})\\d{2}', 1) = '' THEN 'UNK'
              ELSE regexp_extract(hour, '(\\d{2})\\d{2}', 1) END AS HOUR_BUCKET,
         CAST(month(INCIDENT_DATE) AS VARCHAR) AS MONTH,
         CASE WHEN OFFENSE_FLAGS_SUM > 1 THEN 'MULTIPLE' WHEN violence_offense = 1 THEN 'VIOLENCE'
              WHEN theft_offense = 1 THEN 'THEFT' WHEN drug_offense = 1 THEN 'DRUG' WHEN sex_offense = 1 THEN 'SEX'
              WHEN kidnapping_trafficking = 1 THEN 'KIDNAPPING_TRAFFICKING' WHEN other_offense = 1 THEN 'OTHER'
              ELSE 'UNKNOWN' END AS INCIDENT_TYPE,
         total_offense AS TOTAL_DELITOS, coalesce(total_victim, 0) AS total_victim,
         coalesce(total_offender, 0) AS total_offender, gun_involvement, drug_involvement, stolen_motor,
         coalesce(property_value, 0.0) AS property_value,
         violence_offense, theft_offense, drug_offense, sex_offense, kidnapping_trafficking, other_offense,
         CAST('0x' || substr(md5('split' || CAST(incident_number AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 * 100 AS pct,
         CAST('0x' || substr(md5('sample' || CAST(incident_number AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 * 100
           AS sample_pct
  FROM dated)"""
)

_LABELS = (
    _FEATURES
    + """,
dict AS (
  SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, INCIDENT_TYPE) - 1 AS DOUBLE) AS label,
         INCIDENT_TYPE, count(*) AS "count"
  FROM features WHERE pct < 80 GROUP BY INCIDENT_TYPE)"""
)


def _predictions(name: str, by: tuple[str, ...]) -> str:
    """CTEs {name}_preds (label, prediction as names, one row per test incident) and its metrics."""
    cols = ", ".join(by)
    on = " AND ".join(f"f.{c} IS NOT DISTINCT FROM g.{c}" for c in by)
    return f""",
{name}_best AS (
  SELECT {cols}, INCIDENT_TYPE AS guess FROM features WHERE pct < 80 GROUP BY {cols}, INCIDENT_TYPE
  QUALIFY row_number() OVER (PARTITION BY {cols} ORDER BY count(*) DESC, INCIDENT_TYPE) = 1),
{name}_preds AS (
  SELECT f.INCIDENT_TYPE AS label, coalesce(g.guess, (SELECT INCIDENT_TYPE FROM dict WHERE label = 0)) AS prediction
  FROM features f LEFT JOIN {name}_best g ON {on}
  WHERE f.pct >= 80 AND f.INCIDENT_TYPE IN (SELECT INCIDENT_TYPE FROM dict)),
{name}_raw AS (
  SELECT d.label, d.INCIDENT_TYPE AS class,
         (SELECT count(*) FROM {name}_preds p WHERE p.label = d.INCIDENT_TYPE) AS support,
         (SELECT count(*) FROM {name}_preds p WHERE p.prediction = d.INCIDENT_TYPE) AS predicted,
         (SELECT count(*) FROM {name}_preds p WHERE p.label = d.INCIDENT_TYPE AND p.prediction = p.label) AS tp
  FROM dict d),
{name}_ratio AS (
  SELECT *, CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS p,
         CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS r FROM {name}_raw),
{name}_class AS (
  SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM {name}_ratio),
{name}_all AS (
  SELECT CAST(sum(support) AS BIGINT) AS scored_rows, CAST(sum(tp) AS DOUBLE) / sum(support) AS accuracy,
         sum(support * f) / sum(support) AS f1 FROM {name}_class)"""


_STATE = _predictions("state", ("state",))
_INVOLVEMENT = _predictions("inv", ("gun_involvement", "drug_involvement", "stolen_motor"))

_SUMMARIES = (
    _LABELS
    + _STATE
    + _INVOLVEMENT
    + """,
counts AS (
  SELECT (SELECT count(*) FROM incidents) AS records_total, count(*) AS records_processed,
         count(*) FILTER (WHERE pct < 80) AS train_rows, count(*) FILTER (WHERE pct >= 80) AS test_rows
  FROM features),
phases AS (
  SELECT event_type, CAST(sum(CAST(value AS DECIMAL(12, 2))) AS DOUBLE) AS seconds FROM events GROUP BY event_type),
total AS (SELECT sum(seconds) AS seconds, count(*) AS phases FROM phases),
summaries AS (
  SELECT 'majority by state' AS algorithm, 2 AS priority, a.accuracy, a.f1, c.*, t.seconds, t.phases
  FROM state_all a, counts c, total t
  UNION ALL
  SELECT 'majority by involvement', 1, a.accuracy, a.f1, c.*, t.seconds, t.phases
  FROM inv_all a, counts c, total t)"""
)

_RUNS = """
runs AS (
  SELECT user_id AS run, CASE user_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 4 ELSE 8 END AS workers,
         CAST(sum(CAST(value AS DECIMAL(12, 2))) AS DOUBLE) AS total
  FROM events GROUP BY user_id),
timed AS (
  SELECT run, workers, CASE WHEN total = 0 THEN total + 1 ELSE total END AS runtime_seconds,
         total + 1 AS wall_seconds,
         'run_workers' || CAST(workers AS VARCHAR) || '_iter' || CAST(run AS VARCHAR) || '.json' AS summary_file
  FROM runs)"""


def _sql(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


_PIVOT = ", ".join(f"count(*) FILTER (WHERE INCIDENT_TYPE = '{x}') AS {x}" for x in PIVOT_LABELS)
_TARGETS = ", ".join(f"'{x}'" for x in PIVOT_LABELS)
_BY_STATE = f""",
by_state AS (
  SELECT state, {_PIVOT} FROM features WHERE INCIDENT_TYPE IN ({_TARGETS}) GROUP BY state)"""
_WEEKLY = """SELECT state, TIPO_DIA, CAST(sum(TOTAL_DELITOS) AS BIGINT) AS Suma_Total_Delitos
FROM features GROUP BY state, TIPO_DIA"""
_FEATURE_COLUMNS = (
    "A_INCIDENT_ID, state, INCIDENT_DATE, TIPO_DIA, HOUR_BUCKET, MONTH, OFFENSE_FLAGS_SUM, INCIDENT_TYPE, "
    + ", ".join(NUMERIC)
)
_CLASS = "class, support, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1"
_RANKS = "\nUNION ALL ".join(
    f"""SELECT state, '{x}' AS INCIDENT_TYPE, {x} AS "count",
  row_number() OVER (ORDER BY {x} DESC, state) AS rank FROM by_state"""
    for x in RANKED_LABELS
)
_CATEGORIES = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS "count",
  CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS idx
FROM features WHERE pct < 80 AND {c} IS NOT NULL GROUP BY {c}"""
    for c in CATEGORICAL
)
_CONFUSION = """SELECT t.label, p.label AS prediction, count(*) AS "count"
FROM {0}_preds x JOIN dict t ON t.INCIDENT_TYPE = x.label JOIN dict p ON p.INCIDENT_TYPE = x.prediction
GROUP BY t.label, p.label"""
_EVALUATION = "\nUNION ALL ".join(
    [f"SELECT class, '{n}' AS metric, {e} AS value FROM state_class" for n, e in
     (("support", "CAST(support AS DOUBLE)"), ("precision", "round(p, 6)"), ("recall", "round(r, 6)"), ("f1", "round(f, 6)"))]
    + [f"SELECT 'all', '{n}', {e} FROM state_all" for n, e in
       (("support", "CAST(scored_rows AS DOUBLE)"), ("accuracy", "round(accuracy, 6)"), ("f1", "round(f1, 6)"))]
)
_WIDTHS = "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS width, count(*) AS train_rows FROM features WHERE pct < 80"
    for c in CATEGORICAL
) + f"""
UNION ALL SELECT 'features', {' + '.join(f'count(DISTINCT {c})' for c in CATEGORICAL)} + {len(NUMERIC)}, count(*)
FROM features WHERE pct < 80"""

_CALENDAR = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {e}) AS width,
  (SELECT count(*) FROM features WHERE pct >= 80 AND INCIDENT_TYPE IN (SELECT INCIDENT_TYPE FROM dict)) AS scored_rows
FROM features WHERE pct < 80"""
    for c, e in [
        *((c, c) for c in CATEGORICAL), ("day_of_week", "dayofweek(INCIDENT_DATE)"),
        ("hour_band", "floor(TRY_CAST(HOUR_BUCKET AS INTEGER) / 6)"),
    ]
)
_MODEL = _sql(
    _LABELS,
    """SELECT INCIDENT_TYPE AS class, (SELECT count(*) FROM features f WHERE pct >= 80 AND f.INCIDENT_TYPE = dict.INCIDENT_TYPE)
  AS support, (SELECT count(*) FROM features WHERE pct >= 80 AND INCIDENT_TYPE IN (SELECT INCIDENT_TYPE FROM dict)) AS scored_rows,
  true AS beats_majority, true AS equals_evaluator FROM dict""",
)

_HEAD_LINES = [
    "'Resumen - Clasificación MLlib'",
    "'Fuente: orders'",
    "'Algoritmo: ' || algorithm",
    "'Leídos: ' || records_total || ' | Procesados: ' || records_processed",
    "'Train: ' || train_rows || ' | Test: ' || test_rows",
    "'Accuracy: ' || printf('%.4f', accuracy) || ' | F1: ' || printf('%.4f', f1)",
    "'Duración: ' || printf('%.2f', seconds / 60) || ' min (' || printf('%.2f', seconds) || ' s)'",
    "'Modelo: models/involvement'",
    "''",
    "'Tiempos por etapa (s):'",
]


def _titled(section: int, title: str, rows: str) -> list[str]:
    """Blank line and header, then the ranked rows (seq, name, line) of one section."""
    return [
        f"SELECT {section} AS section, 0 AS seq, '' AS name, '' AS line WHERE EXISTS ({rows})",
        f"SELECT {section}, 1, '', '{title}' WHERE EXISTS ({rows})",
        f"SELECT {section + 1}, t.* FROM ({rows}) t",
    ]


def _report() -> str:
    parts = [
        f"SELECT 0 AS section, {i} AS seq, '' AS name, {e} AS line FROM summaries WHERE priority = 1"
        for i, e in enumerate(_HEAD_LINES)
    ]
    parts += [
        "SELECT 1, row_number() OVER (ORDER BY event_type) - 1, '', '  ' || event_type || ': ' || printf('%.2f', seconds)"
        " FROM phases",
        "SELECT 2, 0, '', ''",
        "SELECT 2, 1, '', 'Distribución INCIDENT_TYPE (ordenada):'",
        "SELECT 3, -count(*), INCIDENT_TYPE, '  ' || INCIDENT_TYPE || ': ' || count(*) FROM features GROUP BY INCIDENT_TYPE",
    ]
    parts += _titled(
        4, "THEFT por estado (ordenado):",
        "SELECT -THEFT, state, '  ' || state || ': ' || THEFT FROM by_state WHERE THEFT > 0",
    )
    parts += _titled(
        6, "Tipos clave por estado (top 10 ordenado):",
        "SELECT -THEFT, state, '  ' || state || ': THEFT=' || THEFT || ', VIOLENCE=' || VIOLENCE || ', SEX=' || SEX"
        " || ', DRUG=' || DRUG FROM (SELECT * FROM by_state ORDER BY THEFT DESC, state LIMIT 10)",
    )
    for i, x in enumerate(RANKED_LABELS):
        parts += _titled(
            8 + 2 * i, f"{x} por estado (top 10):",
            f"SELECT -{x}, state, '  ' || state || ': ' || {x} FROM (SELECT * FROM by_state ORDER BY {x} DESC, state LIMIT 10)",
        )
    lines = "\nUNION ALL ".join(parts)
    return _sql(
        _SUMMARIES + _BY_STATE,
        f"SELECT CAST(section AS INTEGER) AS section, CAST(seq AS BIGINT) AS seq, name, line FROM ({lines})",
    )


_PROPERTIES = (
    _FEATURES
    + """,
lines AS (
  SELECT l_orderkey, l_linenumber AS k, p_type || '/' || p_brand AS kind,
    CASE l_linestatus WHEN 'F' THEN 'C' WHEN 'O' THEN 'A' END AS mark
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_linenumber <= 3),
properties AS (
  SELECT l_orderkey, list_distinct([min(kind) FILTER (WHERE k = 1), min(kind) FILTER (WHERE k = 2), min(kind) FILTER (WHERE k = 3)])
      AS kinds,
    list_distinct([min(mark) FILTER (WHERE k = 2), min(mark) FILTER (WHERE k = 3)]) AS marks
  FROM lines GROUP BY l_orderkey),
described AS (
  SELECT f.*, coalesce(kinds, []) AS kinds, coalesce(marks, []) AS marks
  FROM features f LEFT JOIN properties ON A_INCIDENT_ID = l_orderkey),
known AS (
  SELECT value FROM (SELECT unnest(kinds) AS value FROM described WHERE pct < 80) GROUP BY value
  HAVING count(*) >= 0.007 * (SELECT count(*) FROM features WHERE pct < 80)),
dict AS (SELECT DISTINCT INCIDENT_TYPE FROM features WHERE pct < 80)"""
)
_DEMOGRAPHIC = {
    "minor_victims": "l_returnflag <> 'R' AND age < 18",
    "female_victims": "l_returnflag <> 'R' AND l_linestatus = 'F'",
    "male_victims": "l_returnflag <> 'R' AND l_linestatus = 'O'",
    "minor_offenders": "l_returnflag = 'R' AND age < 18",
    "female_offenders": "l_returnflag = 'R' AND l_linestatus = 'F'",
    "male_offenders": "l_returnflag = 'R' AND l_linestatus = 'O'",
}
_WIDTH = " + ".join(f"(SELECT count(DISTINCT {c}) FROM features WHERE pct < 80)" for c in CATEGORICAL) + f" + {len(NUMERIC)}"
_SCORED = "pct >= 80 AND INCIDENT_TYPE IN (SELECT INCIDENT_TYPE FROM dict)"
_PERSONS = (
    _LABELS
    + """,
persons AS (
  SELECT l_orderkey, """
    + ", ".join(f"count(*) FILTER (WHERE {e}) AS {c}" for c, e in _DEMOGRAPHIC.items())
    + """ FROM (SELECT *, CASE WHEN l_partkey % 11 <> 0 THEN CAST(floor(l_quantity) AS INTEGER) END AS age FROM lineitem)
  GROUP BY l_orderkey)"""
)
_CUSTOMERS = (
    _INCIDENTS
    + """,
customers AS (
  SELECT incident_number, state, 'C' || o_custkey AS customer,
    CAST('0x' || substr(md5('split' || CAST(incident_number AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.8 AS is_train
  FROM incidents JOIN orders ON incident_number = o_orderkey WHERE total_offense > 0)"""
)


def _customer_ranks(condition: str) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS "count",
  CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS idx FROM customers WHERE {condition} GROUP BY {c}"""
        for c in ("customer", "state")
    )


_DELIVERIES = (
    _FEATURES
    + """,
stored AS (
  SELECT 1 AS run, *, TOTAL_DELITOS AS d FROM features WHERE A_INCIDENT_ID % 3 <> 0
  UNION ALL
  SELECT 2, *, TOTAL_DELITOS + CASE WHEN A_INCIDENT_ID % 3 <> 0 AND A_INCIDENT_ID % 10 = 1 THEN 1 ELSE 0 END FROM features),
state AS (
  SELECT run, count(*) AS stored_rows, CAST(sum(d) AS BIGINT) AS offenses, count(*) FILTER (WHERE pct < 80) AS train_rows,
    count(*) FILTER (WHERE pct >= 80) AS test_rows FROM stored GROUP BY run),
arrived AS (
  SELECT 1 AS run, count(*) AS read_rows, 0 AS replaced_rows FROM incidents WHERE incident_number % 3 <> 0
  UNION ALL
  SELECT 2, count(*), count(*) FILTER (WHERE incident_number % 3 <> 0 AND total_offense > 0) FROM incidents
  WHERE incident_number % 3 = 0 OR incident_number % 10 = 1)"""
)
_TREND = """
SELECT algorithm, run_key, CAST(row_number() OVER o AS INTEGER) AS run, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1,
  round(accuracy - lag(accuracy) OVER o, 6) AS accuracy_change, round(f1 - lag(f1) OVER o, 6) AS f1_change,
  round(avg(accuracy) OVER (o ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS accuracy_mean,
  round(avg(f1) OVER (o ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS f1_mean, f1 >= max(f1) OVER o AS is_best
FROM (
  SELECT 'model ' || CAST(user_id % 3 AS VARCHAR) AS algorithm, CAST(user_id AS VARCHAR) AS run_key, min(ts) AS ts,
    count(*) FILTER (WHERE event_type = 'click') / count(*) AS accuracy,
    count(*) FILTER (WHERE event_type = 'view') / count(*) + CASE WHEN user_id % 5 = 0 THEN 0.125::DOUBLE ELSE 0 END AS f1
  FROM events GROUP BY user_id)
WINDOW o AS (PARTITION BY algorithm ORDER BY ts, run_key)
"""

ORACLE = {
    "csv_roundtrip_count": _sql(
        _INCIDENTS,
        """SELECT count(*) AS rows, count(hour) AS hours, CAST(sum(total_offense) AS BIGINT) AS offenses,
  count(drug_offense) AS drug_flags, CAST(sum(CAST(property_value AS DECIMAL(18, 2))) AS DOUBLE) AS property_value
FROM incidents""",
    ),
    "csv_weekly_offenses": _sql(_FEATURES, _WEEKLY),
    "standardized": _sql(
        _INCIDENTS,
        "SELECT * RENAME (incident_number AS A_INCIDENT_ID, total_offense AS TOTAL_DELITOS,"
        " date_HRF AS INCIDENT_DATE_RAW) FROM incidents",
    ),
    "resolve_columns": _sql(
        _FEATURES, "SELECT state, count(*) AS \"count\" FROM features WHERE INCIDENT_TYPE = 'THEFT' GROUP BY state"
    ),
    "parquet_month_counts": _sql(_FEATURES, 'SELECT MONTH, count(*) AS "count" FROM features GROUP BY MONTH'),
    "valid_incidents": _sql(
        _INCIDENTS, "SELECT incident_number, state, total_offense FROM incidents WHERE total_offense > 0"
    ),
    "numeric_features": _sql(
        _INCIDENTS,
        """SELECT incident_number AS A_INCIDENT_ID, coalesce(total_offense, 0) AS TOTAL_DELITOS,
  coalesce(total_victim, 0) AS total_victim, coalesce(total_offender, 0) AS total_offender, gun_involvement,
  drug_involvement, stolen_motor, coalesce(property_value, 0.0) AS property_value FROM incidents""",
    ),
    "incident_dates": _sql(_FEATURES, "SELECT A_INCIDENT_ID, INCIDENT_DATE_RAW, INCIDENT_DATE FROM features"),
    "day_type": _sql(_FEATURES, "SELECT A_INCIDENT_ID, INCIDENT_DATE, TIPO_DIA FROM features"),
    "month_counts": _sql(_FEATURES, 'SELECT MONTH, count(*) AS "count" FROM features GROUP BY MONTH'),
    "hour_bucket": _sql(_FEATURES, 'SELECT HOUR_BUCKET, count(*) AS "count" FROM features GROUP BY HOUR_BUCKET'),
    "flag_sum": _sql(_FEATURES, "SELECT A_INCIDENT_ID, OFFENSE_FLAGS_SUM FROM features"),
    "incident_type": _sql(_FEATURES, "SELECT A_INCIDENT_ID, INCIDENT_TYPE FROM features"),
    "features_base": _sql(_FEATURES, f"SELECT {_FEATURE_COLUMNS} FROM features"),
    "calendar_bands": _sql(
        _FEATURES,
        """SELECT CAST(dayofweek(INCIDENT_DATE) + 1 AS INTEGER) AS day_of_week,
  CAST(floor(TRY_CAST(HOUR_BUCKET AS INTEGER) / 6) AS INTEGER) AS hour_band, count(*) AS "count"
FROM features GROUP BY 1, 2""",
    ),
    "row_counts": _sql(_SUMMARIES, "SELECT * FROM counts"),
    "weekly_offenses": _sql(_FEATURES, _WEEKLY),
    "weekly_top10": _sql(_FEATURES, _WEEKLY + " ORDER BY Suma_Total_Delitos DESC, state, TIPO_DIA LIMIT 10"),
    "label_distribution": _sql(
        _FEATURES,
        'SELECT INCIDENT_TYPE, count(*) AS "count" FROM features GROUP BY INCIDENT_TYPE'
        " ORDER BY count(*) DESC, INCIDENT_TYPE LIMIT 10",
    ),
    "theft_by_state": _sql(
        _FEATURES, "SELECT state, count(*) AS \"count\" FROM features WHERE INCIDENT_TYPE = 'THEFT' GROUP BY state"
    ),
    "types_by_state": _sql(_FEATURES + _BY_STATE, "SELECT * FROM by_state"),
    "focus_top10": _sql(
        _FEATURES + _BY_STATE,
        "SELECT state, THEFT, VIOLENCE, SEX, DRUG FROM by_state ORDER BY THEFT DESC, state LIMIT 10",
    ),
    "top_states_per_type": _sql(
        _FEATURES + _BY_STATE,
        f'SELECT state, INCIDENT_TYPE, "count", CAST(rank AS INTEGER) AS rank FROM ({_RANKS}) WHERE rank <= 10',
    ),
    "multiple_profile": _sql(
        _FEATURES,
        "SELECT state, count(*) AS \"count\", CAST(sum(TOTAL_DELITOS) AS BIGINT) AS offenses, "
        + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in FLAGS)
        + " FROM features WHERE INCIDENT_TYPE = 'MULTIPLE' GROUP BY state",
    ),
    "split_sizes": _sql(_SUMMARIES, "SELECT train_rows, test_rows FROM counts"),
    "random_split_cover": _sql(
        _FEATURES, "SELECT count(*) AS rows, count(*) AS incidents, CAST(1 AS BIGINT) AS most_times FROM features"
    ),
    "stratified_sample": _sql(
        _FEATURES,
        """SELECT INCIDENT_TYPE, count(*) AS "count" FROM features
WHERE sample_pct < CASE INCIDENT_TYPE WHEN 'THEFT' THEN 50 WHEN 'OTHER' THEN 10 WHEN 'SEX' THEN 100 END
GROUP BY INCIDENT_TYPE""",
    ),
    "fine_split": _sql(
        _FEATURES,
        "SELECT count(*) FILTER (WHERE pct < 99.9) AS train_rows, count(*) FILTER (WHERE pct >= 99.9) AS test_rows FROM features",
    ),
    "sample_then_split": _sql(
        _FEATURES,
        """SELECT INCIDENT_TYPE, pct < 80 AS is_train, count(*) AS "count" FROM features
WHERE sample_pct < CASE INCIDENT_TYPE WHEN 'THEFT' THEN 50 WHEN 'OTHER' THEN 25 WHEN 'SEX' THEN 100 END
GROUP BY 1, 2""",
    ),
    "random_split_sizes": _sql(_FEATURES, "SELECT count(*) AS rows, true AS share_is_near FROM features"),
    "lr_metrics": _MODEL,
    "rf_metrics": _MODEL,
    "scored": _sql(
        _LABELS,
        """SELECT INCIDENT_TYPE AS true_label, count(*) AS "count" FROM features
WHERE pct >= 80 AND INCIDENT_TYPE IN (SELECT INCIDENT_TYPE FROM dict) GROUP BY INCIDENT_TYPE""",
    ),
    "algorithm_choice": _sql(
        _FEATURES,
        """SELECT unnest(['lr', 'rf', 'other']) AS name,
  unnest(['LogisticRegression', 'RandomForestClassifier', 'refused']) AS estimator, count(*) AS train_rows
FROM features WHERE pct < 80""",
    ),
    "fitted_labels": _sql(_LABELS, "SELECT 'INCIDENT_TYPE' AS \"column\", INCIDENT_TYPE AS value, label AS idx FROM dict"),
    "fitted_categories": _sql(_FEATURES, f'SELECT "column", value, idx FROM ({_CATEGORIES})'),
    "calendar_features": _sql(_LABELS, _CALENDAR),
    "training_job": _sql(
        _SUMMARIES + _BY_STATE,
        """SELECT unnest(['records_total', 'records_processed', 'train_rows', 'test_rows']) AS item,
  unnest([records_total, records_processed, train_rows, test_rows]) AS value FROM counts
UNION ALL SELECT 'incident_type_distribution', count(*) FROM features
UNION ALL SELECT 'theft_by_state', count(*) FROM features WHERE INCIDENT_TYPE = 'THEFT'
UNION ALL SELECT 'incident_types_by_state', CAST(sum(THEFT) AS BIGINT) FROM by_state
UNION ALL SELECT unnest(['per_class_metrics_lr', 'confusion_lr']), count(*) FROM features
  WHERE pct >= 80 AND INCIDENT_TYPE IN (SELECT INCIDENT_TYPE FROM dict)
UNION ALL SELECT 'report_lines', count(DISTINCT INCIDENT_TYPE) FROM features""",
    ),
    "model_comparison": _sql(
        _LABELS,
        """SELECT unnest(['LogisticRegression(multinomial)', 'RandomForestClassifier']) AS algorithm,
  count(*) FILTER (WHERE pct < 80) AS train_rows, count(*) FILTER (WHERE pct >= 80) AS test_rows, true AS in_range,
  (SELECT count(*) FROM dict) AS classes,
  count(*) FILTER (WHERE pct >= 80 AND INCIDENT_TYPE IN (SELECT INCIDENT_TYPE FROM dict)) AS support FROM features""",
    ),
    "retrained": _sql(
        _FEATURES,
        """SELECT count(*) FILTER (WHERE pct >= 80 AND INCIDENT_TYPE IN (
    SELECT INCIDENT_TYPE FROM features WHERE pct < 80 AND CAST(MONTH AS INTEGER) <= 6)) AS scored_rows,
  count(DISTINCT MONTH) FILTER (WHERE pct < 80) AS months FROM features WHERE CAST(MONTH AS INTEGER) <= 6""",
    ),
    "csv_text_ids": _sql(
        _FEATURES,
        """SELECT count(*) AS rows, count(DISTINCT id) AS ids, min(id) AS first_id,
  count(*) FILTER (WHERE h < 0.8) AS train_rows, count(*) FILTER (WHERE h >= 0.8) AS test_rows
FROM (SELECT id, CAST('0x' || substr(md5('split' || id), 1, 8) AS BIGINT) / 4294967296.0 AS h
  FROM (SELECT 'AB-' || lpad(CAST(A_INCIDENT_ID AS VARCHAR), 9, '0') AS id FROM features))""",
    ),
    "csv_mixed_headers": _sql(
        _INCIDENTS,
        """SELECT CASE WHEN incident_number % 3 = 2 THEN 'ORI' || (incident_number % 10) END AS ori, count(*) AS rows,
  count(hour) AS hours, CAST(sum(total_offense) AS BIGINT) AS offenses,
  count(*) FILTER (WHERE incident_number % 3 <> 2) AS with_motor,
  CAST(sum(stolen_motor) FILTER (WHERE incident_number % 3 <> 2) AS BIGINT) AS stolen_motor,
  CAST(sum(theft_offense) AS BIGINT) AS thefts, CAST(sum(CAST(property_value AS DECIMAL(18, 2))) AS DOUBLE) AS property_value
FROM incidents GROUP BY 1""",
    ),
    "property_features": _sql(
        _PROPERTIES,
        f"""SELECT A_INCIDENT_ID,
  CAST(len(list_intersect(kinds, ks)) + CASE WHEN len(list_intersect(kinds, ks)) < len(kinds) THEN 1 ELSE 0 END AS BIGINT)
    AS n_properties,
  CAST(len(marks) AS BIGINT) AS n_attempts, len(list_intersect(kinds, ks)) < len(kinds) AS has_rare,
  (SELECT count(*) FROM known) + 1 AS properties_width, CAST(3 AS BIGINT) AS attempts_width,
  {_WIDTH} + (SELECT count(*) FROM known) + 1 + 3 AS features_width
FROM described, (SELECT coalesce(list(value), []) AS ks FROM known) WHERE {_SCORED}""",
    ),
    "demographic_features": _sql(
        _PERSONS,
        f"""SELECT INCIDENT_TYPE, count(*) AS scored_rows,
  {", ".join(f"CAST(sum(coalesce({c}, 0)) AS BIGINT) AS {c}" for c in _DEMOGRAPHIC)},
  {_WIDTH} + {len(_DEMOGRAPHIC)} AS features_width
FROM features LEFT JOIN persons ON A_INCIDENT_ID = l_orderkey WHERE {_SCORED} GROUP BY INCIDENT_TYPE""",
    ),
    "weighted_metrics": _sql(
        _LABELS,
        """SELECT INCIDENT_TYPE AS class, n AS support,
  round(n * ((SELECT CAST(sum("count") AS DOUBLE) / count(*) FROM dict) / "count"), 6) AS weight,
  true AS beats_one_class, true AS equals_evaluator
FROM (SELECT dict.*, (SELECT count(*) FROM features f WHERE pct >= 80 AND f.INCIDENT_TYPE = dict.INCIDENT_TYPE) AS n FROM dict)""",
    ),
    "customer_ranks": _sql(_CUSTOMERS, f'SELECT "column", value, "count", idx FROM ({_customer_ranks("true")})'),
    "customer_index": _sql(
        _CUSTOMERS + f",\nranks AS ({_customer_ranks('is_train')})",
        """SELECT incident_number,
  coalesce(c.idx, (SELECT CAST(count(*) AS DOUBLE) FROM ranks WHERE "column" = 'customer')) AS customer_idx,
  coalesce(s.idx, (SELECT CAST(count(*) AS DOUBLE) FROM ranks WHERE "column" = 'state')) AS state_idx
FROM customers LEFT JOIN ranks c ON c."column" = 'customer' AND c.value = customer
LEFT JOIN ranks s ON s."column" = 'state' AND s.value = state WHERE NOT is_train""",
    ),
    "incremental_retraining": _sql(
        _DELIVERIES,
        """SELECT r.run, CAST(coalesce(read_rows, 0) AS BIGINT) AS read_rows, CAST(coalesce(replaced_rows, 0) AS BIGINT) AS replaced_rows,
  stored_rows, offenses, CASE WHEN r.run < 3 THEN train_rows END AS train_rows, CASE WHEN r.run < 3 THEN test_rows END AS test_rows,
  CASE WHEN r.run < 3 THEN 50 END AS iterations, CAST(2 AS BIGINT) AS published_models
FROM (SELECT unnest([1, 2, 3]) AS run) r JOIN state ON state.run = least(r.run, 2) LEFT JOIN arrived ON arrived.run = r.run""",
    ),
    "metric_trend": _TREND,
    "broken_summaries": _sql(
        _RUNS,
        """SELECT run, workers, round(CASE WHEN run % 7 IN (0, 1) THEN total ELSE wall_seconds END, 2) AS runtime_seconds,
  round(wall_seconds, 2) AS wall_seconds, summary_file,
  CASE WHEN run % 7 = 0 AND run % 5 <> 0 THEN 'total' WHEN run % 7 IN (0, 1) THEN 'phases' ELSE 'wall' END AS source,
  CASE run % 7 WHEN 2 THEN 'broken' WHEN 3 THEN 'broken' WHEN 4 THEN 'missing' WHEN 5 THEN 'empty' WHEN 6 THEN 'stale' ELSE 'good' END
    AS summary
FROM (SELECT timed.*, total FROM timed JOIN runs USING (run))""",
    ),
    "schema_report": _sql(
        _FEATURES,
        """SELECT unnest([0, 1, 2, 3, 4]) AS position,
  unnest(['state', 'INCIDENT_DATE', 'TOTAL_DELITOS', 'property_value', 'INCIDENT_TYPE']) AS name,
  unnest(['string', 'date', 'int', 'double', 'string']) AS type, count(*) AS rows FROM features""",
    ),
    "result_csv": _sql(
        _FEATURES,
        """SELECT state, count(*) AS "count", true AS absent_is_none FROM features
WHERE INCIDENT_TYPE = 'THEFT' GROUP BY state""",
    ),
    "summaries_roundtrip": _sql(
        _SUMMARIES,
        """SELECT algorithm, CAST(1 AS BIGINT) AS records, records_total, round(f1, 6) AS f1 FROM summaries
UNION ALL SELECT 'again', 1, records_total, round(f1, 6) FROM summaries WHERE priority = 2""",
    ),
    "text_roundtrip": _sql(
        _FEATURES,
        """SELECT row_number() OVER (ORDER BY n DESC, state) - 1 AS line_number, state || ': ' || n AS line
FROM (SELECT state, count(*) // 10 AS n FROM features GROUP BY state)""",
    ),
    "run_summary": _sql(
        _SUMMARIES,
        """SELECT true AS stamped, 'orders' AS data_file, records_total, records_processed, train_rows, test_rows, algorithm,
  'models/' || split_part(algorithm, ' by ', 2) AS model_path, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, phases,
  '""" + ",".join(NUMERIC) + """' AS "numeric", round(seconds, 2) AS total_runtime_seconds FROM summaries""",
    ),
    "label_dictionary": _sql(_LABELS, "SELECT * FROM dict"),
    "category_index": _sql(_FEATURES, _CATEGORIES),
    "class_weights": _sql(
        _LABELS,
        """SELECT INCIDENT_TYPE, "count",
  round((SELECT CAST(sum("count") AS DOUBLE) / count(*) FROM dict) / "count", 6) AS weight FROM dict""",
    ),
    "confusion_counts": _sql(_LABELS + _STATE, _CONFUSION.format("state")),
    "confusion_named": _sql(
        _LABELS + _INVOLVEMENT,
        'SELECT label AS true_label, prediction AS pred_label, count(*) AS "count" FROM inv_preds GROUP BY 1, 2',
    ),
    "per_class_metrics": _sql(_LABELS + _INVOLVEMENT, f"SELECT {_CLASS} FROM inv_class"),
    "global_metrics": _sql(
        _LABELS + _INVOLVEMENT, "SELECT scored_rows, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1 FROM inv_all"
    ),
    "evaluation": _sql(_LABELS + _STATE, _EVALUATION),
    "model_roundtrip": _sql(
        _LABELS,
        "SELECT count(*) AS scored_rows, CAST(0 AS BIGINT) AS different FROM features"
        " WHERE pct >= 80 AND INCIDENT_TYPE IN (SELECT INCIDENT_TYPE FROM dict)",
    ),
    "feature_width": _sql(_FEATURES, _WIDTHS),
    "run_summary_read": _sql(
        _SUMMARIES,
        """SELECT algorithm, 'orders' AS data_file, records_total, records_processed, train_rows, test_rows,
  round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, phases, round(seconds, 2) AS phase_seconds,
  round(seconds, 2) AS total_runtime_seconds, 'state,TIPO_DIA,HOUR_BUCKET,MONTH' AS categorical FROM summaries""",
    ),
    "published_metrics": _sql(
        _SUMMARIES, "SELECT algorithm, count(*) AS runs, round(max(f1), 6) AS best_f1 FROM summaries GROUP BY algorithm"
    ),
    "latest_summary": _sql(
        _SUMMARIES,
        """SELECT algorithm, priority, round(accuracy, 6) AS accuracy, train_rows, test_rows
FROM summaries ORDER BY priority LIMIT 1""",
    ),
    "run_kpis": _sql(
        _SUMMARIES,
        """SELECT algorithm, format('{:,}', records_total) AS records_total,
  format('{:,}', records_processed) AS records_processed, format('{:,}', train_rows) AS train_rows,
  format('{:,}', test_rows) AS test_rows, printf('%.4f', accuracy) AS accuracy, printf('%.4f', f1) AS f1,
  printf('%.2f', seconds / 60) AS minutes FROM summaries""",
    ),
    "compare_models": _sql(
        _SUMMARIES,
        "SELECT algorithm, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, train_rows, test_rows FROM summaries",
    ),
    "compare_classes": _sql(
        _LABELS + _STATE + _INVOLVEMENT,
        f"""SELECT 'majority by state' AS algorithm, {_CLASS} FROM state_class
UNION ALL SELECT 'majority by involvement', {_CLASS} FROM inv_class""",
    ),
    "report_lines": _report(),
    "run_seconds": _sql(_RUNS, "SELECT run, round(runtime_seconds, 2) AS runtime_seconds FROM timed"),
    "run_series": _sql(
        _RUNS,
        """SELECT run, workers, round(runtime_seconds, 2) AS runtime_seconds,
  round(wall_seconds, 2) AS wall_seconds, summary_file FROM timed""",
    ),
    "run_stats": _sql(
        _RUNS,
        """SELECT workers, count(*) AS runs, round(min(runtime_seconds), 4) AS min_seconds,
  round(max(runtime_seconds), 4) AS max_seconds, round(avg(runtime_seconds), 4) AS avg_seconds
FROM timed GROUP BY workers""",
    ),
    "phase_timings": """SELECT user_id AS run, event_type AS phase,
  round(CAST(sum(CAST(value AS DECIMAL(12, 2))) AS DOUBLE), 2) AS seconds FROM events GROUP BY user_id, event_type""",
    "formatted_runs": _sql(
        _RUNS,
        """SELECT run, printf('%.3f', runtime_seconds) AS runtime_seconds, printf('%.3f', wall_seconds) AS wall_seconds
FROM timed""",
    ),
}
