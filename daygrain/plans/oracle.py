"""The same results as ANSI SQL over the sample tables, for checking the catalog."""

from __future__ import annotations

from daygrain.names import GENERIC
from daygrain.operators import profile, scenario
from daygrain.operators.aggregates import DIAGNOSTIC_SIGNALS, REPORT_SIGNALS
from daygrain.operators.model import THRESHOLDS
from daygrain.plans.catalog import AS_OF, KINDS
from daygrain.sources.sample_tables import BATCH, EXTRACTED

LINEAGE_SQL = f"'{BATCH}' AS ingest_batch_id, '{EXTRACTED}' AS extracted_at_utc"


def r(expr: str, digits: int = 6) -> str:
    """Rounded double without a negative zero."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def ratio(num: str, den: str, scale: str = "1.0") -> str:
    return f"coalesce(CAST({num} AS DOUBLE) * {scale} / nullif({den}, 0), 0.0)"


def text(col: str) -> str:
    return f"coalesce(CAST({col} AS VARCHAR), 'nan')"


def stamp(col: str) -> str:
    """Six digits of a second's fraction, or none where it is zero."""
    whole, with_fraction = (f"strftime({col}, '%Y-%m-%d %H:%M:%S{x}')" for x in ("", ".%f"))
    return f"coalesce(CASE WHEN microsecond({col}) % 1000000 = 0 THEN {whole} ELSE {with_fraction} END, 'NaT')"


def hash_of(cols: list[str], extra: dict[str, str] | None = None) -> str:
    parts = {c: stamp(c) if c == "ts" else text(c) for c in cols} | {k: f"'{v}'" for k, v in (extra or {}).items()}
    pairs = ", ".join(f"'{c}=' || {parts[c]}" for c in sorted(parts))
    return f"substring(sha256(concat_ws('|', {pairs})), 1, 16)"


def digest_sql(name: str, body: str, cols: str) -> str:
    """The content digest of what ``body`` gives; names in ``cols`` that end in ``:d`` are doubles."""
    pairs = []
    for c in sorted(cols.split(), key=lambda c: c.removesuffix(":d")):
        value = f"CAST(round({c[:-2]} * 1e6) AS BIGINT)" if c.endswith(":d") else c
        pairs.append(f"'{c.removesuffix(':d')}=' || coalesce(CAST({value} AS VARCHAR), '~')")
    number = f"CAST('0x' || substring(md5(concat_ws('|', {', '.join(pairs)})), 1, 12) AS BIGINT)"
    return f"SELECT '{name}' AS name, count(*) AS rows, CAST(coalesce(sum({number}), 0) AS VARCHAR) AS digest FROM ({body}) q_{name}"


SEVERE = "severity IN ('Severe', 'Fatal')"
SUMS = (
    f"count(incident_id) AS accidents, count(*) FILTER (WHERE {SEVERE}) AS severe, "
    "CAST(sum(fatalities) AS BIGINT) AS fatalities"
)

CTES: dict[str, str] = {
    "ev": "SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events",
    "registry": f"""
        SELECT c_custkey AS entity_id, r_name AS region, n_name AS city, c_mktsegment AS kind,
               c_acctbal AS capacity
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "measure_raw": """
        SELECT event_id AS sensor_id, ts, user_id AS entity_id, k * 10 - 100 AS volume,
               CASE WHEN k % 10 <> 9 THEN value END AS speed
        FROM ev WHERE event_type IN ('view', 'click', 'purchase')""",
    "typed_raw": """
        SELECT event_id AS typed_id, ts, user_id AS entity_id, event_type, value AS amount FROM ev""",
    "incident_raw": """
        SELECT event_id AS incident_id, ts, user_id AS entity_id, 1 + k % 5 AS vehicles,
               CASE WHEN k % 7 <> 0 THEN k % 4 END AS injuries, CAST(k >= 85 AS INTEGER) AS fatalities,
               CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'Day' ELSE 'Night' END AS lighting,
               CASE WHEN value <= 10 THEN 'Minor' WHEN value <= 40 THEN 'Moderate'
                    WHEN value <= 90 THEN 'Severe' ELSE 'Fatal' END AS severity
        FROM ev WHERE event_type = 'error'""",
    "context": """
        SELECT event_id AS context_id, ts, region, city,
               CASE k % 4 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Dust' WHEN 2 THEN 'Rain' ELSE 'Fog' END AS mode,
               value / 10 AS visibility, CAST(k % 7 AS DOUBLE) / 2 AS precip, CAST(20 + k % 15 AS DOUBLE) AS temp,
               CAST(ts AS DATE) AS date, date_trunc('hour', ts) AS hour
        FROM ev JOIN registry ON user_id = entity_id WHERE event_type = 'signup'""",
    "measure": """
        SELECT sensor_id, ts, entity_id, CAST(least(500, greatest(0, volume)) AS INTEGER) AS volume,
               least(220.0, greatest(0.0, coalesce(speed, (SELECT quantile_cont(speed, 0.5) FROM measure_raw)))) AS speed,
               CAST(ts AS DATE) AS date
        FROM measure_raw""",
    "typed": """
        SELECT typed_id, ts, entity_id, event_type,
               CAST(trunc(least(10000.0, greatest(0.0, amount))) AS INTEGER) AS amount, CAST(ts AS DATE) AS date
        FROM typed_raw""",
    "incident": f"""
        SELECT incident_id, ts, entity_id, vehicles, coalesce(injuries, 0) AS injuries, fatalities, lighting,
               severity, CAST(ts AS DATE) AS date, date_trunc('hour', ts) AS hour,
               {hash_of(["incident_id", "entity_id", "vehicles", "injuries", "fatalities", "lighting", "severity"])}
               AS record_hash
        FROM incident_raw""",
    "hourly": """
        SELECT * FROM context
        QUALIFY row_number() OVER (PARTITION BY hour, region, city ORDER BY context_id) = 1""",
    "full_incident": """
        SELECT i.*, g.region, g.city, g.kind, g.capacity, h.mode, h.visibility, h.precip, h.temp
        FROM incident i LEFT JOIN registry g USING (entity_id)
        LEFT JOIN hourly h ON h.hour = i.hour AND h.region = g.region AND h.city = g.city""",
    "exposure": """
        SELECT entity_id, date, CAST(sum(volume) AS BIGINT) AS daily_volume, avg(speed) AS mean_speed,
               quantile_cont(speed, 0.95) AS p95_speed, count(sensor_id) AS sensor_events
        FROM measure GROUP BY entity_id, date""",
    "typed_day": "SELECT entity_id, date, "
    + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in GENERIC.types)
    + ", count(*) AS total_violations FROM typed GROUP BY entity_id, date",
    "incident_day": f"""
        SELECT entity_id, date, count(incident_id) AS accidents, CAST(sum(injuries) AS BIGINT) AS injuries,
               CAST(sum(fatalities) AS BIGINT) AS fatalities, count(*) FILTER (WHERE {SEVERE}) AS severe
        FROM incident GROUP BY entity_id, date""",
    "day_mode": """
        SELECT region, city, date, mode FROM context GROUP BY region, city, date, mode
        QUALIFY row_number() OVER (PARTITION BY region, city, date ORDER BY count(*) DESC, mode) = 1""",
    "context_day": """
        SELECT region, city, date, min(day_mode.mode) AS weather_mode,
               count(*) FILTER (WHERE visibility < 4) AS low_visibility_hours,
               count(*) FILTER (WHERE context.mode = 'Rain') AS rain_hours,
               count(*) FILTER (WHERE context.mode = 'Fog') AS fog_hours,
               max(precip) AS max_precip_mm, avg(temp) AS avg_temp_c
        FROM context JOIN day_mode USING (region, city, date) GROUP BY region, city, date""",
    "joined_day": "SELECT x.*, "
    + ", ".join(f"coalesce(t.{c}, 0) AS {c}" for c in (*GENERIC.types, "total_violations"))
    + """, coalesce(i.accidents, 0) AS accidents, coalesce(i.injuries, 0) AS injuries,
               coalesce(i.fatalities, 0) AS fatalities, coalesce(i.severe, 0) AS severe,
               coalesce(g.region, 'Unknown') AS region, coalesce(g.city, 'Unknown') AS city,
               coalesce(g.kind, 'Unknown') AS kind, coalesce(g.capacity, 0) AS capacity,
               coalesce(c.weather_mode, 'Unknown') AS weather_mode,
               coalesce(c.low_visibility_hours, 0) AS low_visibility_hours,
               coalesce(c.rain_hours, 0) AS rain_hours, coalesce(c.fog_hours, 0) AS fog_hours,
               coalesce(c.max_precip_mm, 0) AS max_precip_mm, coalesce(c.avg_temp_c, 0) AS avg_temp_c
        FROM exposure x LEFT JOIN typed_day t USING (entity_id, date) LEFT JOIN incident_day i USING (entity_id, date)
        LEFT JOIN registry g USING (entity_id)
        LEFT JOIN context_day c ON c.region = g.region AND c.city = g.city AND c.date = x.date""",
    "entity_day": f"""
        SELECT *, CAST(fatalities > 0 AS INTEGER) AS has_fatality, {ratio("severe", "accidents")} AS severe_rate,
               {ratio("total_violations", "daily_volume", "1000.0")} AS violations_per_1000_volume
        FROM joined_day""",
    "scored": """
        SELECT *, CAST((entity_id * 7 + day(date) * 13 + daily_volume) % 101 AS DOUBLE) / 100.0 AS score
        FROM entity_day""",
}

# scenario chain ------------------------------------------------------------------------------

WEIGHTS = scenario.PRESSURE_WEIGHTS
TOTAL_WEIGHT = sum(WEIGHTS.values())


def _scaled(feature: str, lo: str, hi: str) -> str:
    return (
        f"CASE WHEN {hi} > {lo} THEN (greatest({lo}, least({hi}, {feature})) - {lo}) / nullif({hi} - {lo}, 0) "
        "ELSE 0.0 END"
    )


PRESSURE = "(" + " + ".join(
    f"{w} * ({_scaled(f'CAST({c} AS DOUBLE)', f'{c}_lo', f'{c}_hi')})" for c, w in WEIGHTS.items()
) + f") / {TOTAL_WEIGHT}"
MODEL_RISK = (
    "1.0 / (1.0 + exp(-(-2.0 + p95_speed * 0.008 + mean_speed * 0.004 + total_violations * 0.05 "
    "+ violations_per_1000_volume * 0.0005 + low_visibility_hours * 0.1)))"
)
BLENDED = f"0.65 * ({MODEL_RISK}) + 0.35 * ({PRESSURE})"
TOUCHED = ("mean_speed", "p95_speed", "total_violations", "violations_per_1000_volume", "low_visibility_hours", "fog_hours", "rain_hours")

CTES["bounds"] = (
    "SELECT "
    + ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), 0.05) AS {c}_lo, quantile_cont(CAST({c} AS DOUBLE), 0.95) AS {c}_hi"
        for c in WEIGHTS
    )
    + " FROM entity_day"
)
CTES["base_risk"] = f"SELECT e.*, {BLENDED} AS baseline_risk FROM entity_day e, bounds"
CTES["limit_risk"] = "SELECT greatest(0.5, quantile_cont(baseline_risk, 0.85)) AS threshold FROM base_risk"
CTES["packages"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{name}', " + ", ".join(str(float(f.get(c, 1.0))) for c in TOUCHED) + ")"
    for name, f in scenario.PACKAGES.items()
) + ") AS p(scenario, " + ", ".join(f"f_{c}" for c in TOUCHED) + ")"
CTES["changed_day"] = (
    "SELECT b.entity_id, b.date, b.region, b.city, b.kind, b.baseline_risk, b.daily_volume, p.scenario, "
    + ", ".join(f"CAST(b.{c} AS DOUBLE) * p.f_{c} AS {c}" for c in TOUCHED)
    + " FROM base_risk b, packages p"
)
CTES["risk_pair"] = f"SELECT c.*, {BLENDED} AS scenario_risk FROM changed_day c, bounds"
CTES["scores"] = """
    SELECT entity_id, date, region, city, kind, scenario, baseline_risk, scenario_risk,
           baseline_risk - scenario_risk AS risk_delta,
           CAST(baseline_risk >= threshold AS INTEGER) AS baseline_high_risk,
           CAST(baseline_risk >= threshold AND scenario_risk < threshold AS INTEGER) AS moved_below_threshold
    FROM risk_pair, limit_risk"""
CTES["summary"] = """
    SELECT scenario, avg(risk_delta) AS avg_risk_reduction, quantile_cont(risk_delta, 0.5) AS median_risk_reduction,
           max(risk_delta) AS max_risk_reduction, avg(baseline_risk) AS avg_baseline_risk,
           avg(scenario_risk) AS avg_scenario_risk,
           CAST(sum(baseline_high_risk) AS BIGINT) AS baseline_high_risk_road_days,
           CAST(sum(moved_below_threshold) AS BIGINT) AS high_risk_road_days_reduced,
           coalesce(CAST(sum(moved_below_threshold) AS DOUBLE) / nullif(sum(baseline_high_risk), 0), 0.0)
           AS high_risk_reduction_rate
    FROM scores WHERE scenario <> 'Baseline' GROUP BY scenario"""

# quality rules -------------------------------------------------------------------------------


def _avg(test: str) -> str:
    return f"avg(CAST({test} AS DOUBLE))"


def _dup(table: str, keys: str) -> str:
    return f"(SELECT CAST(sum(n - 1) AS DOUBLE) / sum(n) FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys}))"


def _in(col: str, values) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"NOT coalesce({col} IN ({listed}), false)"


SEVERITIES = ("Minor", "Moderate", "Severe", "Fatal")
TABLE_SQL = {"registry": "registry", "incident": "full_incident", "entity_day": "entity_day"}
Rule = tuple[str, str | None, float | None, float | None, float | None]


def _on(table: str, metric: str) -> str:
    return f"(SELECT {metric} FROM {TABLE_SQL[table]})"


def contract_rules() -> list[Rule]:
    def kind(table):
        return (f"{table}.contract_invalid_kind_rate", _on(table, _avg(_in("kind", KINDS))), 0.0, 0.0, 0.002)

    def negative(table, col):
        return (f"{table}.contract_negative_{col}_rate", _on(table, _avg(f"coalesce({col}, 0) < 0")), 0.0, 0.0, 0.0)

    def opening(table, keys):
        return [
            (f"{table}.contract_required_columns", None, None, None, None),
            (f"{table}.contract_duplicate_key_rate", _dup(TABLE_SQL[table], keys), 0.0, 0.0, 0.002),
        ]

    return [
        *opening("registry", "entity_id"),
        kind("registry"),
        negative("registry", "capacity"),
        *opening("incident", "incident_id"),
        (
            "incident.contract_invalid_severity_rate",
            _on("incident", _avg(_in("severity", SEVERITIES))),
            0.0,
            0.0,
            0.002,
        ),
        *[negative("incident", c) for c in ("fatalities", "injuries", "vehicles")],
        *opening("entity_day", "entity_id, date"),
        kind("entity_day"),
        *[
            negative("entity_day", c)
            for c in (
                "daily_volume",
                "mean_speed",
                "p95_speed",
                "total_violations",
                "accidents",
                "fatalities",
                "violations_per_1000_volume",
            )
        ],
    ]


RECENCY = f"CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(ts)) AS DOUBLE) / 86400000000.0"
FK = "(SELECT avg(CAST(g.entity_id IS NULL AS DOUBLE)) FROM full_incident i LEFT JOIN registry g USING (entity_id))"


def quality_rules() -> list[Rule]:
    return [
        *contract_rules(),
        ("incident.required_columns", None, None, None, None),
        ("incident.lineage_columns", None, None, None, None),
        ("registry.duplicate_entity_rate", _dup("registry", "entity_id"), 0.0, 0.0, 0.002),
        ("incident.duplicate_id_rate", _dup("full_incident", "incident_id"), 0.001, 0.001, 0.01),
        ("incident.ts_parse_fail_rate", _on("incident", _avg("ts IS NULL")), 0.0, 0.0, 0.0),
        ("incident.null_entity_rate", _on("incident", _avg("entity_id IS NULL")), 0.0005, 0.0005, 0.01),
        ("incident.fk_violation_rate", FK, 0.0005, 0.0005, 0.01),
        ("incident.invalid_severity_rate", _on("incident", _avg(_in("severity", SEVERITIES))), 0.0, 0.0, 0.002),
        ("incident.future_rate", _on("incident", _avg(f"ts > TIMESTAMP '{AS_OF}'")), 0.0, 0.0, 0.0),
        ("incident.recency_days", _on("incident", RECENCY), 7.0, 7.0, 30.0),
        ("incident.missing_context_rate", _on("incident", _avg("mode IS NULL")), 0.02, 0.02, 0.10),
        (
            "entity_day.p95_speed_out_of_range_rate",
            _on("entity_day", _avg("p95_speed < 0 OR p95_speed > 220")),
            0.0,
            0.0,
            0.005,
        ),
        ("entity_day.daily_volume_negative_rate", _on("entity_day", _avg("daily_volume < 0")), 0.0, 0.0, 0.0),
        ("entity_day.duplicate_rate", _dup("entity_day", "entity_id, date"), 0.0, 0.0, 0.001),
        ("entity_day.unknown_context_rate", _on("entity_day", _avg("weather_mode = 'Unknown'")), 0.05, 0.05, 0.15),
        ("entity_day.prevalence_gap", _on("entity_day", f"abs({_avg('has_fatality')} - 0.1)"), 0.10, 0.10, 0.16),
    ]


def rules_sql(rules: list[Rule]) -> str:
    def value(v):
        return "CAST(NULL AS DOUBLE)" if v is None else f"CAST({v} AS DOUBLE)"

    rows = " UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS name, {value(m)} AS metric, {value(t)} AS threshold, "
        f"{value(p)} AS pass_limit, {value(w)} AS warn_limit, "
        f"'{'OK' if p is None else f'PASS up to {p:g}, WARN up to {w:g}'}' AS notes"
        for i, (n, m, t, p, w) in enumerate(rules)
    )
    return (
        "SELECT position, name, CASE WHEN pass_limit IS NULL THEN 'PASS' WHEN metric IS NULL THEN 'FAIL' "
        "WHEN metric <= pass_limit THEN 'PASS' WHEN metric <= warn_limit THEN 'WARN' ELSE 'FAIL' END AS status, "
        f"{r('metric')} AS metric, {r('threshold')} AS threshold, notes FROM ({rows})"
    )


GATE = """
    SELECT count(*) FILTER (WHERE status = 'PASS') AS pass, count(*) FILTER (WHERE status = 'WARN') AS warn,
           count(*) FILTER (WHERE status = 'FAIL') AS fail, count(*) AS total,
           CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'FAIL'
                WHEN count(*) FILTER (WHERE status = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END AS gate_status
    FROM rules"""

# profiling -----------------------------------------------------------------------------------

L = [("source_system", "string"), ("ingest_batch_id", "string"), ("extracted_at_utc", "string"), ("record_hash", "string")]
TABLE_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "registry": [
        ("entity_id", "bigint"),
        ("region", "string"),
        ("city", "string"),
        ("kind", "string"),
        ("capacity", "double"),
        *L,
    ],
    "incident": [
        ("incident_id", "bigint"),
        ("ts", "timestamp_ntz"),
        ("entity_id", "bigint"),
        ("vehicles", "int"),
        ("injuries", "int"),
        ("fatalities", "int"),
        ("lighting", "string"),
        ("severity", "string"),
        *L,
        ("date", "date"),
        ("region", "string"),
        ("city", "string"),
        ("kind", "string"),
        ("capacity", "double"),
        ("mode", "string"),
        ("visibility", "double"),
        ("precip", "double"),
        ("temp", "double"),
    ],
    "typed": [
        ("typed_id", "bigint"),
        ("ts", "timestamp_ntz"),
        ("entity_id", "bigint"),
        ("event_type", "string"),
        ("amount", "int"),
        *L,
        ("date", "date"),
    ],
    "measure": [
        ("sensor_id", "bigint"),
        ("ts", "timestamp_ntz"),
        ("entity_id", "bigint"),
        ("volume", "int"),
        ("speed", "double"),
        *L,
        ("date", "date"),
    ],
    "entity_day": [
        ("entity_id", "bigint"),
        ("date", "date"),
        ("daily_volume", "bigint"),
        ("mean_speed", "double"),
        ("p95_speed", "double"),
        ("sensor_events", "bigint"),
        *[(t, "bigint") for t in GENERIC.types],
        ("total_violations", "bigint"),
        ("accidents", "bigint"),
        ("injuries", "bigint"),
        ("fatalities", "bigint"),
        ("severe", "bigint"),
        ("region", "string"),
        ("city", "string"),
        ("kind", "string"),
        ("capacity", "double"),
        ("weather_mode", "string"),
        ("low_visibility_hours", "bigint"),
        ("rain_hours", "bigint"),
        ("fog_hours", "bigint"),
        ("max_precip_mm", "double"),
        ("avg_temp_c", "double"),
        ("has_fatality", "int"),
        ("severe_rate", "double"),
        ("violations_per_1000_volume", "double"),
    ],
}
SOURCE_OF = {"registry": "registry", "incident": "full_incident", "typed": "typed", "measure": "measure", "entity_day": "entity_day"}
LINEAGE_NAMES = {name for name, _ in L}


def dictionary_sql(tables: list[str]) -> str:
    texts = profile.column_descriptions(GENERIC)
    rows = []
    for table in tables:
        cols = TABLE_COLUMNS[table]
        for i, (name, dtype) in enumerate(cols):
            nulls = "0.0" if name in LINEAGE_NAMES else _avg(f"{name} IS NULL")
            described = texts.get(name, profile.DEFAULT_DESCRIPTION).replace("'", "''")
            rows.append(
                f"SELECT '{table}' AS dataset, {i} AS position, '{name}' AS \"column\", '{dtype}' AS dtype, "
                f"{r(nulls)} AS null_rate, '{described}' AS description, count(*) AS rows, {len(cols)} AS columns "
                f"FROM {SOURCE_OF[table]}"
            )
    return " UNION ALL ".join(rows)


def samples_sql(dataset: str, table: str) -> str:
    parts = []
    for i, (c, dtype) in enumerate(TABLE_COLUMNS[dataset]):
        value = r(c, 3) if dtype == "double" else c
        parts.append(
            f"SELECT '{dataset}' AS dataset, {i} AS position, '{c}' AS \"column\", '{dtype}' AS dtype, "
            f"{r(f'round(avg(CAST({c} IS NULL AS DOUBLE)) * 100, 1)')} AS null_pct, "
            f"(SELECT coalesce(string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v), '') FROM (SELECT DISTINCT {value} AS v "
            f"FROM {table} WHERE {c} IS NOT NULL ORDER BY v LIMIT 3)) AS samples FROM {table}"
        )
    return " UNION ALL ".join(parts)


# assembly ------------------------------------------------------------------------------------


def sql(body: str, **extra: str) -> str:
    """The body behind the shared views it needs, directly or through another view."""
    views = {**CTES, **extra}
    needed: set[str] = set()
    pending = [body]
    while pending:
        piece = pending.pop()
        for name, definition in views.items():
            if name not in needed and _mentions(piece, name):
                needed.add(name)
                pending.append(definition)
    chosen = ", ".join(f"{name} AS ({views[name]})" for name in views if name in needed)
    return f"WITH {chosen} {body}" if chosen else body


def _mentions(piece: str, name: str) -> bool:
    import re

    return re.search(rf"\b{name}\b", piece) is not None


def rounded_columns(table: str, skip: tuple[str, ...] = ()) -> str:
    """Column list with doubles rounded."""
    return ", ".join(
        f"{r(c)} AS {c}" if t == "double" else c
        for c, t in TABLE_COLUMNS[table]
        if c not in skip and c not in LINEAGE_NAMES
    )


def _profile_by(dims: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d} AS value, {SUMS}, {r(ratio(f'count(*) FILTER (WHERE {SEVERE})', 'count(incident_id)'))} "
        f"AS severe_rate FROM full_incident WHERE {d} IS NOT NULL GROUP BY {d}"
        for d in dims
    )


WEEKLY = (
    "SELECT CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) || '/' || "
    "CAST(CAST(date_trunc('week', ts) AS DATE) + 6 AS VARCHAR) AS week, " + SUMS + " FROM incident GROUP BY 1"
)
HOT = (
    f"SELECT entity_id, region, city, kind, {SUMS}, "
    f"{ratio(f'count(*) FILTER (WHERE {SEVERE})', 'count(incident_id)')} AS severe_rate "
    "FROM full_incident WHERE region IS NOT NULL GROUP BY entity_id, region, city, kind"
)
HOT_COLUMNS = f"entity_id, region, city, kind, accidents, severe, fatalities, {r('severe_rate')} AS severe_rate"


def _correlations(cols, k: int) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS signal, covar_pop({c}, has_fatality) / nullif(stddev_pop({c}) * stddev_pop(has_fatality), 0) "
        "AS corr FROM entity_day"
        for c in cols
    )
    return (
        f"SELECT signal, {r('corr')} AS corr FROM ({rows}) WHERE corr IS NOT NULL "
        f"ORDER BY abs(corr) DESC, signal LIMIT {k}"
    )


def _auc(table: str, group: str = "") -> str:
    """Mann-Whitney with average ranks."""
    by = f"PARTITION BY {group}" if group else ""
    lead = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    return (
        f"SELECT {lead}(sum(rk) FILTER (WHERE y = 1) - p * (p + 1) / 2.0) / nullif(p * n, 0) AS auc FROM ("
        f"SELECT *, rank() OVER ({by} ORDER BY score) + (count(*) OVER "
        f"(PARTITION BY {lead}score) - 1) / 2.0 AS rk, "
        f"CAST(sum(y) OVER ({by}) AS DOUBLE) AS p, CAST(sum(1 - y) OVER ({by}) AS DOUBLE) AS n "
        f"FROM (SELECT *, has_fatality AS y FROM {table})) {tail}{', ' if group else 'GROUP BY '}p, n"
    )


def _group_metrics(cols: list[str]) -> str:
    rows = []
    for c in cols:
        rows.append(
            f"SELECT '{c}' AS group_col, g.{c} AS \"group\", g.n, {r('g.p / g.n')} AS positive_rate, "
            f"{r('g.pp / g.n')} AS pred_positive_rate, {r('a.auc')} AS auc, "
            f"{r(ratio('2 * g.tp', '(g.p + g.pp)'))} AS f1, {r(ratio('g.tp', 'g.p'))} AS recall "
            f"FROM (SELECT {c}, count(*) AS n, CAST(sum(has_fatality) AS DOUBLE) AS p, "
            f"CAST(count(*) FILTER (WHERE score >= 0.4) AS DOUBLE) AS pp, "
            f"CAST(count(*) FILTER (WHERE score >= 0.4 AND has_fatality = 1) AS DOUBLE) AS tp "
            f"FROM scored GROUP BY {c}) g LEFT JOIN ({_auc('scored', c)}) a USING ({c})"
        )
    return " UNION ALL ".join(rows)


THRESHOLD_ROWS = ", ".join(f"({t})" for t in THRESHOLDS)
BAND = (
    "CASE WHEN {0} <= -0.01 THEN 'nan' WHEN {0} <= 0.20 THEN 'Low' WHEN {0} <= 0.50 THEN 'Medium' "
    "WHEN {0} <= 0.75 THEN 'High' WHEN {0} <= 1.0 THEN 'Critical' ELSE 'nan' END"
)
CUTOFF = (
    "(SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date DESC) AS i, count(*) OVER () AS n "
    "FROM (SELECT DISTINCT date FROM entity_day)) WHERE i = greatest(1, CAST(floor(n * 0.25) AS BIGINT)))"
)
NUMERIC_FEATURES = 17
MONTHS = "CAST(date_trunc('month', l_shipdate) AS DATE)"
SEVERE_SHARE = f"CAST(count(*) FILTER (WHERE {SEVERE}) AS DOUBLE) / nullif(count(*), 0)"
DATE_ATTRS = (
    "CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name, "
    "CAST(day(date) AS INTEGER) AS day, dayname(date) AS dow, CAST(week(date) AS INTEGER) AS week"
)
ALL_DAYS = "SELECT date FROM incident UNION SELECT date FROM typed UNION SELECT date FROM measure"


def _lineage_of(table: str) -> str:
    return f"'{table}_feed' AS source_system, '{BATCH}' AS ingest_batch_id"


def _all_lineage(table: str) -> str:
    return f"{_lineage_of(table)}, '{EXTRACTED}' AS extracted_at_utc"


TYPED_HASH = hash_of(["typed_id", "entity_id", "event_type"])


STAR_COLUMNS = {
    "dim_entity": "entity_id region city kind capacity:d",
    "dim_date": "date year month month_name day dow week",
    "fact_incident": "incident_id ts entity_id severity vehicles injuries fatalities mode visibility:d precip:d temp:d "
    "source_system ingest_batch_id record_hash date",
    "fact_typed_event": "typed_id ts entity_id event_type amount source_system ingest_batch_id record_hash date",
    "fact_measure": "sensor_id ts entity_id volume speed:d source_system ingest_batch_id record_hash date",
    "fact_entity_day": "entity_id date region city kind capacity:d weather_mode daily_volume mean_speed:d p95_speed:d sensor_events "
    "total_violations violations_per_1000_volume:d accidents injuries fatalities severe severe_rate:d has_fatality "
    "low_visibility_hours rain_hours fog_hours max_precip_mm:d avg_temp_c:d",
}
RESULT_COLUMNS = {
    "scenario_summary": "scenario avg_risk_reduction:d median_risk_reduction:d max_risk_reduction:d avg_baseline_risk:d "
    "avg_scenario_risk:d baseline_high_risk_road_days high_risk_road_days_reduced high_risk_reduction_rate:d",
    "scenario_region_impact": "scenario region avg_risk_reduction:d high_risk_road_days_reduced baseline_mean_risk:d "
    "scenario_mean_risk:d median_risk_reduction:d",
    "hotspots_by_count": "entity_id region city kind accidents severe fatalities severe_rate:d",
}
RAW_COLUMNS = {
    "registry": "entity_id region city kind capacity:d", "measure": "sensor_id ts entity_id volume speed:d",
    "typed": "typed_id ts entity_id event_type amount:d", "incident": "incident_id ts entity_id vehicles injuries fatalities lighting severity",
    "context": "context_id ts region city mode visibility:d precip:d temp:d",
}


def oracle_sql() -> dict[str, str]:
    ed = rounded_columns("entity_day")
    out: dict[str, str] = {}

    # sources, layers
    out["read_source"] = f"SELECT event_id, ts, user_id, event_type, {r('value')} AS value, props FROM events"
    out["load_sources"] = sql(
        " UNION ALL ".join(
            f"SELECT '{name}_feed' AS source_system, {LINEAGE_SQL}, count(*) AS rows FROM {table}"
            for name, table in {
                "registry": "registry",
                "measure": "measure_raw",
                "typed": "typed_raw",
                "incident": "incident_raw",
                "context": "context",
            }.items()
        )
    )
    out["write_layer"] = sql(
        "SELECT date, event_type, count(*) AS rows, CAST(sum(amount) AS BIGINT) AS amount FROM typed "
        "GROUP BY date, event_type"
    )
    out["run_layers"] = sql(f"SELECT {ed} FROM entity_day")

    # lineage
    lineage_cols = f"'registry_feed' AS source_system, {LINEAGE_SQL}"
    out["add_lineage"] = sql(f"SELECT entity_id, region, city, kind, {r('capacity')} AS capacity, {lineage_cols} FROM registry")
    full = hash_of(
        ["entity_id", "region", "city", "kind", "capacity"],
        {"source_system": "registry_feed", "ingest_batch_id": BATCH, "extracted_at_utc": EXTRACTED},
    )
    out["record_hash"] = sql(
        f"SELECT entity_id, region, city, kind, {r('capacity')} AS capacity, {lineage_cols}, {full} AS record_hash FROM registry"
    )
    out["record_hash_business"] = sql(f"SELECT typed_id, {hash_of(['typed_id', 'ts', 'entity_id', 'event_type', 'amount'])} AS record_hash FROM typed_raw")
    out["normalize_lineage"] = sql(f"SELECT incident_id, {_lineage_of('incident')}, record_hash FROM incident")
    out["lineage_summary"] = sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS dataset, count(*) AS rows, {len(TABLE_COLUMNS[t])} AS columns, "
            + (
                "'' AS source_systems, '' AS batch_ids, CAST(0.0 AS DOUBLE) "
                if t == "entity_day"
                else f"'{t}_feed' AS source_systems, '{BATCH}' AS batch_ids, CAST(1.0 AS DOUBLE) "
            )
            + f"AS record_hash_coverage FROM {SOURCE_OF[t]}"
            for t in ("registry", "incident", "typed", "measure", "entity_day")
        )
    )
    gate_pairs = " UNION ALL ".join(
        f"SELECT 'quality' AS section, '{c}' AS name, CAST({c} AS VARCHAR) AS value FROM gate"
        for c in ("pass", "warn", "fail", "total", "gate_status")
    )
    rules = rules_sql(quality_rules())
    out["manifest_counts"] = sql(
        " UNION ALL ".join(
            f"SELECT 'dataset_rows' AS section, '{t}' AS name, CAST(count(*) AS VARCHAR) AS value FROM {SOURCE_OF[t]}"
            for t in ("registry", "incident", "typed", "measure", "entity_day")
        )
        + " UNION ALL "
        + gate_pairs,
        rules=rules,
        gate=GATE,
    )

    # cleaning
    out["parse_ts_lenient"] = sql(
        "SELECT event_id, CASE WHEN k % 13 <> 0 THEN date_trunc('second', ts) END AS parsed FROM ev"
    )
    out["dedupe_keys"] = (
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r('l_extendedprice')} AS l_extendedprice FROM lineitem "
        "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, "
        "l_quantity, l_extendedprice, l_discount, l_tax) = 1"
    )
    out["require_not_null"] = sql(
        f"SELECT sensor_id, {r('speed')} AS speed FROM measure_raw WHERE entity_id IS NOT NULL AND speed IS NOT NULL"
    )
    out["fill_clip_int"] = sql(
        "SELECT incident_id, CAST(least(2, greatest(0, coalesce(injuries, 0))) AS INTEGER) AS injuries, "
        "CAST(least(30, greatest(1, coalesce(fatalities, 1))) AS INTEGER) AS deaths_floor_1 FROM incident_raw"
    )
    out["fill_clip_int_fraction"] = sql(
        "SELECT typed_id, CAST(trunc(least(100.0, greatest(0.0, coalesce(amount, 0)))) AS INTEGER) AS amount FROM typed_raw"
    )
    out["fill_median_clip"] = sql(f"SELECT sensor_id, {r('speed')} AS speed FROM measure")
    out["event_day"] = "SELECT event_id, CAST(ts AS DATE) AS date FROM events"
    out["floor_hour"] = "SELECT event_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour FROM events"
    out["default_fill"] = sql(
        "SELECT entity_id, coalesce(kind, 'Unknown') AS kind, date, coalesce(accidents, 0) AS accidents, "
        "coalesce(injuries, 0) AS injuries, coalesce(fatalities, 0) AS fatalities, coalesce(severe, 0) AS severe "
        "FROM registry LEFT JOIN incident_day USING (entity_id)"
    )
    out["flag_any"] = sql(
        "SELECT incident_id, CAST(coalesce(injuries > 0, false) AS INTEGER) AS has_injury FROM incident_raw"
    )
    out["safe_ratio"] = sql(
        f"SELECT entity_id, date, {r(ratio('fatalities', 'injuries', '1000.0'))} AS deaths_per_1000_injuries "
        "FROM incident_day"
    )
    binned = BAND.format("(CAST(k AS DOUBLE) / 100.0 - 0.05)")
    out["bin_column"] = sql(f"SELECT event_id, {binned} AS band FROM ev")
    out["select_existing"] = sql("SELECT typed_id, entity_id, event_type FROM typed")
    out["clean_measure"] = sql(f"SELECT sensor_id, entity_id, ts, date, volume, {r('speed')} AS speed FROM measure")

    # filters
    out["slice_filter"] = sql(
        "SELECT entity_id, date, region, kind, daily_volume, accidents FROM entity_day WHERE region = 'ASIA' "
        "AND kind = 'HOUSEHOLD' AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"
    )
    out["slice_domain"] = sql(
        "SELECT DISTINCT 'region' AS field, region AS value FROM entity_day WHERE region IS NOT NULL UNION ALL "
        "SELECT DISTINCT 'kind', kind FROM entity_day WHERE kind IS NOT NULL UNION ALL "
        "SELECT 'min_date', CAST(min(date) AS VARCHAR) FROM entity_day UNION ALL "
        "SELECT 'max_date', CAST(max(date) AS VARCHAR) FROM entity_day"
    )
    out["min_support"] = sql(f"SELECT {HOT_COLUMNS} FROM hot WHERE accidents >= 15", hot=HOT)
    out["in_set"] = sql(f"SELECT incident_id, coalesce({SEVERE}, false) AS is_severe FROM incident_raw")

    # joins
    out["lookup_missing"] = sql(
        f"SELECT incident_id, entity_id, region, city, 'known' AS kind, {r('capacity')} AS capacity FROM full_incident"
    )
    out["context_lookup"] = sql(
        f"SELECT incident_id, region, city, mode, {r('visibility')} AS visibility, {r('precip')} AS precip, "
        f"{r('temp')} AS temp FROM full_incident"
    )
    out["integrate_entity_day"] = sql(
        "SELECT x.entity_id, x.date, x.sensor_events, t.click, i.accidents, g.city, c.weather_mode, c.rain_hours "
        "FROM exposure x LEFT JOIN typed_day t USING (entity_id, date) LEFT JOIN incident_day i USING (entity_id, date) "
        "LEFT JOIN registry g USING (entity_id) "
        "LEFT JOIN context_day c ON c.region = g.region AND c.city = g.city AND c.date = x.date"
    )
    out["dense_spine"] = sql(
        "SELECT s.entity_id, s.region, s.city, s.date, coalesce(weather_mode, 'Clear') AS weather_mode, "
        "coalesce(low_visibility_hours, 0) AS low_visibility_hours, coalesce(rain_hours, 0) AS rain_hours, "
        "coalesce(fog_hours, 0) AS fog_hours, coalesce(max_precip_mm, 0.0) AS max_precip_mm, "
        f"{r('coalesce(avg_temp_c, 28.0)')} AS avg_temp_c FROM (SELECT entity_id, region, city, CAST(d AS DATE) AS date "
        "FROM registry, (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d FROM context)) s "
        "LEFT JOIN context_day c ON c.region = s.region AND c.city = s.city AND c.date = s.date"
    )
    out["fk_violation_rate"] = (
        f"SELECT {r('avg(CAST(s_suppkey IS NULL AS DOUBLE))')} AS fk_violation_rate FROM events "
        "LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier) ON user_id = s_suppkey"
    )
    out["fk_violations"] = (
        f"SELECT event_id, ts, user_id, event_type, {r('value')} AS value FROM events "
        "WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = user_id)"
    )
    out["scalar_broadcast"] = sql(
        f"SELECT typed_id, {r('amount')} AS amount, {r('(SELECT min(amount) FROM typed_raw)')} AS lowest, "
        f"{r('(SELECT max(amount) FROM typed_raw)')} AS highest FROM typed_raw"
    )
    out["star_join"] = sql(
        "SELECT typed_id, region, kind, dayname(date) AS dow, CAST(week(date) AS INTEGER) AS week, amount "
        "FROM typed LEFT JOIN registry USING (entity_id)"
    )

    # aggregates
    exposure = f"daily_volume, {r('mean_speed')} AS mean_speed, {r('p95_speed')} AS p95_speed, sensor_events"
    out["daily_exposure"] = sql(f"SELECT entity_id, date, {exposure} FROM exposure")
    out["daily_exposure_lineitem"] = (
        f"SELECT l_suppkey, {MONTHS} AS month, {r('sum(l_quantity)')} AS daily_volume, "
        f"{r('avg(l_extendedprice)')} AS mean_speed, {r('quantile_cont(l_extendedprice, 0.95)')} AS p95_speed, "
        "count(l_orderkey) AS sensor_events FROM lineitem GROUP BY 1, 2"
    )
    typed_cols = ", ".join(GENERIC.types)
    out["typed_pivot"] = sql(f"SELECT entity_id, date, {typed_cols} FROM typed_day")
    out["wide_counts"] = out["typed_pivot"]
    out["typed_counts"] = sql(
        "SELECT entity_id, date, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS counts FROM "
        "(SELECT entity_id, date, event_type, count(typed_id) AS n FROM typed GROUP BY 1, 2, 3) GROUP BY 1, 2"
    )
    out["typed_pivot_lineitem"] = (
        f"SELECT l_suppkey, {MONTHS} AS month, "
        + ", ".join(f"count(*) FILTER (WHERE l_returnflag = '{f}') AS \"{f}\"" for f in "ANR")
        + " FROM lineitem GROUP BY 1, 2"
    )
    out["row_total"] = sql("SELECT entity_id, date, total_violations FROM typed_day")
    out["row_total_unlisted_type"] = sql("SELECT entity_id, date, count(*) AS total_violations FROM typed GROUP BY ALL")
    out["read_source_csv_numbers"] = sql("SELECT incident_id, vehicles, injuries, fatalities FROM incident_raw")
    out["daily_incident"] = sql("SELECT * FROM incident_day")
    out["daily_context"] = sql(
        "SELECT region, city, date, weather_mode, low_visibility_hours, rain_hours, fog_hours, "
        f"{r('max_precip_mm')} AS max_precip_mm, {r('avg_temp_c')} AS avg_temp_c FROM context_day"
    )
    out["build_entity_day"] = sql(f"SELECT {ed} FROM entity_day")
    out["kpi_summary"] = sql(
        "SELECT count(*) AS accidents, CAST(sum(fatalities) AS BIGINT) AS fatalities, "
        f"CAST(sum(injuries) AS BIGINT) AS injuries, count(*) FILTER (WHERE {SEVERE}) AS severe, "
        f"{r(ratio(f'count(*) FILTER (WHERE {SEVERE})', 'count(*)'))} AS severe_rate, "
        f"{r(ratio('sum(fatalities)', 'count(*)'))} AS fatality_rate FROM incident"
    )
    out["category_mix"] = sql("SELECT severity, count(*) AS count FROM incident GROUP BY severity")
    out["category_mix_keep_null"] = sql("SELECT mode, count(*) AS count FROM full_incident GROUP BY mode")
    out["severity_profile"] = sql(_profile_by(["region", "kind", "lighting", "mode"]))
    out["weekly_trend"] = sql(WEEKLY)
    out["trend_tail"] = sql(f"SELECT * FROM ({WEEKLY}) ORDER BY week DESC LIMIT 3")
    order_tail = "entity_id, region, city, kind"
    out["hotspots_by_rate"] = sql(
        f"SELECT {HOT_COLUMNS} FROM hot h WHERE accidents >= 12 ORDER BY h.severe_rate DESC, h.fatalities DESC, {order_tail} LIMIT 10",
        hot=HOT,
    )
    out["hotspots_by_count"] = sql(
        f"SELECT {HOT_COLUMNS} FROM hot h ORDER BY h.fatalities DESC, h.accidents DESC, {order_tail} LIMIT 10", hot=HOT
    )
    by_region = f"SELECT region, {SUMS} FROM full_incident WHERE region IS NOT NULL GROUP BY region"
    out["leading_group"] = sql(
        "(SELECT 'region' AS dim, region AS leading FROM by_region ORDER BY fatalities DESC, accidents DESC, region LIMIT 1) "
        "UNION ALL (SELECT 'busiest region', region FROM by_region ORDER BY accidents DESC, region LIMIT 1) "
        "UNION ALL SELECT 'none', 'n/a'",
        by_region=by_region,
    )
    out["region_day_profile"] = sql(
        f"SELECT region, count(*) AS road_days, {r('avg(severe_rate)')} AS avg_severe_rate, "
        f"{r('avg(violations_per_1000_volume)')} AS avg_violations_per_1000_volume, "
        f"{r('avg(daily_volume)')} AS avg_daily_volume FROM entity_day GROUP BY region"
    )
    out["entity_day_means"] = sql(
        f"SELECT {r('avg(has_fatality)')} AS model_positive_rate, "
        f"{r('avg(violations_per_1000_volume)')} AS avg_violation_intensity FROM entity_day"
    )
    out["source_coverage"] = sql(
        "SELECT 'registry' AS domain, count(DISTINCT entity_id) AS row_count FROM registry UNION ALL "
        "SELECT 'incident', count(DISTINCT incident_id) FROM incident UNION ALL SELECT 'entity_day', count(*) FROM entity_day"
    )
    out["band_distribution"] = sql(
        f"SELECT {BAND.format('score')} AS risk_band, count(*) AS road_days FROM scored GROUP BY 1"
    )
    out["signal_correlation"] = sql(_correlations(DIAGNOSTIC_SIGNALS, 6))
    out["signal_correlation_report"] = sql(_correlations(REPORT_SIGNALS, 5))
    out["quantile_bounds"] = sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {r(f'{c}_lo')} AS lower, {r(f'{c}_hi')} AS upper FROM bounds" for c in WEIGHTS
        )
    )
    out["fold_metrics"] = sql(
        " UNION ALL ".join(f"SELECT week, '{c}' AS metric, {c} AS value FROM weekly" for c in ("accidents", "severe", "fatalities")),
        weekly=WEEKLY,
    )

    # sort, top-k, sets
    price = r("o_totalprice")
    out["top_k"] = (
        f"SELECT o_orderkey, {price} AS o_totalprice, o_orderpriority FROM orders o "
        "ORDER BY o.o_totalprice DESC, o_orderkey LIMIT 25"
    )
    out["priority_entity_days"] = sql(
        f"SELECT entity_id, date, region, city, kind, accidents, fatalities, {r('severe_rate')} AS severe_rate, has_fatality "
        "FROM entity_day e ORDER BY has_fatality DESC, e.severe_rate DESC, fatalities DESC, accidents DESC, entity_id, date LIMIT 10"
    )
    out["top_k_per_group"] = (
        f"SELECT o_orderpriority, o_orderkey, {price} AS o_totalprice FROM orders o QUALIFY row_number() OVER "
        "(PARTITION BY o_orderpriority ORDER BY o.o_totalprice DESC, o_orderkey) <= 20"
    )
    out["best_scenario"] = sql(
        f"SELECT scenario, {r('avg_risk_reduction')} AS avg_risk_reduction, high_risk_road_days_reduced FROM summary s "
        "ORDER BY s.avg_risk_reduction DESC, high_risk_road_days_reduced DESC, scenario LIMIT 1"
    )
    out["union_all"] = sql(
        "SELECT 'incident' AS source, incident_id AS id, ts FROM incident UNION ALL "
        "SELECT 'typed', typed_id, ts FROM typed UNION ALL SELECT 'measure', sensor_id, ts FROM measure"
    )
    out["distinct_days"] = sql(ALL_DAYS)

    # quality
    out["required_columns"] = sql(
        "SELECT 'present' AS name, 'PASS' AS status, 'OK' AS notes, count(*) AS rows FROM incident UNION ALL "
        "SELECT 'absent', 'FAIL', 'missing: weight', count(*) FROM incident"
    )
    out["lineage_columns"] = sql(
        "SELECT 'present' AS name, 'PASS' AS status, 'OK' AS notes, count(*) AS hashed_rows FROM incident UNION ALL "
        "SELECT 'absent', 'FAIL', 'missing: record_hash', count(*) FROM incident"
    )
    out["duplicate_key_rate"] = (
        f"SELECT {r('CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS DOUBLE) / count(*)')} "
        "AS duplicate_key_rate FROM lineitem"
    )
    metrics = {
        "invalid_value_rate": ("full_incident", _avg(_in("kind", KINDS))),
        "negative_rate": ("customer", _avg("c_acctbal < 0")),
        "parse_fail_rate": ("ev", _avg("k % 13 = 0")),
        "null_rate": ("measure_raw", _avg("speed IS NULL")),
        "future_rate": ("incident", _avg("ts > TIMESTAMP '2024-01-20 12:00:00'")),
        "recency_days": ("incident", RECENCY),
        "out_of_range_rate": ("entity_day", _avg("p95_speed < 5 OR p95_speed > 150")),
        "unknown_context_rate": ("entity_day", _avg("weather_mode = 'Unknown'")),
        "prevalence_gap": ("entity_day", f"abs({_avg('has_fatality')} - 0.1)"),
    }
    for name, (table, metric) in metrics.items():
        out[name] = sql(f"SELECT {r(metric)} AS {name} FROM {table}")
    out["classify_rule"] = sql(
        f"SELECT city, {r('metric')} AS metric, CASE WHEN m.metric <= 0.9 THEN 'PASS' WHEN m.metric <= 0.95 THEN 'WARN' "
        f"ELSE 'FAIL' END AS status FROM (SELECT city, {_avg('mode IS NULL')} AS metric FROM full_incident GROUP BY city) m"
    )
    out["run_contract"] = sql(rules_sql(contract_rules()))
    out["run_quality"] = sql(rules)
    out["quality_gate"] = sql(GATE, rules=rules)

    # model
    part = f"CASE WHEN date < {CUTOFF} THEN 'train' ELSE 'test' END"
    out["temporal_split"] = sql(
        f"SELECT {part} AS part, count(*) AS rows, CAST(sum(has_fatality) AS BIGINT) AS positives, "
        "min(date) AS first_day, max(date) AS last_day FROM entity_day GROUP BY 1"
    )
    sizes = "SELECT has_fatality, count(*) AS n FROM entity_day GROUP BY has_fatality"
    n_test = "CAST(greatest(1, round_even(n * 0.25, 0)) AS BIGINT)"
    out["stratified_split"] = sql(
        f"SELECT 'test' AS part, has_fatality, {n_test} AS rows FROM sizes UNION ALL "
        f"SELECT 'train', has_fatality, n - {n_test} FROM sizes",
        sizes=sizes,
    )
    n_rare = "least(greatest(1, CAST(round_even(n * 0.25, 0) AS BIGINT)), n - 2)"
    out["rare_class_split"] = sql(
        f"SELECT 'test' AS part, 0 AS rare, {n_rare} AS rows FROM sizes UNION ALL "
        f"SELECT 'train', 0, n - 1 - {n_rare} FROM sizes UNION ALL SELECT 'train', 1, CAST(1 AS BIGINT)",
        sizes="SELECT count(*) AS n FROM entity_day",
    )
    levels = " + ".join(f"count(DISTINCT {c})" for c in ("region", "city", "kind", "weather_mode"))
    out["encode_features"] = sql(
        f"SELECT entity_id, date, {r('(p95_speed - avg(p95_speed) OVER ()) / stddev_pop(p95_speed) OVER ()')} AS p95_scaled, "
        f"(SELECT {NUMERIC_FEATURES} + {levels} FROM entity_day) AS width, CAST(4.0 AS DOUBLE) AS ones FROM entity_day"
    )
    out["class_weights"] = sql(
        "SELECT has_fatality AS label, count(*) AS n, "
        f"{r('sum(count(*)) OVER () / (count(*) OVER () * CAST(count(*) AS DOUBLE))')} AS weight "
        "FROM entity_day GROUP BY has_fatality"
    )
    train = f"SELECT * FROM entity_day WHERE date < {CUTOFF}"
    no_feature = {"entity_id", "date", "has_fatality", "fatalities", "injuries", "accidents", "severe", "severe_rate", *LINEAGE_NAMES}
    features = [(c, t) for c, t in TABLE_COLUMNS["entity_day"] if c not in no_feature]
    named = [f"SELECT '{c}' AS feature" if t != "string" else f"SELECT DISTINCT '{c}_' || {c} FROM train" for c, t in features]
    every = " UNION ALL ".join([*named, "SELECT '(intercept)'"])
    zero = "CAST(0.0 AS DOUBLE)"
    out["train_risk_model"] = sql(f"SELECT feature, {zero} AS gradient FROM ({every})", train=train)
    out["top_features"] = sql(
        f"SELECT CAST(v AS BIGINT) AS place, true AS same FROM range(1, 16) x(v), (SELECT count(*) - 1 AS n FROM ({every})) WHERE v <= n",
        train=train,
    )
    for name in ("score_risk", "save_model"):
        out[name] = sql(f"SELECT entity_id, date, {zero} AS off FROM entity_day WHERE date >= {CUTOFF}")
    out["load_or_fit"] = sql(
        'SELECT c AS "case", f AS fitted, (SELECT count(*) FROM train) AS rows FROM (VALUES (\'absent\', true), (\'stored\', false), '
        "('other columns', true), ('stored again', false), ('damaged', true)) AS x(c, f)",
        train=train,
    )
    out["choose_threshold"] = sql(
        f"SELECT {r('threshold')} AS threshold, {r('f1')} AS f1 FROM (SELECT t.threshold, "
        + ratio("2 * count(*) FILTER (WHERE score >= t.threshold AND has_fatality = 1)", "(count(*) FILTER (WHERE score >= t.threshold) + count(*) FILTER (WHERE has_fatality = 1))")
        + f" AS f1 FROM scored, (SELECT CAST(v AS DOUBLE) AS threshold FROM (VALUES {THRESHOLD_ROWS}) AS x(v)) t "
        "GROUP BY t.threshold) q ORDER BY q.f1 DESC, q.threshold LIMIT 1"
    )
    hit, both = "count(*) FILTER (WHERE score >= 0.4)", "count(*) FILTER (WHERE score >= 0.4 AND has_fatality = 1)"
    pos = "sum(has_fatality)"
    out["classification_metrics"] = sql(
        f"SELECT count(*) AS rows, {r(ratio(pos, 'count(*)'))} AS positive_rate, "
        f"{r(ratio(f'2 * {both}', f'({pos} + {hit})'))} AS f1, {r(ratio(both, hit))} AS precision, "
        f"{r(ratio(both, pos))} AS recall FROM scored"
    )
    out["auc"] = sql(f"SELECT {r('auc')} AS auc FROM ({_auc('scored')})")
    out["auc_by_region"] = sql(f"SELECT region, {r('auc')} AS auc FROM ({_auc('scored', 'region')})")
    out["group_metrics"] = sql(_group_metrics(["region", "kind"]))
    out["holdout_scores"] = sql(
        f"SELECT entity_id, date, region, city, kind, has_fatality, {r('score')} AS predicted_risk, "
        f"CAST(score >= 0.4 AS INTEGER) AS predicted_label, {BAND.format('score')} AS risk_band "
        f"FROM scored WHERE date >= {CUTOFF}"
    )

    # scenarios
    out["scenario_packages"] = sql(
        "SELECT entity_id, date, scenario, "
        + ", ".join(f"{r(c)} AS {c}" for c in ("mean_speed", "p95_speed", "total_violations", "rain_hours"))
        + " FROM changed_day"
    )
    out["normalize_bounds"] = sql(
        f"SELECT entity_id, date, {r(_scaled('p95_speed', 'mid', 'top'))} AS scaled FROM entity_day, "
        "(SELECT avg(p95_speed) AS mid, max(p95_speed) AS top FROM entity_day)"
    )
    out["pressure_score"] = sql(f"SELECT entity_id, date, {r(PRESSURE)} AS pressure FROM entity_day, bounds")
    out["blended_risk"] = sql(f"SELECT entity_id, date, {r('baseline_risk')} AS risk FROM base_risk")
    out["high_risk_threshold"] = sql(
        f"SELECT {r('greatest(0.5, quantile_cont(score, 0.85))')} AS threshold FROM scored"
    )
    pair = ", ".join(f"{r(c)} AS {c}" for c in ("baseline_risk", "scenario_risk", "risk_delta"))
    keys = "entity_id, date, region, city, kind, scenario"
    out["scenario_scores"] = sql(
        f"SELECT {keys}, {pair}, baseline_high_risk, moved_below_threshold FROM scores"
    )
    means = ("avg_risk_reduction", "median_risk_reduction", "max_risk_reduction", "avg_baseline_risk", "avg_scenario_risk")
    out["scenario_summary"] = sql(
        "SELECT scenario, "
        + ", ".join(f"{r(c)} AS {c}" for c in (*means, "high_risk_reduction_rate"))
        + ", baseline_high_risk_road_days, high_risk_road_days_reduced FROM summary"
    )
    nine = ", ".join(f"{r(r(c, 9))} AS {c}" for c in ("baseline_risk", "scenario_risk", "risk_delta"))
    out["scenario_opportunities"] = sql(
        f"SELECT {keys}, {nine}, moved_below_threshold FROM (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY "
        f"{r('risk_delta', 9)} DESC, {r('baseline_risk', 9)} DESC, entity_id, date) AS place FROM scores "
        "WHERE scenario <> 'Baseline') WHERE place <= 20"
    )
    out["scenario_region_impact"] = sql(
        f"SELECT scenario, region, {r('avg(risk_delta)')} AS avg_risk_reduction, "
        f"{r('quantile_cont(risk_delta, 0.5)')} AS median_risk_reduction, "
        "CAST(sum(moved_below_threshold) AS BIGINT) AS high_risk_road_days_reduced, "
        f"{r('avg(baseline_risk)')} AS baseline_mean_risk, {r('avg(scenario_risk)')} AS scenario_mean_risk "
        "FROM scores WHERE scenario <> 'Baseline' GROUP BY scenario, region"
    )

    # star schema, measures
    out["dim_entity"] = sql(f"SELECT entity_id, region, city, kind, {r('capacity')} AS capacity FROM registry")
    out["dim_date"] = sql(f"SELECT date, {DATE_ATTRS} FROM ({ALL_DAYS})")
    out["fact_incident"] = sql(
        "SELECT incident_id, ts, entity_id, severity, vehicles, injuries, fatalities, mode, "
        f"{r('visibility')} AS visibility, {r('precip')} AS precip, {r('temp')} AS temp, {_lineage_of('incident')}, "
        "record_hash, date FROM full_incident"
    )
    out["fact_typed_event"] = sql(
        f"SELECT typed_id, ts, entity_id, event_type, amount, {_lineage_of('typed')}, {TYPED_HASH} AS record_hash, date FROM typed"
    )
    measure_hash = hash_of(["sensor_id", "entity_id", "volume"])
    out["fact_measure"] = sql(
        f"SELECT m.sensor_id, m.ts, m.entity_id, m.volume, {r('m.speed')} AS speed, {_lineage_of('measure')}, h.record_hash, "
        f"m.date FROM measure m JOIN (SELECT sensor_id, {measure_hash} AS record_hash FROM measure_raw) h USING (sensor_id)"
    )
    out["fact_entity_day"] = sql(f"SELECT {rounded_columns('entity_day', GENERIC.types)} FROM entity_day")
    out["export_star"] = " UNION ALL ".join(digest_sql(name, out[name], cols) for name, cols in STAR_COLUMNS.items())
    out["measures_core"] = sql(
        "SELECT region, count(*) AS accidents, CAST(sum(fatalities) AS BIGINT) AS fatalities, "
        f"CAST(sum(injuries) AS BIGINT) AS injuries, count(*) FILTER (WHERE {SEVERE}) AS severe_accidents, "
        f"{r(SEVERE_SHARE)} AS severe_rate FROM full_incident GROUP BY region"
    )
    violations = "count(*) AS violations, CAST(sum(amount) AS BIGINT) AS total_fines"
    day_rates = f"{r('avg(has_fatality)')} AS fatality_flag_rate, {r('avg(severe_rate)')} AS entity_day_severe_rate"
    out["measures_exposure"] = sql(
        f"SELECT * FROM (SELECT date, {violations} FROM typed GROUP BY date) "
        f"FULL JOIN (SELECT date, {r('avg(speed)')} AS avg_sensor_speed FROM measure GROUP BY date) USING (date) "
        f"FULL JOIN (SELECT date, {day_rates} FROM entity_day GROUP BY date) USING (date)"
    )
    out["measures_exposure_total"] = sql(
        f"SELECT * FROM (SELECT {violations} FROM typed), (SELECT {r('avg(speed)')} AS avg_sensor_speed FROM measure), "
        f"(SELECT {day_rates} FROM entity_day)"
    )
    out["measures_extended"] = sql(
        "SELECT * FROM (SELECT date, count(*) FILTER (WHERE event_type = 'click') AS click_events, "
        "count(*) FILTER (WHERE event_type = 'view') AS view_events FROM typed GROUP BY date) "
        f"FULL JOIN (SELECT date, {r(ratio('sum(fatalities)', 'count(*)'))} AS fatal_rate FROM incident GROUP BY date) USING (date) "
        "FULL JOIN (SELECT date, CAST(sum(volume) AS BIGINT) AS total_volume FROM measure GROUP BY date) USING (date) "
        f"FULL JOIN (SELECT date, {r('avg(violations_per_1000_volume)')} AS avg_violations_per_1000, "
        "count(*) FILTER (WHERE severe >= 1) AS high_risk_entity_days FROM entity_day GROUP BY date) USING (date)"
    )

    # profiling
    out["data_dictionary"] = sql(dictionary_sql(list(TABLE_COLUMNS)))
    with_lineage = {
        "g_registry": f"SELECT *, {_all_lineage('registry')}, {hash_of(['entity_id', 'region', 'city', 'kind'])} AS record_hash FROM registry",
        "g_incident": f"SELECT *, {_all_lineage('incident')} FROM full_incident",
        "g_typed": f"SELECT *, {_all_lineage('typed')}, {TYPED_HASH} AS record_hash FROM typed",
        "g_measure": f"SELECT m.*, {_all_lineage('measure')}, h.record_hash FROM measure m "
        f"JOIN (SELECT sensor_id, {measure_hash} AS record_hash FROM measure_raw) h USING (sensor_id)",
        "g_entity_day": "SELECT * FROM entity_day",
    }
    out["column_samples"] = sql(" UNION ALL ".join(samples_sql(name, f"g_{name}") for name in TABLE_COLUMNS), **with_lineage)
    patterns = "|".join(profile.INTERNAL_PATTERNS)
    out["sensitivity_class"] = sql(
        'SELECT dataset, "column", null_rate, CASE WHEN regexp_matches(lower("column"), '
        f"'{patterns}') THEN 'INTERNAL' ELSE 'PUBLIC' END AS sensitivity FROM listed",
        listed=dictionary_sql(list(TABLE_COLUMNS)),
    )
    out["write_results"] = " UNION ALL ".join(
        digest_sql(name.removesuffix("_by_count"), out[name], cols) for name, cols in RESULT_COLUMNS.items()
    )
    raw = {name: name if name in ("registry", "context") else f"{name}_raw" for name in RAW_COLUMNS}
    out["load_sources_content"] = " UNION ALL ".join(
        digest_sql(name, sql(f"SELECT * FROM {raw[name]}"), cols) for name, cols in RAW_COLUMNS.items()
    )
    return out
