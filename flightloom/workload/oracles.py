"""The registered queries as SQL for DuckDB, over the same tables."""

from __future__ import annotations

from flightloom.operators.gold import KEYS, METRIC_GROUPS, metric_names
from flightloom.schemas import GOLD, GOLD_METRICS, SIGNAL_COLUMNS, SILVER, STATUS, TEXT_COLUMNS
from flightloom.workload.fixtures import EARLIER, FAULTS, NOW, OTHERS, RATES, RECORDED, TELEMETRY

SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def _typed(expression: str, kind: str) -> str:
    return f"CAST({expression} AS {SQL_TYPES[kind]})"


def _six(expression: str) -> str:
    """Six decimals, with one zero."""
    value = f"round(CAST({expression} AS DOUBLE), 6)"
    return f"CASE WHEN {value} = 0 THEN 0.0::DOUBLE ELSE {value} END"


def _with(*parts: tuple[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts) + "\n" + body


# -- inputs ----------------------------------------------------------------------------------

TELEMETRY_CTE = (
    "telemetry",
    "SELECT "
    + ", ".join(
        f"{_typed(TELEMETRY[f.name], f.dataType.simpleString())} AS {f.name}"
        for f in SILVER.fields
    )
    + " FROM lineitem",
)

LISTING_CTE = (
    "listing",
    """
    SELECT concat('in/', CAST(page_id AS VARCHAR), '.h5') AS relative_path,
           url AS file_url,
           TIMESTAMP '2024-01-01 00:00:00' AS last_modified,
           md5(url) AS etag,
           CAST(CASE WHEN page_id % 17 = 0 THEN 0 ELSE length(html) END AS BIGINT) AS size
    FROM pages
    """,
)

VIEW_CTE = (
    "dir_view",
    """
    SELECT relative_path, file_url, last_modified, etag,
           md5(relative_path) AS file_hash_relpath,
           md5(file_url) AS file_hash_fileurl,
           size, 'prepared' AS target_stage, 'recordings' AS source_stage,
           list_extract(string_split(relative_path, '/'), -1) AS file_name
    FROM listing WHERE size > 0
    """,
)

_FILE_NAME = (
    "concat(CASE WHEN page_id % 4 = 0 THEN 'pyspark_' ELSE 'flight_' END, "
    "CAST(page_id AS VARCHAR), '.h5')"
)

LOG_CTE = (
    "status_log",
    f"""
    SELECT concat('in/', CAST(page_id AS VARCHAR), '.h5') AS file_relative_path,
           {_FILE_NAME} AS input_file_name,
           md5(concat('in/', CAST(page_id AS VARCHAR), '.h5')) AS input_file_hash_rel,
           concat('out/', CAST(page_id AS VARCHAR), '.parquet') AS output_file_path,
           CASE WHEN page_id % 5 = 0 THEN 'Failed' ELSE 'Completed' END AS status,
           CASE WHEN page_id % 5 = 0 THEN 'error' ELSE 'ok' END AS status_msg,
           TIMESTAMP '2024-01-01 00:00:00' + to_minutes(page_id) AS file_processed_dt
    FROM pages
    """,
)

UPDATES_CTE = (
    "updates",
    f"""
    SELECT {_FILE_NAME} AS input_file_name, 'Completed' AS status,
           concat('retried ', CAST(page_id AS VARCHAR)) AS status_msg,
           TIMESTAMP '{NOW}' AS file_processed_dt
    FROM (SELECT CASE WHEN page_id % 10 = 0 THEN page_id + 1000000 ELSE page_id END AS page_id
          FROM pages WHERE page_id % 5 = 0)
    """,
)

MERGED_CTE = (
    "merged",
    """
    SELECT t.file_relative_path, t.input_file_name, t.input_file_hash_rel, t.output_file_path,
           CASE WHEN s.input_file_name IS NULL THEN t.status ELSE s.status END AS status,
           CASE WHEN s.input_file_name IS NULL THEN t.status_msg ELSE s.status_msg END
               AS status_msg,
           CASE WHEN s.input_file_name IS NULL THEN t.file_processed_dt
                ELSE s.file_processed_dt END AS file_processed_dt
    FROM status_log t LEFT JOIN updates s ON t.input_file_name = s.input_file_name
    """,
)


def _branch(param: str, rate: str, number: str, text: str) -> str:
    """The samples of one signal, as sound flights and as the flight with a fault in it records them."""
    branch = f"""
    SELECT CAST(l_suppkey AS INTEGER) AS flight_id, '{param}' AS param,
           row_number() OVER (PARTITION BY l_suppkey
                              ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS idx,
           CAST({number} AS DOUBLE) AS num_value, CAST({text} AS VARCHAR) AS str_value
    FROM lineitem WHERE {RATES[rate]}
    """
    for rest, (faulty, idx, value, words, which) in FAULTS.items():
        if faulty == param:
            branch = f"""
            SELECT * FROM ({branch}) WHERE flight_id % 40 <> {rest}
            UNION ALL
            SELECT flight_id, param, CAST({idx} AS BIGINT), CAST({value} AS DOUBLE), CAST({words} AS VARCHAR)
            FROM ({branch}) WHERE flight_id % 40 = {rest} AND {which}
            """
    return branch


def _signals(recorded: dict[str, tuple[str, str, str]]) -> tuple[str, str]:
    return "signals", " UNION ALL ".join(_branch(param, *what) for param, what in recorded.items())


SIGNALS_CTE = _signals(RECORDED)
OTHER_SIGNALS_CTE = _signals(RECORDED | OTHERS)

_NUMERIC = ", ".join(f"'{param}'" for param, column in SIGNAL_COLUMNS.items() if column not in TEXT_COLUMNS)
_CLEAN = "regexp_replace(str_value, '[^A-Z0-9-]', '', 'g')"

PROFILE_CTES = (
    SIGNALS_CTE,
    (
        "lengths",
        f"""
        SELECT flight_id, param, count(idx) AS n, count(num_value) AS n_num, count(str_value) AS n_text,
               count(DISTINCT idx) AS n_distinct, max(idx) AS last_idx, max({_CLEAN}) AS text_value
        FROM signals GROUP BY flight_id, param
        """,
    ),
    (
        "based",
        """
        SELECT l.*, b.n AS base_len, CAST(l.n AS DOUBLE) / CAST(b.n AS DOUBLE) AS ratio
        FROM lengths l LEFT JOIN lengths b
          ON l.flight_id = b.flight_id AND b.param = 'FlightPhase'
        """,
    ),
    (
        "kinds",
        """
        SELECT *,
               CASE WHEN n_text > 0 THEN 'text' WHEN n_num = 0 AND n > 0 THEN 'invalid'
                    WHEN ratio > 1 THEN 'down'
                    WHEN ratio > 0 AND ratio < 1 THEN 'up' ELSE 'pass' END AS signal_kind
        FROM based
        """,
    ),
    (
        "profile",
        """
        SELECT *,
               CASE WHEN signal_kind = 'down' THEN CAST(floor(ratio) AS BIGINT) ELSE 1 END AS f,
               CASE WHEN signal_kind = 'up' THEN CAST(round_even(1 / ratio, 0) AS BIGINT)
                    ELSE 1 END AS rep
        FROM kinds
        """,
    ),
    (
        "checked",
        """
        SELECT *,
               CASE WHEN signal_kind = 'text' THEN base_len
                    WHEN signal_kind = 'up' THEN least(n * rep, base_len)
                    ELSE least(n // f, base_len) END AS out_len
        FROM profile
        """,
    ),
    (
        "rejects",
        f"""
        SELECT flight_id, min(fault) AS fault FROM (
            SELECT flight_id,
                   CASE WHEN base_len IS NULL THEN 'no samples of FlightPhase'
                        WHEN n = 0 THEN concat('no samples of ', param)
                        WHEN n_distinct <> n THEN concat('repeated samples in ', param)
                        WHEN last_idx <> n - 1 THEN concat('gaps in ', param)
                        WHEN signal_kind = 'invalid' THEN concat('neither numbers nor text in ', param)
                        WHEN signal_kind = 'text' AND param IN ({_NUMERIC}) AND TRY_CAST(text_value AS DOUBLE) IS NULL
                             THEN concat('text in numeric signal ', param)
                        WHEN out_len <> base_len
                             THEN concat(param, ' fills ', CAST(out_len AS VARCHAR), ' of ',
                                         CAST(base_len AS VARCHAR), ' rows') END AS fault
            FROM checked)
        WHERE fault IS NOT NULL GROUP BY flight_id
        """,
    ),
)

SAMPLES_CTES = (
    (
        "sized",
        """
        SELECT s.flight_id, s.param, s.idx, s.num_value, p.base_len, p.f, p.rep, p.signal_kind
        FROM signals s JOIN profile p ON s.flight_id = p.flight_id AND s.param = p.param
        """,
    ),
    (
        "down",
        """
        SELECT flight_id, param, idx // f AS row_idx, avg(num_value) AS value
        FROM sized WHERE signal_kind = 'down' AND idx < f * base_len
        GROUP BY flight_id, param, idx // f
        """,
    ),
    (
        "up",
        """
        SELECT flight_id, param, idx * rep + j AS row_idx, value FROM (
            SELECT flight_id, param, idx, rep, base_len, num_value AS value,
                   unnest(range(rep)) AS j
            FROM sized WHERE signal_kind = 'up')
        WHERE idx * rep + j < base_len
        """,
    ),
    (
        "pass",
        """
        SELECT flight_id, param, idx AS row_idx, num_value AS value
        FROM sized WHERE signal_kind = 'pass' AND idx < base_len
        """,
    ),
)


def _numbered(prefix: str, modulus: int) -> str:
    return f"concat('{prefix}', CAST(s_suppkey % {modulus} AS VARCHAR))"


_EPOCH = "CASE WHEN s_suppkey % 10 = 9 THEN 0 ELSE 1704067200 + s_suppkey * 3600 END"

FLIGHTS_CTES = (
    (
        "flights",
        f"""
        SELECT CAST(s_suppkey AS INTEGER) AS flight_id, s_name AS file_name,
               {_numbered("FL-", 50)} AS flight_number,
               {_numbered("TL-", 10)} AS aircraft_tail,
               {_numbered("TYPE-", 3)} AS aircraft_type,
               {_numbered("AP", 5)} AS departure_airport,
               {_numbered("AP", 7)} AS arrival_airport,
               make_timestamp(({_EPOCH}) * 1000000) AS flight_departure_utc,
               CAST(({_EPOCH}) * 1000000 AS BIGINT) AS flight_departure_dttm,
               CAST(s_suppkey * 10 AS INTEGER) AS qar_recorded_data_seconds
        FROM supplier
        """,
    ),
    (
        "named",
        """
        SELECT *, concat(aircraft_tail, '_', flight_number, '_', departure_airport, '_',
                         arrival_airport, '_', strftime(flight_departure_utc, '%Y%m%d%H%M%S'),
                         '.parquet') AS output_name
        FROM flights
        """,
    ),
    (
        "repeated",
        "SELECT * FROM named UNION ALL SELECT * FROM named WHERE flight_id % 25 = 0",
    ),
)

_COLUMNS = {column: param for param, column in SIGNAL_COLUMNS.items()}


def _wide_column(name: str, kind: str) -> str:
    if name in _COLUMNS:
        source = "t" if name in TEXT_COLUMNS else "r"
        return _typed(f"{source}.{_COLUMNS[name]}", kind) + f" AS {name}"
    return _typed({"flight_id": "r.flight_id"}.get(name, f"f.{name}"), kind) + f" AS {name}"


def _pivoted(value: str, text: bool) -> str:
    return ", ".join(
        f"max(CASE WHEN param = '{param}' THEN {value} END) AS {param}"
        for param, column in SIGNAL_COLUMNS.items()
        if (column in TEXT_COLUMNS) == text
    )


WIDE_CTE = (
    "wide",
    "SELECT r.row_idx AS idx, "
    + ", ".join(_wide_column(x.name, x.dataType.simpleString()) for x in SILVER.fields)
    + f"""
    FROM (SELECT flight_id, row_idx, {_pivoted("value", text=False)}
          FROM (SELECT flight_id, param, row_idx, value FROM down
                UNION ALL SELECT flight_id, param, row_idx, value FROM up
                UNION ALL SELECT flight_id, param, row_idx, value FROM pass)
          WHERE flight_id NOT IN (SELECT flight_id FROM rejects)
          GROUP BY flight_id, row_idx) r
    JOIN flights f ON f.flight_id = r.flight_id
    LEFT JOIN (SELECT flight_id, {_pivoted("text_value", text=True)}
               FROM profile WHERE signal_kind = 'text' GROUP BY flight_id) t
      ON t.flight_id = r.flight_id
    """,
)
WIDE_CTES = (*PROFILE_CTES, *SAMPLES_CTES, *FLIGHTS_CTES, WIDE_CTE)


def _silver_select(with_idx: bool) -> str:
    columns = ["idx"] if with_idx else []
    for f in SILVER.fields:
        is_double = f.dataType.simpleString() == "double"
        columns.append(f"{_six(f.name)} AS {f.name}" if is_double else f.name)
    return "SELECT " + ", ".join(columns) + " FROM wide"


# -- Gold ------------------------------------------------------------------------------------

_N1 = "abs(engine_n1_1 - engine_n1_2)"
_HEADWIND = "wind_speed * cos(radians(wind_direction - heading_true))"


def _events(condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)"


def _rms(column: str) -> str:
    return f"sqrt(avg({column} * {column}))"


_DURATION = "count(*) / CAST(4.0 AS DOUBLE)"
GOLD_SQL = {
    "duration_sec": _DURATION,
    "fuel_mean_flow_kg_hr": "avg(fuel_flow_total)",
    "fuel_total_kg": f"avg(fuel_flow_total) * (({_DURATION}) / CAST(3600.0 AS DOUBLE))",
    "n1_mean_eng1_pct": "avg(engine_n1_1)",
    "n1_mean_eng2_pct": "avg(engine_n1_2)",
    "n1_max_imbalance_pct": f"max({_N1})",
    "n1_mean_imbalance_pct": f"avg({_N1})",
    "vrtg_mean_g": "avg(vertical_acceleration)",
    "vrtg_max_g": "max(vertical_acceleration)",
    "vrtg_min_g": "min(vertical_acceleration)",
    "vrtg_std_g": "stddev_samp(vertical_acceleration)",
    "vrtg_exceedances_1p5g": _events("abs(vertical_acceleration) > 1.5"),
    "ias_min_kts": "min(airspeed)",
    "ias_mean_kts": "avg(airspeed)",
    "ias_max_kts": "max(airspeed)",
    "ias_std_kts": "stddev_samp(airspeed)",
    "alt_min_ft": "min(baro_altitude)",
    "alt_mean_ft": "avg(baro_altitude)",
    "alt_max_ft": "max(baro_altitude)",
    "alt_range_ft": "max(baro_altitude) - min(baro_altitude)",
    "wind_mean_spd_kts": "avg(wind_speed)",
    "wind_mean_hw_comp_kts": f"avg({_HEADWIND})",
    "wind_max_headwind_kts": f"max({_HEADWIND})",
    "wind_max_tailwind_kts": f"min({_HEADWIND})",
    "roll_max_deg": "max(abs(roll_angle))",
    "roll_rms_deg": _rms("roll_angle"),
    "roll_exceed_30deg": _events("abs(roll_angle) > 30"),
    "pitch_rate_mean_dps": "avg(pitch_rate)",
    "pitch_rate_rms_dps": _rms("pitch_rate"),
    "pitch_rate_peak_dps": "max(abs(pitch_rate))",
    "pitch_rate_std_dps": "stddev_samp(pitch_rate)",
    "aoa_mean_deg": "avg(attack_angle)",
    "aoa_max_deg": "max(attack_angle)",
    "aoa_std_deg": "stddev_samp(attack_angle)",
    "aoa_events_gt10deg": _events("attack_angle > 10"),
    "latg_mean_g": "avg(lateral_acceleration)",
    "latg_rms_g": _rms("lateral_acceleration"),
    "latg_peak_g": "max(abs(lateral_acceleration))",
    "latg_events_gt0p1g": _events("abs(lateral_acceleration) > 0.1"),
}


def _group_sql(group: str) -> str:
    columns = []
    for name in metric_names(group):
        counter = GOLD_SQL[name].startswith("sum(")
        value = _typed(GOLD_SQL[name], "bigint") if counter else _six(GOLD_SQL[name])
        columns.append(f"{value} AS {name}")
    keys = ", ".join(KEYS)
    return _with(
        TELEMETRY_CTE,
        body=f"SELECT {keys}, {', '.join(columns)} FROM telemetry GROUP BY {keys}",
    )


def _gold_body(source: str, stamp: str) -> str:
    """``stamp`` is a timestamp expression over the flight id."""
    types = {f.name: f.dataType.simpleString() for f in GOLD.fields}
    metrics = ", ".join(
        f"{_six(GOLD_SQL[m]) if types[m] == 'double' else _typed(GOLD_SQL[m], types[m])} AS {m}"
        for m in GOLD_METRICS
    )
    keys = ", ".join(KEYS)
    return (
        f"SELECT {keys}, {metrics}, {stamp} AS record_created_at, {stamp} AS record_updated_at "
        f"FROM {source} GROUP BY {keys}"
    )


_NOW = f"TIMESTAMP '{NOW}'"
_STAMP = f"CASE WHEN flight_id % 3 <> 0 THEN TIMESTAMP '{EARLIER}' ELSE {_NOW} END"
_NEW = "(SELECT * FROM telemetry WHERE flight_id % 3 = 0)"

_BRONZE_SELECT = f"""
    SELECT flight_id, file_name, flight_number, aircraft_tail, aircraft_type, departure_airport,
           arrival_airport, CAST(flight_departure_utc AS DATE) AS flight_date,
           flight_departure_utc, qar_recorded_data_seconds,
           {_NOW} AS created_date, {_NOW} AS updated_date
    FROM flights
"""

OUTCOMES_CTE = (
    "outcomes",
    """
    SELECT n.flight_id, n.file_name, n.output_name, c.base_len, c.n_signals, r.fault
    FROM named n
    JOIN (SELECT flight_id, max(base_len) AS base_len, count(*) AS n_signals
          FROM checked GROUP BY flight_id) c ON c.flight_id = n.flight_id
    LEFT JOIN rejects r ON r.flight_id = n.flight_id
    """,
)

_STATUS_ROWS = f"""
    SELECT concat('in/', CAST(flight_id AS VARCHAR), '.h5') AS file_relative_path,
           concat(CAST(flight_id AS VARCHAR), '.h5') AS input_file_name,
           md5(concat('in/', CAST(flight_id AS VARCHAR), '.h5')) AS input_file_hash_rel,
           CASE WHEN fault IS NULL THEN concat('output-files/flight=', CAST(flight_id AS VARCHAR)) ELSE '' END
               AS output_file_path,
           CASE WHEN fault IS NULL THEN 'Completed' ELSE 'Failed' END AS status,
           CASE WHEN fault IS NULL
                THEN concat('Processed ', CAST(base_len AS VARCHAR),
                            ' rows | output-files/flight=', CAST(flight_id AS VARCHAR))
                ELSE substring(fault, 1, 500) END AS status_msg,
           {_NOW} AS file_processed_dt
    FROM outcomes
"""

_LATEST = """
    SELECT input_file_name, status, file_processed_dt FROM status_log
    ORDER BY file_processed_dt DESC, input_file_name
"""


def _long(source: str, where: str = "TRUE") -> str:
    return (
        f"SELECT flight_id, param, row_idx, {_six('value')} AS value FROM {source} WHERE {where}"
    )


_RENAMES = " ".join(f"WHEN '{param}' THEN '{column}'" for param, column in SIGNAL_COLUMNS.items())
_OTHERS = f"""
    SELECT flight_id, row_idx AS idx, param AS name, {_six('value')} AS num_value, CAST(NULL AS VARCHAR) AS str_value
    FROM (SELECT flight_id, param, row_idx, value FROM down UNION ALL SELECT flight_id, param, row_idx, value FROM up
          UNION ALL SELECT flight_id, param, row_idx, value FROM pass)
    WHERE param IN ('OilTemp', 'Flap') AND flight_id NOT IN (SELECT flight_id FROM rejects)
    UNION ALL
    SELECT flight_id, unnest(range(base_len)), param, CAST(NULL AS DOUBLE), text_value
    FROM profile WHERE param = 'Squawk' AND flight_id NOT IN (SELECT flight_id FROM rejects)
"""


def sql() -> dict[str, str]:
    log = ", ".join(STATUS.names)
    recorded = _with(*PROFILE_CTES, *FLIGHTS_CTES, OUTCOMES_CTE, body="")
    found = {
        "scan_all": _with(TELEMETRY_CTE, body="SELECT * FROM telemetry"),
        "scan_sql": _with(LOG_CTE, body=_LATEST),
        "load_by_name": """
            SELECT l_orderkey AS "L_OrderKey", l_linenumber AS "L_LINENUMBER",
                   l_quantity AS "l_Quantity", l_returnflag AS "L_ReturnFlag",
                   l_shipdate AS "l_shipDate", CAST(NULL AS DOUBLE) AS l_not_recorded
            FROM lineitem
        """,
        "other_signals": _with(OTHER_SIGNALS_CTE, *PROFILE_CTES[1:], *SAMPLES_CTES, body=_OTHERS),
        "silver_write": _with(*WIDE_CTES, body=_silver_select(with_idx=False)),
        "gold_append": _with(TELEMETRY_CTE, body=_gold_body("telemetry", _STAMP)),
        "status_append": _with(
            *PROFILE_CTES,
            *FLIGHTS_CTES,
            OUTCOMES_CTE,
            LOG_CTE,
            body=f"SELECT {log} FROM status_log UNION ALL {_STATUS_ROWS}",
        ),
        "dir_view": _with(LISTING_CTE, VIEW_CTE, body="SELECT * FROM dir_view"),
        "filter_status": _with(
            LOG_CTE, body="SELECT * FROM status_log WHERE status = 'Completed'"
        ),
        "filter_like": _with(
            LOG_CTE, body="SELECT * FROM status_log WHERE input_file_name LIKE 'pyspark_%'"
        ),
        "assign_ids": _with(
            LISTING_CTE,
            VIEW_CTE,
            (
                "assigned",
                """
                SELECT md5(concat('in/', CAST(page_id AS VARCHAR), '.h5')) AS hash,
                       CAST(page_id AS INTEGER) AS flight_id
                FROM pages WHERE page_id % 3 = 0
                """,
            ),
            body="""
            SELECT v.file_hash_relpath AS input_file_hash_rel, a.flight_id
            FROM dir_view v JOIN assigned a ON a.hash = v.file_hash_relpath
            UNION ALL
            SELECT v.file_hash_relpath,
                   CAST((SELECT max(flight_id) FROM assigned)
                        + row_number() OVER (ORDER BY v.file_hash_relpath) AS INTEGER)
            FROM dir_view v
            WHERE v.file_hash_relpath NOT IN (SELECT hash FROM assigned)
            """,
        ),
        "flight_metadata": _with(*FLIGHTS_CTES, body=_BRONZE_SELECT),
        "output_name": _with(*FLIGHTS_CTES, body="SELECT flight_id, output_name FROM named"),
        "rename_signals": _with(
            SIGNALS_CTE,
            body=f"""
            SELECT flight_id, param, CASE param {_RENAMES} ELSE param END AS column_name, idx
            FROM signals
            """,
        ),
        "clean_string": _with(
            SIGNALS_CTE,
            body=f"""
            SELECT flight_id, param, idx, {_CLEAN} AS clean_value
            FROM signals WHERE str_value IS NOT NULL
            """,
        ),
        "headwind": _with(
            TELEMETRY_CTE,
            body=f"SELECT flight_id, flight_phase, {_six(_HEADWIND)} AS headwind_kts "
            "FROM telemetry",
        ),
        "signal_profile": _with(
            *PROFILE_CTES,
            body=f"SELECT flight_id, param, n, base_len, {_six('ratio')} AS ratio, signal_kind "
            "FROM profile",
        ),
        "resample_down": _with(*PROFILE_CTES, *SAMPLES_CTES, body=_long("down")),
        "resample_up": _with(*PROFILE_CTES, *SAMPLES_CTES, body=_long("up")),
        "resample_pass": _with(*PROFILE_CTES, *SAMPLES_CTES, body=_long("pass")),
        "text_signal": _with(
            *PROFILE_CTES,
            body="SELECT flight_id, param, text_value, base_len FROM profile "
            "WHERE signal_kind = 'text'",
        ),
        "silver_wide": _with(*WIDE_CTES, body=_silver_select(with_idx=True)),
        "reject_flights": _with(*PROFILE_CTES, body="SELECT * FROM rejects"),
        "silver_counts": recorded
        + """
            SELECT flight_id, base_len AS n_rows, n_signals + 2 AS n_columns,
                   CASE WHEN fault IS NULL
                        THEN concat('SUCCESS: ', file_name, ' -> ', output_name, ' | Rows: ',
                                    CAST(base_len AS VARCHAR), ' | Params: ',
                                    CAST(n_signals + 2 AS VARCHAR))
                        ELSE concat('FAILED: ', file_name, ' | Error: ',
                                    substring(fault, 1, 500)) END AS message
            FROM outcomes
        """,
        "pending_files": _with(
            LISTING_CTE,
            VIEW_CTE,
            LOG_CTE,
            body="""
            SELECT v.relative_path, v.file_hash_relpath, v.source_stage, v.target_stage
            FROM dir_view v LEFT JOIN (
              SELECT s.* FROM status_log s JOIN pages p
                ON s.file_relative_path = concat('in/', CAST(p.page_id AS VARCHAR), '.h5')
              WHERE p.page_id % 3 = 0
            ) s ON md5(v.relative_path) = s.input_file_hash_rel
            WHERE s.file_relative_path IS NULL AND v.size > 0
            """,
        ),
        "new_flights": _with(
            TELEMETRY_CTE,
            body="SELECT DISTINCT flight_id FROM telemetry WHERE flight_id % 3 = 0",
        ),
        "incremental_rows": _with(TELEMETRY_CTE, body=f"SELECT * FROM {_NEW}"),
        "distinct_flights": _with(TELEMETRY_CTE, body="SELECT DISTINCT flight_id FROM telemetry"),
        "count_rows": "SELECT count(*) AS n_rows FROM lineitem",
        "gold_duration": _with(
            TELEMETRY_CTE,
            body="SELECT flight_id, flight_phase, count(*) / CAST(4.0 AS DOUBLE) AS duration_sec "
            "FROM telemetry GROUP BY flight_id, flight_phase",
        ),
        **{f"gold_{group}": _group_sql(group) for group in METRIC_GROUPS},
        "gold_full": _with(TELEMETRY_CTE, body=_gold_body("telemetry", _NOW)),
        "gold_readback": _with(TELEMETRY_CTE, body=_gold_body(_NEW, _NOW)),
        "gold_incremental": _with(TELEMETRY_CTE, body=_gold_body("telemetry", _STAMP)),
        "merge_update": _with(LOG_CTE, UPDATES_CTE, MERGED_CTE, body="SELECT * FROM merged"),
        "delete_where": _with(
            LOG_CTE, body="SELECT * FROM status_log WHERE input_file_name NOT LIKE 'pyspark_%'"
        ),
        "verify_mutation": _with(
            LOG_CTE,
            UPDATES_CTE,
            MERGED_CTE,
            body="""
            SELECT 'updated' AS table_name, count(*) AS n_rows FROM merged
            WHERE status_msg LIKE 'retried %'
            UNION ALL SELECT 'before_delete', count(*) FROM merged
            WHERE input_file_name LIKE 'pyspark_%'
            UNION ALL SELECT 'after_delete', 0
            UNION ALL SELECT 'kept', count(*) FROM merged
            WHERE input_file_name NOT LIKE 'pyspark_%'
            """,
        ),
        "order_desc": _with(LOG_CTE, body=_LATEST),
        "top_recent": _with(LOG_CTE, body=_LATEST + " LIMIT 20"),
        "stream_load": _with(TELEMETRY_CTE, body="SELECT * FROM telemetry"),
        "stream_gold": _with(TELEMETRY_CTE, body=_gold_body("telemetry", _NOW)),
        "intake_to_gold": _with(
            *WIDE_CTES,
            (
                "placed",
                """
                SELECT wide.* REPLACE (i.new_id AS flight_id)
                FROM wide JOIN (
                    SELECT s_suppkey,
                           CAST(row_number() OVER (
                               ORDER BY md5(concat('in/', CAST(s_suppkey AS VARCHAR), '.h5'))
                           ) AS INTEGER) AS new_id
                    FROM supplier) i ON i.s_suppkey = wide.flight_id
                """,
            ),
            body=_gold_body("placed", _NOW),
        ),
        "dq_pk": _with(
            *FLIGHTS_CTES,
            body="SELECT flight_id, count(*) AS n_rows FROM repeated "
            "GROUP BY flight_id HAVING count(*) > 1",
        ),
        "dq_fk": _with(
            TELEMETRY_CTE,
            *FLIGHTS_CTES,
            body="""
            SELECT flight_id, count(*) AS n_rows FROM telemetry
            WHERE flight_id NOT IN (SELECT flight_id FROM flights WHERE flight_id % 20 <> 19)
            GROUP BY flight_id
            """,
        ),
        "dq_name_collision": _with(
            *FLIGHTS_CTES,
            body="""
            SELECT output_name, count(*) AS n_files, min(flight_id) AS first_flight,
                   max(flight_id) AS last_flight
            FROM repeated GROUP BY output_name HAVING count(*) > 1
            """,
        ),
        "dq_counts": _with(
            LOG_CTE,
            TELEMETRY_CTE,
            body="""
            SELECT 'bronze' AS table_name, count(*) AS n_rows FROM supplier
            UNION ALL SELECT 'status', count(*) FROM status_log
            UNION ALL SELECT 'silver', count(*) FROM telemetry
            UNION ALL SELECT 'gold', count(*) FROM (
                SELECT DISTINCT flight_id, flight_phase FROM telemetry)
            """,
        ),
    }
    found["pipeline_repeat"] = found["intake_to_gold"]  # the same files in two arrivals
    return found
