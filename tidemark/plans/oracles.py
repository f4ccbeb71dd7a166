"""The same results as plain SQL over the benchmark tables."""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.plans.feeds import A_END, A_MID, A_START, B_END, B_MID, B_START

_STAMP_TEXT = "'%Y-%m-%d %H:%M:%S.%f'"

FEED_A = f"""
SELECT CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END AS "Op",
       strftime(date_trunc('hour', ts), {_STAMP_TEXT}) AS cdc_timestamp,
       user_id, event_type,
       CASE WHEN event_type <> 'view' THEN value END AS value,
       CAST(ts AS date) AS event_date,
       strftime(ts, '%Y%m%d') || '-000000000.parquet' AS file_name,
       1 AS is_change, event_id AS row_index
FROM events"""

FEED_B = f"""
SELECT CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'I' ELSE 'U' END AS "Op",
       strftime(o_orderdate, {_STAMP_TEXT}) AS cdc_timestamp,
       o_custkey AS c_custkey,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_totalprice END AS amount,
       o_orderpriority AS priority, CAST(o_orderdate AS date) AS order_date,
       strftime(o_orderdate, '%Y%m%d') || '-'
         || lpad(CAST(o_orderkey % 100 AS varchar), 9, '0') || '.parquet' AS file_name,
       1 AS is_change, o_orderkey AS row_index
FROM orders"""

LOAD_A = """
SELECT CAST(NULL AS varchar) AS "Op", CAST({stamp} AS varchar) AS cdc_timestamp,
       c_custkey AS user_id, c_mktsegment AS event_type, c_acctbal AS value,
       DATE '2023-12-31' AS event_date, 'LOAD00000001.parquet' AS file_name,
       0 AS is_change, c_custkey AS row_index
FROM customer"""

PREVIOUS_A = """
SELECT s_suppkey AS user_id, s_name AS event_type, s_acctbal AS value,
       DATE '2023-12-31' AS event_date
FROM supplier"""

PREVIOUS_B = """
SELECT s_suppkey AS c_custkey, s_acctbal AS amount, s_name AS priority,
       DATE '1994-12-31' AS order_date
FROM supplier"""

SKEWED_B = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS c_custkey,
       o_totalprice AS amount, o_orderpriority AS priority, CAST(o_orderdate AS date) AS order_date
FROM orders"""

COLUMNS_A = ("user_id", "event_type", "value", "event_date")
COLUMNS_B = ("c_custkey", "amount", "priority", "order_date")
DATES = ("event_date", "order_date", "dt")

_LOAD_FIRST = "is_change, cdc_timestamp, file_name, row_index"
_BY_STAMP = "cdc_timestamp, is_change, file_name, row_index"


def _load(day) -> str:
    return LOAD_A.format(stamp=f"'{day} 00:00:00.000000'")


def _plain(columns: Sequence[str]) -> str:
    return ", ".join(
        f"CAST({c} AS varchar) AS {c}" if c in DATES else f'"{c}"' for c in columns
    )


def _window(feed: str, first, last) -> str:
    return (
        f"SELECT * FROM ({feed}) AS feed WHERE CAST(CAST(cdc_timestamp AS timestamp) AS date) "
        f"BETWEEN DATE '{first}' AND DATE '{last}'"
    )


def _ranked(feed: str, keys: str, order: str, down: bool) -> str:
    if down:
        order = ", ".join(f"{c} DESC" for c in order.split(", "))
    return (
        f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM ({feed}) AS rows"
    )


def _latest(feed: str, keys: str, first, last, order: str = _LOAD_FIRST) -> str:
    ranked = _ranked(_window(feed, first, last), keys, order, down=True)
    return f"SELECT * FROM ({ranked}) AS ranked WHERE rn = 1"


def _merge(
    old: str, new: str, keys: Sequence[str], columns: Sequence[str], overwrite: bool = False
) -> str:
    def value(c: str) -> str:
        if overwrite:
            return f"CASE WHEN new.rn = 1 THEN new.{c} ELSE old.{c} END AS {c}"
        return f"coalesce(new.{c}, old.{c}) AS {c}"

    return (
        f"SELECT {', '.join(value(c) for c in columns)} "
        f"FROM ({old}) AS old FULL OUTER JOIN ({new}) AS new "
        f"ON {' AND '.join(f'old.{k} = new.{k}' for k in keys)} "
        f"""WHERE new."Op" IS NULL OR new."Op" <> 'D'"""
    )


def _kept(latest: str, columns: Sequence[str]) -> str:
    """A merge onto nothing."""
    return (
        f"SELECT {', '.join(columns)} FROM ({latest}) AS latest "
        f"""WHERE "Op" IS NULL OR "Op" <> 'D'"""
    )


def _show(sql: str, columns: Sequence[str]) -> str:
    return f"SELECT {_plain(columns)} FROM ({sql}) AS result"


_ROW = ("Op", "cdc_timestamp", *COLUMNS_A)
_A1 = ("user_id",)
_A2 = ("user_id", "event_type")

_latest_a = _latest(FEED_A, "user_id", A_START, A_END)
_merged_a = _merge(PREVIOUS_A, _latest_a, _A1, COLUMNS_A)
_merged_a_overwrite = _merge(PREVIOUS_A, _latest_a, _A1, COLUMNS_A, overwrite=True)
_sequence_a = _ranked(FEED_A, "user_id", _LOAD_FIRST, down=False)


def _composite() -> str:
    keys = "user_id, event_type"
    mid = _kept(_latest(FEED_A, keys, A_START, A_MID), COLUMNS_A)
    return _merge(mid, _latest(FEED_A, keys, A_MID, A_END), _A2, COLUMNS_A)


def _chain() -> str:
    keys = ("c_custkey",)
    mid = _merge(PREVIOUS_B, _latest(FEED_B, "c_custkey", B_START, B_MID), keys, COLUMNS_B)
    return _merge(mid, _latest(FEED_B, "c_custkey", B_MID, B_END), keys, COLUMNS_B)


def _bootstrap(day, order: str) -> str:
    both = f"{_load(day)} UNION ALL {FEED_A}"
    return _kept(_latest(both, "user_id", A_START, A_END, order), COLUMNS_A)


_DT = (*COLUMNS_A, "dt")


def _partition(first, day, feed: str = FEED_A) -> str:
    latest = _latest(feed, "user_id", first, day)
    return (
        f"SELECT *, event_date AS dt FROM ({latest}) AS latest "
        f"WHERE event_date = DATE '{day}'"
    )


def _previous_partition(day) -> str:
    return (
        "SELECT s_suppkey AS user_id, s_name AS event_type, s_acctbal AS value, "
        f"DATE '{day}' AS event_date, DATE '{day}' AS dt FROM supplier"
    )


def _untouched(day) -> str:
    return f"SELECT user_id, event_type, value, event_date, DATE '{day}' AS dt FROM ({PREVIOUS_A}) AS p"


def _run_flat() -> str:
    first = _kept(
        _latest(f"{_load(A_START)} UNION ALL {FEED_A}", "user_id", A_START, A_START), COLUMNS_A
    )
    mid = _merge(first, _latest(FEED_A, "user_id", A_START, A_MID), _A1, COLUMNS_A)
    return _merge(mid, _latest(FEED_A, "user_id", A_MID, A_END), _A1, COLUMNS_A)


def _run_partitioned() -> str:
    both = f"{_load(A_START)} UNION ALL {FEED_A}"
    mid = _kept(_partition(A_START, A_MID, both), _DT)
    return f"{mid} UNION ALL {_kept(_partition(A_MID, A_END), _DT)}"


def _job_run() -> str:
    both = f"{_load(A_START)} UNION ALL {FEED_A}"
    mid = _kept(_latest(both, "user_id", A_START, A_MID), COLUMNS_A)
    return _merge(mid, _latest(FEED_A, "user_id", A_MID, A_END), _A1, COLUMNS_A, overwrite=True)


def _backfill(overwrite: bool) -> str:
    """Every version from the one before it, the first one from the load."""
    days = [A_START, "2024-01-08", A_MID, "2024-01-22", A_END]
    versions, tables = [], []
    for n, day in enumerate(days):
        if n:
            new = _latest(FEED_A, "user_id", days[n - 1], day)
            made = _merge(f"SELECT * FROM v{n - 1}", new, _A1, COLUMNS_A, overwrite)
        else:
            made = _kept(_latest(f"{_load(day)} UNION ALL {FEED_A}", "user_id", day, day), COLUMNS_A)
        tables.append(f"v{n} AS MATERIALIZED ({made})")
        versions.append(f"SELECT {_plain(COLUMNS_A)}, '{day}' AS version FROM v{n}")
    return f"WITH {', '.join(tables)} {' UNION ALL '.join(versions)}"


def _run_report() -> str:
    """Every run's dates and counts: change files lie on the day of their rows, so none is out of date."""
    load, keep = f"{_load(A_START)} UNION ALL {FEED_A}", (_A1, COLUMNS_A)
    flat = [("flat", A_START, None, 1, load, A_START), ("flat", A_MID, A_START, 0, FEED_A, A_START)]
    flat += [("flat", A_END, A_MID, 0, FEED_A, A_MID), ("flat", A_END, A_END, 0, FEED_A, A_END)]
    versions = [_kept(_latest(load, "user_id", A_START, A_START), COLUMNS_A)]
    for _, day, _, _, feed, first in flat[1:]:
        versions.append(_merge(versions[-1], _latest(feed, "user_id", first, day), *keep))
    days = [("partitioned", A_MID, None, 1, load, A_START), ("partitioned", A_END, A_MID, 0, FEED_A, A_MID)]
    rows = []
    for (mode, day, last, with_load, feed, first), shown in zip(flat + days, [*versions, None, None]):
        delta = _latest(feed, "user_id", first, day) if shown else _partition(first, day, feed)
        read = f"SELECT count(*) FROM events WHERE CAST(ts AS date) BETWEEN DATE '{first}' AND DATE '{day}'"
        more = "(SELECT count(*) FROM customer)" if with_load else "0"
        published = shown or _kept(delta, _DT)
        rows.append(
            f"SELECT '{mode}' AS mode, '{day}' AS as_of, 'published' AS status, "
            f"CAST({f"'{last}'" if last else 'NULL'} AS varchar) AS last_date, {with_load} AS with_load, "
            f"({read}) + {more} AS read, 0 AS undated, 0 AS too_early, 0 AS too_late, "
            f"""count(*) AS changed, count(*) FILTER ("Op" = 'D') AS deleted, """
            f"(SELECT count(*) FROM ({published}) AS shown) AS published FROM ({delta}) AS delta"
        )
    return " UNION ALL ".join(rows)


def _refused_runs() -> str:
    reasons = [
        ("flat", "2023-12-31", f"run date 2023-12-31 lies before cdc_start_date {A_START}"),
        ("flat", str(A_START), f"run date {A_START} lies before the last published date {A_MID}"),
        ("flat", "15.01.2024", "expected a date as YYYY-MM-DD, got '15.01.2024'"),
        ("partitioned", str(A_END), "table is not partitioned by dt: use a flat run for it"),
        ("partitioned", str(A_END), "a partitioned run needs partition_date in the feed spec"),
        ("hourly", str(A_END), "mode must be one of ('flat', 'partitioned'), not 'hourly'"),
        ("write", str(A_END), "versions of a partitioned table can only be written whole"),
    ]
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    values = ", ".join(f"({', '.join(map(quoted, row))})" for row in reasons)
    shown = _kept(_latest(f"{_load(A_START)} UNION ALL {FEED_A}", "user_id", A_START, A_MID), COLUMNS_A)
    return (
        f"SELECT mode, as_of, 'refused' AS status, reason, n_rows FROM (VALUES {values}) AS r (mode, as_of, reason), "
        f"(SELECT count(*) AS n_rows FROM ({shown}) AS shown) AS n"
    )


def _after_crash() -> str:
    """Both modes: the previous rows, and what a run from the middle day to the last makes of them."""
    changes = _latest(FEED_A, "user_id", A_MID, A_END)
    mid = f"SELECT {', '.join(COLUMNS_A)} FROM ({PREVIOUS_A}) AS p"
    runs = {
        ("flat", "finished"): mid,
        ("flat", "run"): _merge(PREVIOUS_A, changes, _A1, COLUMNS_A),
        ("partitioned", "finished"): mid,
        ("partitioned", "run"): f"{mid} UNION ALL "
        f"SELECT {', '.join(COLUMNS_A)} FROM ({_kept(_partition(A_MID, A_END), _DT)}) AS day",
    }
    return " UNION ALL ".join(
        f"SELECT '{mode}' AS mode, '{step}' AS step, '{A_MID}' AS resumed, {_plain(COLUMNS_A)} FROM ({sql}) AS rows"
        for (mode, step), sql in runs.items()
    )


ORACLES: dict[str, str] = {
    "feed_scan": _show(
        f"SELECT * FROM ({FEED_A}) AS a UNION ALL SELECT * FROM ({LOAD_A.format(stamp='NULL')}) AS load",
        (*_ROW, "is_change"),
    ),
    "feed_footers": """
        WITH wanted AS (
            SELECT * FROM (VALUES ('Op', 'string'), ('cdc_timestamp', 'string'), ('user_id', 'int64'),
                           ('event_type', 'string'), ('value', 'double'), ('event_date', 'date')) AS w (name, wanted)
        ),
        changed AS (
            SELECT * FROM (VALUES ('narrow', 'user_id', 'int32', 'fits'), ('missing', 'event_type', NULL, 'missing'),
                           ('misfit', 'value', 'string', 'misfit')) AS c (export, name, found, verdict)
        ),
        exports AS (SELECT unnest(['plain', 'narrow', 'missing', 'extra', 'misfit']) AS export)
        SELECT export, name, CASE WHEN verdict IS NULL THEN wanted ELSE found END AS found, wanted,
               coalesce(verdict, 'fits') AS verdict
        FROM exports CROSS JOIN wanted LEFT JOIN changed USING (export, name)
        WHERE EXISTS (SELECT * FROM events)
        UNION ALL SELECT 'extra', 'more', 'double', NULL, 'extra' WHERE EXISTS (SELECT * FROM events)""",
    "feed_scan_files": _show(FEED_A, _ROW),
    "feed_scan_selected_files": _show(
        f"SELECT * FROM ({FEED_A}) AS feed "
        f"WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '{A_MID}'",
        _ROW,
    ),
    "feed_files": f"""
        SELECT file_name, 'change' AS kind,
               CAST(CAST(strptime(substr(file_name, 1, 8), '%Y%m%d') AS date) AS varchar)
                 AS file_date,
               count(*) AS n_rows
        FROM ({FEED_B}) AS feed WHERE order_date <= DATE '{B_MID}' GROUP BY file_name""",
    "feed_files_listed": """
        SELECT DISTINCT 'change' AS kind, CAST(CAST(ts AS date) AS varchar) AS file_date FROM events
        UNION ALL SELECT DISTINCT 'load', CAST(NULL AS varchar) FROM customer""",
    "full_load_rows": _show(LOAD_A.format(stamp="NULL"), _ROW),
    "full_load_rebase": f"""
        SELECT 1 - is_change AS is_load, cdc_timestamp, user_id
        FROM ({_load(A_START)} UNION ALL {FEED_A}) AS feed""",
    "change_window": _show(_window(FEED_A, "2024-01-05", A_MID), _ROW),
    "change_sequence": f"""
        SELECT user_id, row_index AS event_id, rn AS change_seq FROM ({_sequence_a}) AS s""",
    "change_sequence_slices": f"""
        SELECT user_id, row_index AS event_id, rn AS change_seq FROM ({_sequence_a}) AS s""",
    "change_sequence_files": f"""
        SELECT user_id, cdc_timestamp, event_type, value, rn AS change_seq
        FROM ({_sequence_a}) AS s""",
    "latest_change": _show(_latest_a, _ROW),
    "latest_change_composite": _show(
        _latest(FEED_A, "user_id, event_type", A_START, A_END), _ROW
    ),
    "latest_change_agg": _show(_latest_a, _ROW),
    "deleted_keys": f"""SELECT user_id FROM ({_latest_a}) AS latest WHERE "Op" = 'D'""",
    "snapshot_merge": _show(_merged_a, COLUMNS_A),
    "snapshot_merge_overwrite": _show(_merged_a_overwrite, COLUMNS_A),
    "snapshot_merge_broadcast": _show(_merged_a, COLUMNS_A),
    "snapshot_merge_broadcast_overwrite": _show(_merged_a_overwrite, COLUMNS_A),
    "snapshot_merge_skewed": _show(
        _merge(SKEWED_B, _latest(FEED_B, "c_custkey", B_START, B_END), ("c_custkey",), COLUMNS_B),
        COLUMNS_B,
    ),
    "snapshot_merge_composite": _show(_composite(), COLUMNS_A),
    "snapshot_chain": _show(_chain(), COLUMNS_B),
    "snapshot_late_bootstrap": _show(_bootstrap(A_START, _LOAD_FIRST), COLUMNS_A),
    "snapshot_late_bootstrap_restamped": _show(_bootstrap(A_END, _BY_STAMP), COLUMNS_A),
    "load_or_empty": _show(_kept(_latest_a, COLUMNS_A), COLUMNS_A),
    "partition_snapshot": _show(_partition(A_START, A_END), ("Op", *_DT)),
    "partition_merge": _show(
        _merge(_previous_partition(A_END), _partition(A_START, A_END), _A1, _DT), _DT
    ),
    "partition_overwrite": _show(
        f"{_untouched(A_MID)} UNION ALL "
        + _merge(_untouched(A_END), _partition(A_START, A_END), _A1, _DT),
        _DT,
    ),
    "partition_overwrite_dynamic": _show(
        f"{_untouched(A_END)} UNION ALL "
        f"SELECT {', '.join(_DT)} FROM ({_partition(A_START, A_MID)}) AS day",
        _DT,
    ),
    "versioned_publish": _show(_merged_a, COLUMNS_A),
    "publish_after_crash": _after_crash(),
    "version_as_of": _show(PREVIOUS_A, COLUMNS_A),
    "versions_side_by_side": f"""
        SELECT '{A_START}' AS version, count(*) AS n_rows FROM ({PREVIOUS_A}) AS a
        UNION ALL SELECT '{A_END}', count(*) FROM ({_merged_a}) AS b""",
    "run_flat": _show(_run_flat(), COLUMNS_A),
    "run_flat_ledger": _show(_run_flat(), COLUMNS_A),
    "feed_ledger": f"""
        SELECT DISTINCT CASE WHEN day <= DATE '{A_START}' THEN '{A_START}'
                             WHEN day <= DATE '{A_MID}' THEN '{A_MID}' ELSE '{A_END}' END AS as_of,
               CAST(day AS varchar) AS file_date, CAST(day AS varchar) AS first_day, CAST(day AS varchar) AS last_day
        FROM (SELECT CAST(ts AS date) AS day FROM events) AS days
        WHERE day BETWEEN DATE '{A_START}' AND DATE '{A_END}'""",
    "run_flat_bucketed": _show(_run_flat(), COLUMNS_A),
    "bucket_files": f"""
        SELECT count(DISTINCT user_id) * 0 + 8 AS buckets, 1 AS most_files
        FROM ({_run_flat()}) AS run""",
    "schema_overwrite_dynamic": _show(
        f"SELECT user_id, event_type, value, event_date, 1 AS more, DATE '{A_END}' AS dt "
        f"FROM ({PREVIOUS_A}) AS p",
        (*COLUMNS_A, "more", "dt"),
    ),
    "partition_files": """
        SELECT publication, 1 AS files FROM (VALUES (1), (2), (3)) AS p (publication)
        WHERE EXISTS (SELECT * FROM supplier)""",
    "max_records": """
        WITH cap AS (SELECT greatest(1, count(*) // 100) AS most FROM events)
        SELECT 'whole' AS kind, least(most, count(*)) AS largest, count(*) AS n_rows FROM events, cap GROUP BY most
        UNION ALL SELECT 'daily', least(most, max(n)), CAST(sum(n) AS bigint)
        FROM (SELECT count(*) AS n FROM events GROUP BY CAST(ts AS date)) AS days, cap GROUP BY most""",
    "run_partitioned": _show(_run_partitioned(), _DT),
    "job_run": _show(_job_run(), COLUMNS_A),
    "run_report": _run_report(),
    "refused_runs": _refused_runs(),
    "backfill": _backfill(overwrite=False),
    "backfill_overwrite": _backfill(overwrite=True),
    "build_without_publishing": _show(_bootstrap(A_START, _LOAD_FIRST), COLUMNS_A),
    "table_state": f"""
        SELECT 0 AS existed_before, 1 AS exists_after, count(*) AS n_rows
        FROM ({_merged_a}) AS merged""",
    "partition_list": """
        SELECT DISTINCT 'dt=' || CAST(CAST(ts AS date) AS varchar) AS "partition" FROM events""",
    "last_partition": """
        SELECT CAST(max(CAST(ts AS date)) AS varchar) AS last_partition, count(*) AS n_rows
        FROM events""",
    "current_version": f"""
        SELECT '{A_END}' AS current_version, count(*) AS n_rows FROM ({_merged_a}) AS merged""",
}
