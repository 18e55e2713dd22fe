"""Oracle SQL for the queries over stored tables (DuckDB dialect)."""

from __future__ import annotations

from . import layouts as T
from . import loads as L
from . import ops
from .sqlgen import (CONTROL, OPEN, VERSION_ORDER, checked_select, incremental_query, load_ctes, rank_cols,
                     with_fixtures)


def catalog_columns() -> str:
    columns = [c for c in ops.BATCH_COLS if c != "audit_id"]
    each = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS ordinal_position, '{c}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({c}) AS null_count FROM src_batches" for i, c in enumerate(columns, 1))
    return with_fixtures(["src_batches"], [], each)


def _settled(rows: str, layout, keys) -> str:
    """``rows`` (with load_no) with the current-row flag settled over all of them: of
    each key's open versions the one loaded last."""
    rest = [c for c in rank_cols(layout, keys) if c != "audit_id"]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ("audit_id", "load_no", *rest))
    return (f"SELECT * REPLACE (end_dt = {OPEN} AND ROW_NUMBER() OVER (PARTITION BY {', '.join(keys)}, end_dt = {OPEN} "
            f"ORDER BY {order}) = 1 AS current_row_ind) FROM ({rows}) a")


def reload_from_own_target() -> str:
    specs = L.party_specs()
    changed = incremental_query(specs, {
        "src_sponsor": "SELECT * REPLACE (CASE WHEN spnsr_cmpny_key % 3 = 0 THEN concat(spnsr_cmpny_nm, 'II') "
                       "ELSE spnsr_cmpny_nm END AS spnsr_cmpny_nm) FROM src_sponsor"})
    head, _, _ = changed.rpartition("\nSELECT ")
    head = head[:head.rindex("\nSELECT ")] if head.endswith("UNION ALL") else head
    rows = "SELECT * FROM A_n0 UNION ALL BY NAME SELECT * FROM B_n0 UNION ALL BY NAME SELECT * FROM C_n0"
    return f"{head}\n{checked_select(T.PARTY, '(' + _settled(rows, T.PARTY, list(specs[0].keys)) + ') s')}"


def audit_close_in_place() -> str:
    hit = ("(SELECT max(audit_id) FROM src_batches WHERE batch_end_dtm IS NULL AND batch_name = 'batch_2')")
    month = f"(SELECT strftime(batch_start_dtm, '%Y-%m') FROM src_batches WHERE audit_id = {hit})"
    upd = (f"SELECT audit_id, batch_name, scheduler, batch_start_dtm, "
           f"CASE WHEN audit_id = {hit} THEN TIMESTAMP '{ops.AUDIT_NOW}' ELSE batch_end_dtm END AS batch_end_dtm, "
           f"CASE WHEN audit_id = {hit} THEN 'S' ELSE batch_load_stus_ind END AS batch_load_stus_ind, "
           f"CASE WHEN audit_id = {hit} THEN TIMESTAMP '{ops.AUDIT_NOW}' ELSE row_process_dtm END AS row_process_dtm, "
           f"strftime(batch_start_dtm, '%Y-%m') = {month} AS rewritten FROM src_batches")
    sel = ops._batches_select(f"({upd}) b").replace(" FROM (", ", rewritten FROM (", 1)
    return with_fixtures(["src_batches"], [], sel)


def reflag_stored_history() -> str:
    ctes, _ = ops._history_ctes()
    rows = "SELECT * REPLACE (1 AS load_no) FROM H_n0 UNION ALL BY NAME SELECT * REPLACE (2 AS load_no) FROM H_n1"
    return with_fixtures(["src_audit", "src_agreement_hist"], ctes,
                         checked_select(T.AGREEMENT, f"({_settled(rows, T.AGREEMENT, [ops.KEY])}) s"))


def step_log_resume() -> str:
    valid = ops._steps_valid().replace("'dim_party'", "'dim_plan'")
    return with_fixtures(["src_steps"], [f"v AS ({valid})"], """
SELECT CAST(transformation_seq AS INTEGER) AS transformation_seq, attempt, status,
       CASE WHEN status = 'S' THEN (SELECT count(*) FROM supplier s JOIN supplier own ON own.s_nationkey = s.s_nationkey
                                    WHERE own.s_suppkey = CAST(transformation_seq AS INTEGER)) END AS n,
       status = 'F' AS has_message
FROM (SELECT transformation_seq, CAST(CASE WHEN step_index = mid THEN 2 ELSE 1 END AS INTEGER) AS attempt, 'S' AS status
      FROM v, (SELECT (max(step_index) + 1) // 2 AS mid FROM v) m
      UNION ALL
      SELECT transformation_seq, CAST(1 AS INTEGER), 'F' FROM v, (SELECT (max(step_index) + 1) // 2 AS mid FROM v) m
      WHERE step_index = mid) x""")


STORED = {
    "catalog_columns": catalog_columns,
    "reload_from_own_target": reload_from_own_target,
    "audit_close_in_place": audit_close_in_place,
    "append_by_name": L.load_address_all,
    "classify_bucketed_target": ops.change_classify,
    "classify_partitioned_target": ops.change_classify,
    "classify_reduced_target": ops.change_classify,
    "load_party_stored": L.load_party_incremental,
    "load_agreement_stored": L.load_agreement_incremental,
    "reflag_stored_history": reflag_stored_history,
    "step_log_resume": step_log_resume,
}
