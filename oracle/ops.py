"""Oracle SQL for the operator-level queries (DuckDB dialect)."""

from __future__ import annotations

from . import layouts as T

from . import loads as L
from .sqlgen import (OPEN, SqlSpec, _prepared_select, bounds, checked_select, cs, hk, itxt,
                     load_ctes, norm, ph, q, rank_cols, tobool, with_fixtures, yn_bool)

AS_OF = "2001-01-01"
OLD_CUTOFF = "1999-01-01"


def _simple(fixtures, body):
    return lambda: with_fixtures(fixtures, [], body)


def _flat(x):
    return f"regexp_replace(trim(CAST({x} AS VARCHAR)), '(\\r\\n|\\n|\\r|\\t)', ' ', 'g')"


OPS = {
    "scan_project": _simple(["src_sponsor"],
        "SELECT spnsr_cmpny_id AS sponsor_id, icu_id, spnsr_cmpny_nm AS sponsor_name, rcrd_effctv_dt FROM src_sponsor"),
    "clean_string": _simple(["src_participant"],
        "SELECT prtcpnt_id, plan_id, " + ", ".join(f"{cs(c)} AS {c}" for c in
            ("addrss_ln_1", "addrss_ln_3", "cstmr_id_2", "prtcpnt_tax_id", "zip_plus_4_cd")) + " FROM src_participant"),
    "normalise_text": _simple(["src_participant"],
        f"SELECT prtcpnt_id, plan_id, {norm('actv_rcrd_ind')} AS actv_norm, {norm('rsdnc_lctn_cd')} AS country_norm, "
        "lower(trim(stt_cd)) AS state_lower FROM src_participant"),
    "active_filter": _simple(["src_participant"],
        f"SELECT icu_id, plan_id, prtcpnt_id FROM src_participant WHERE {L.active_trim()}"),
    "exclude_sentinels": _simple(["src_sponsor"],
        f"SELECT spnsr_cmpny_key, icu_id, {cs('spnsr_cmpny_tax_id')} AS tax_id FROM src_sponsor "
        f"WHERE {L.real_icu('icu_id', ('~', '00002', '-1'))} AND {cs('spnsr_cmpny_tax_id')} IS NOT NULL"),
    "conform_schema": _simple(["src_sponsor"],
        "SELECT " + ", ".join(
            (f"CAST({cs('spnsr_cmpny_nm')} AS VARCHAR) AS full_nm" if c == "full_nm" else
             f"CAST({itxt('spnsr_cmpny_id')} AS VARCHAR) AS party_id" if c == "party_id" else
             f"CAST(NULL AS {('DECIMAL(18,2)' if t.startswith('decimal') else t.upper().replace('STRING', 'VARCHAR'))}) AS {c}")
            for c, t in T.PARTY) + " FROM src_sponsor"),
    "prehash_value": _simple(["src_participant"],
        f"SELECT prtcpnt_id, plan_id, {ph('icu_id', itxt('spnsr_cmpny_id'), 'plan_id', 'prtcpnt_id')} AS agreement_nr, "
        f"{ph('cstmr_id_1', 'cstmr_id_2', 'addrss_ln_3')} AS customer_text FROM src_participant"),
    "hash_key": _simple(["src_participant"],
        f"SELECT prtcpnt_id, plan_id, {hk('icu_id', 'plan_id', 'prtcpnt_id')} AS contract_key, "
        f"{hk(q(' TRAC '), 'cstmr_id_2')} AS customer_key FROM src_participant"),
    "row_checksum": _simple(["src_plan"],
        f"SELECT plan_id, {hk('plan_nm', 'plan_nm_2', 'plan_nm_3', 'dflt_vlntry_dfrrl_pct', 'rcrd_effctv_dt', L.active_trim())} "
        "AS check_sum FROM src_plan"),
    "composite_id": _simple(["src_plan"],
        f"SELECT plan_id, {ph('icu_id', itxt('spnsr_cmpny_id'), 'plan_id')} AS agreement_nr, "
        f"{ph('plan_nm_3', 'plan_nm_2')} AS names FROM src_plan"),
    "nullable_hash": _simple(["src_plan"],
        f"SELECT plan_id, CASE WHEN {cs('plan_nm_3')} IS NULL THEN NULL ELSE {hk(cs('plan_nm_3'))} END AS name3_key FROM src_plan"),
    "validity_bounds": _simple(["src_demographics_hist"],
        "SELECT business_partner_id, " + ", ".join(
            (f"CAST({v} AS VARCHAR) AS {k}" if k.endswith("dtm") else f"{v} AS {k}")
            for k, v in bounds("pdcr_hist_fr_dt", "pdcr_hist_to_dt", "0001-01-01", "9999-12-31").items())
        + " FROM src_demographics_hist"),
    "control_columns": _simple(["src_sponsor", "src_audit"],
        "SELECT spnsr_cmpny_key, (SELECT audit_id FROM src_audit WHERE record_aligner = 1 AND batch_name = 'Trac_to_CIP') "
        "AS audit_id, '203' AS source_system_id, false AS restricted_row_ind, false AS logical_delete_ind FROM src_sponsor"),
    "audit_stamp": _simple(["src_agreement_hist", "src_audit"],
        "SELECT hldg_key, issue_dt, (SELECT audit_id FROM src_audit WHERE record_aligner = 1 AND batch_name = "
        "'Customer_to_CIP') AS audit_id FROM src_agreement_hist"),
    "flag_case": _simple(["src_agreement_hist"],
        f"SELECT hldg_key, issue_dt, conversion_end_date, coalesce(conversion_end_date < DATE '{AS_OF}', false) "
        "AS conversion_expired_ind FROM src_agreement_hist"),
    "indicator_to_boolean": _simple(["src_enrollment"],
        f"SELECT vru_enrllmnt_stts_key, icu_id, {yn_bool('pre_tax_auto_incrs_elctd_ind')} AS pre_tax_auto_ind, "
        f"{yn_bool('eaca_prtcpnt_ind')} AS eaca_ind, {tobool(cs('actv_rcrd_ind'))} AS active_ind FROM src_enrollment"),
    "flatten_whitespace": _simple(["src_steps"],
        f"SELECT transformation_seq, coalesce({_flat('transformation_desc')}, '') AS description, "
        f"{_flat('sql_statement')} AS sql_statement FROM src_steps"),
    "xref_subset": _simple(["src_xref"], f"SELECT * FROM {L.xref('TRAC_PRTC_ID')} x"),
    "join_inner_xref": _simple(["src_customer_agreement_hist", "src_xref"],
        f"SELECT x.party_id, t.prty_id, t.cust_agmt_hist_fr_dt FROM src_customer_agreement_hist t "
        f"JOIN {L.xref('TD_PRTY_ID')} x ON x.sor_party_id = t.prty_id"),
    "join_composite_text_key": _simple(["src_beneficiary", "src_xref"],
        f"SELECT x.party_id, t.icu_id, t.plan_id, t.prtcpnt_id, t.bnfcry_id FROM src_beneficiary t "
        f"JOIN {L.xref('TRAC_BEN_ID')} x ON x.sor_party_id = {L.join_txt('t.icu_id', 't.plan_id', 't.prtcpnt_id', 't.bnfcry_id')}"),
    "join_normalised_both_sides": _simple(["src_participant", "src_xref"],
        f"SELECT x.party_id, t.icu_id, t.plan_id, t.prtcpnt_id FROM src_participant t "
        f"JOIN {L.xref('TRAC_PRTC_ID')} x ON {cs('x.sor_party_id')} = {L.join_txt('t.icu_id', 't.plan_id', 't.prtcpnt_id')}"),
    "join_left_composite": _simple(["src_participant", "src_employee"],
        "SELECT t.icu_id, t.afflt_cmpny_id, t.spnsr_cmpny_id, t.emply_tax_id, t.plan_id, t.prtcpnt_id, e.hire_dt, e.hce_ind "
        "FROM src_participant t LEFT JOIN src_employee e ON t.icu_id = e.icu_id AND t.afflt_cmpny_id = e.afflt_cmpny_id "
        "AND t.spnsr_cmpny_id = e.spnsr_cmpny_id AND t.emply_tax_id = e.emply_tax_id"),
    "left_join_turned_inner": _simple(["src_plan", "src_sponsor"],
        f"SELECT p.plan_id, p.icu_id, p.spnsr_cmpny_id, s.spnsr_cmpny_nm FROM src_plan p LEFT JOIN src_sponsor s "
        f"ON p.icu_id = s.icu_id AND p.spnsr_cmpny_id = s.spnsr_cmpny_id WHERE {L.active('s.actv_rcrd_ind')}"),
    "translate_code": _simple(["src_participant", "src_translation"],
        f"SELECT t.prtcpnt_id, t.plan_id, t.stt_cd, st.v AS state_cde FROM src_participant t "
        f"LEFT JOIN {L.tr(L.STATE)} st ON st.k = {norm('t.stt_cd')}"),
    "phone_fan_out": _simple(["src_demographics_hist", "src_xref"],
        " UNION ".join(
            f"SELECT x.party_id, d.pdcr_hist_fr_dt, d.pdcr_hist_to_dt, {q(k)} AS phone_type_cde, {hk(*parts)} AS phone_id "
            f"FROM src_demographics_hist d JOIN {L.xref('BP_ID')} x ON x.sor_party_id = {cs('d.business_partner_id')}"
            for k, parts in (
                ("PREFTEL", [cs("d.preftel_ctry_cd_nr"), cs("d.preftel_nr_10digit"), "d.preftel_xtn_nr"]),
                ("RESTEL", [cs("d.restel_ctry_cd_nr"), cs("d.restel_nr_10digit"), "d.restel_xtn_nr"]),
                ("PREFAX", [cs("d.prefax_tel_ctry_cd_nr"), cs("d.prefax_tel_nr_10digit")])))),
    "balance_totals": _simple(["src_asset"],
        "SELECT icu_id, plan_id, prtcpnt_id, CAST(sum(asst_pstn_amt) AS DECIMAL(18,2)) AS total_balance_cash_amt, "
        "CAST(sum(shr_blnc_amt) AS DECIMAL(18,2)) AS total_balance_share_amt FROM src_asset GROUP BY icu_id, plan_id, prtcpnt_id"),
    "rollover_flag": _simple(["src_participant", "src_asset"],
        "SELECT t.icu_id, t.plan_id, t.prtcpnt_id, r.icu_id IS NOT NULL AS rollover_ind FROM src_participant t "
        "LEFT JOIN (SELECT DISTINCT icu_id, plan_id, prtcpnt_id FROM src_asset WHERE src_cd IN (128, 129, 155, 112, 182)) r "
        "ON t.icu_id = r.icu_id AND t.plan_id = r.plan_id AND t.prtcpnt_id = r.prtcpnt_id"),
    "latest_per_key": _simple(["src_enrollment"],
        "SELECT * EXCLUDE (ranking, actv_rcrd_ind) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY icu_id, plan_id, "
        f"prtcpnt_id ORDER BY {L.ENROLLMENT_TIEBREAK}) AS ranking FROM src_enrollment WHERE {L.active_trim()}) z "
        "WHERE ranking = 1"),
    "latest_per_key_join": _simple(["src_participant", "src_enrollment"],
        "SELECT t.icu_id, t.plan_id, t.prtcpnt_id, t.afflt_cmpny_id, e.vru_enrllmnt_stts_key, e.pre_tax_enrllmnt_amt "
        "FROM src_participant t LEFT JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY icu_id, plan_id, "
        f"prtcpnt_id ORDER BY {L.ENROLLMENT_TIEBREAK}) AS ranking FROM src_enrollment WHERE {L.active_trim()}) z "
        "WHERE ranking = 1) e ON t.icu_id = e.icu_id AND t.plan_id = e.plan_id AND t.prtcpnt_id = e.prtcpnt_id"),
    "distinct_rows": _simple(["src_participant"],
        f"SELECT DISTINCT icu_id, afflt_cmpny_id, {cs('stt_cd')} AS stt_cd FROM src_participant"),
}


# -- change-capture scenario -----------------------------------------------------

def _agreement_specs():
    (all_spec,) = L.customer_agreement_specs(AS_OF)
    old = SqlSpec(**{**all_spec.__dict__,
                     "from_sql": f"(SELECT * FROM src_agreement_hist WHERE issue_dt < DATE '{OLD_CUTOFF}') a"})
    return old, all_spec


def _history_ctes():
    """H_n0 = history (load over the old batch), H_n1 = new rows of the full
    batch classified against it; H_p1 = prepared rows of the full batch."""
    old, all_spec = _agreement_specs()
    return load_ctes([old, all_spec], "H")


KEY = "dim_agreement_natural_key_hash_uuid"
PREP_COLS = [c for c, _ in T.AGREEMENT + T.CONTROL if c not in ("row_process_dtm", "current_row_ind")]


def _out(cols_types, extra=()):
    sel = []
    for c, t in cols_types:
        sel.append(f"CAST({c} AS VARCHAR) AS {c}" if t.startswith("timestamp") else c)
    return ", ".join([*sel, *extra])


PREP_TYPES = [(c, t) for c, t in T.AGREEMENT + T.CONTROL if c not in ("row_process_dtm", "current_row_ind")]


def current_row_flag():
    _, all_spec = _agreement_specs()
    order = ", ".join(f"{c} DESC NULLS LAST" for c in rank_cols(T.AGREEMENT, [KEY]))
    flag = (f"coalesce(ROW_NUMBER() OVER (PARTITION BY {KEY} ORDER BY {order}) = 1 AND end_dt = {OPEN}, false) "
            "AS current_row_ind")
    return with_fixtures(["src_audit", "src_agreement_hist"], [f"p AS ({_prepared_select(all_spec)})"],
                         f"SELECT {_out(PREP_TYPES, [flag])} FROM p")


def current_row_flag_composite():
    (spec,) = L.customer_party_address_specs()
    keys = list(spec.keys)
    types = [(c, t) for c, t in T.PARTY_ADDRESS + T.CONTROL if c not in ("row_process_dtm", "current_row_ind")]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in rank_cols(T.PARTY_ADDRESS, keys))
    flag = (f"coalesce(ROW_NUMBER() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1 "
            f"AND end_dt = {OPEN}, false) AS current_row_ind")
    return with_fixtures(["src_audit", *spec.fixtures], [f"p AS ({_prepared_select(spec)})"],
                         f"SELECT {_out(types, [flag])} FROM p")


def change_classify():
    ctes, _ = _history_ctes()
    return with_fixtures(["src_audit", "src_agreement_hist"], ctes,
                         f"SELECT {_out(PREP_TYPES, ['change_type'])} FROM H_c1")


def begin_restart_on_update():
    ctes, _ = _history_ctes()
    types = []
    for c, t in PREP_TYPES:
        if c == "begin_dt":
            types.append((f"CASE WHEN change_type = 'U' THEN DATE '{AS_OF}' ELSE begin_dt END AS begin_dt", "x"))
        elif c == "begin_dtm":
            types.append((f"CAST(CASE WHEN change_type = 'U' THEN CAST(DATE '{AS_OF}' AS TIMESTAMP) ELSE begin_dtm END "
                          "AS VARCHAR) AS begin_dtm", "x"))
        else:
            types.append((c, t))
    sel = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if t.startswith("timestamp") else c for c, t in types)
    return with_fixtures(["src_audit", "src_agreement_hist"], ctes,
                         f"SELECT {sel}, change_type FROM H_c1 WHERE change_type IN ('I','U')")


def _kept_history():
    return (f"SELECT h.* FROM H_n0 h WHERE NOT EXISTS (SELECT 1 FROM H_n1 n WHERE coalesce(n.current_row_ind, false) "
            f"AND n.end_dt = {OPEN} AND n.{KEY} = h.{KEY} AND n.check_sum <> h.check_sum)")


def anti_join_changed():
    ctes, _ = _history_ctes()
    return with_fixtures(["src_audit", "src_agreement_hist"], ctes,
                         checked_select(T.AGREEMENT, f"({_kept_history()}) k"))


def effective_target():
    ctes, _ = _history_ctes()
    cols = (f"{KEY}, end_dt, CAST(end_dtm AS VARCHAR) AS end_dtm, begin_dt, CAST(begin_dtm AS VARCHAR) AS begin_dtm, "
            "current_row_ind, check_sum, source_system_id, audit_id")
    # the two sides differ in process time, so they never merge
    return with_fixtures(["src_audit", "src_agreement_hist"], ctes,
                         f"SELECT DISTINCT {cols} FROM ({_kept_history()}) k "
                         f"UNION ALL SELECT DISTINCT {cols} FROM H_n1")


def union_distinct_targets():
    ctes, _ = _history_ctes()
    cols = f"{KEY}, check_sum, end_dt, current_row_ind"
    return with_fixtures(["src_audit", "src_agreement_hist"], ctes,
                         f"SELECT DISTINCT {cols} FROM (SELECT {cols} FROM H_n0 UNION ALL SELECT {cols} FROM H_n1) u")


# -- batch control ------------------------------------------------------------------

def _steps_valid(extra=""):
    return (f"SELECT lower(trim(source_cd)) AS source_key, lower(trim(work_table)) AS work_table_key, "
            f"ROW_NUMBER() OVER (ORDER BY transformation_seq) AS step_index, "
            f"CAST(transformation_seq AS VARCHAR) AS transformation_seq, "
            f"coalesce({_flat('transformation_desc')}, '') AS transformation_desc, {_flat('sql_statement')} AS sql_statement "
            f"FROM src_steps WHERE lower(trim(source_cd)) = 'trac' AND lower(trim(work_table)) = 'dim_party' "
            f"AND DATE '{AS_OF}' BETWEEN valid_from AND valid_to{extra}")


AUDIT_NOW = "2001-01-01 06:00:00"
BATCH_COLS = ("audit_id", "batch_name", "scheduler", "batch_start_dtm", "batch_end_dtm",
              "batch_load_stus_ind", "row_process_dtm")


def _batches_select(src):
    return (f"SELECT audit_id, batch_name, scheduler, CAST(batch_start_dtm AS VARCHAR) AS batch_start_dtm, "
            f"CAST(batch_end_dtm AS VARCHAR) AS batch_end_dtm, batch_load_stus_ind, "
            f"CAST(row_process_dtm AS VARCHAR) AS processed_dtm FROM {src}")


def audit_open():
    new = (f"SELECT CAST(coalesce(max(audit_id), 0) + 1 AS INTEGER) AS audit_id, 'batch_2' AS batch_name, "
           f"'cron' AS scheduler, TIMESTAMP '{AUDIT_NOW}' AS batch_start_dtm, CAST(NULL AS TIMESTAMP) AS batch_end_dtm, "
           f"'I' AS batch_load_stus_ind, TIMESTAMP '{AUDIT_NOW}' AS row_process_dtm FROM src_batches")
    return with_fixtures(["src_batches"], [],
                         _batches_select(f"(SELECT * FROM src_batches UNION ALL {new}) b"))


def audit_close():
    hit = ("audit_id IN (SELECT max(audit_id) FROM src_batches WHERE batch_end_dtm IS NULL "
           "AND batch_name = 'batch_2')")
    upd = (f"SELECT audit_id, batch_name, scheduler, batch_start_dtm, "
           f"CASE WHEN {hit} THEN TIMESTAMP '{AUDIT_NOW}' ELSE batch_end_dtm END AS batch_end_dtm, "
           f"CASE WHEN {hit} THEN 'S' ELSE batch_load_stus_ind END AS batch_load_stus_ind, "
           f"CASE WHEN {hit} THEN TIMESTAMP '{AUDIT_NOW}' ELSE row_process_dtm END AS row_process_dtm FROM src_batches")
    return with_fixtures(["src_batches"], [], _batches_select(f"({upd}) b"))


OPS.update({
    "current_row_flag": current_row_flag,
    "current_row_flag_composite": current_row_flag_composite,
    "change_classify": change_classify,
    "begin_restart_on_update": begin_restart_on_update,
    "anti_join_changed": anti_join_changed,
    "effective_target": effective_target,
    "union_distinct_targets": union_distinct_targets,
    "metadata_count": _simple(["src_steps"],
        "SELECT count(*) AS step_count FROM src_steps WHERE lower(trim(source_cd)) = lower(trim('TRAC')) "
        "AND lower(trim(work_table)) = lower(trim('DIM_PARTY'))"),
    "metadata_steps": lambda: with_fixtures(["src_steps"], [], _steps_valid()),
    "metadata_single_step": lambda: with_fixtures(
        ["src_steps"], [],
        f"SELECT source_key, work_table_key, transformation_seq, transformation_desc, sql_statement "
        f"FROM ({_steps_valid()}) s WHERE transformation_seq = '1'"),
    "audit_open": audit_open,
    "audit_close": audit_close,
    "sink_overwrite_roundtrip": _simple(["src_sponsor"], "SELECT * FROM src_sponsor"),
})
