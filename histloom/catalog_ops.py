"""Registered operator-level queries: each one exercises one building block of
the loads on the stand-in sources, over the whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .catalog import register
from .functions import (bounds, clean_string, composite_id, expired,
                        flatten_whitespace, hash_key, int_text, is_flag, normalise, nullable_hash,
                        prehash_value, row_checksum, to_boolean, yes_no_to_boolean)
from .operators import control
from .operators.history import (audit_id_for, classify_changes, control_columns,
                                effective_target, keep_changes, mark_current,
                                restart_begin_on_update, union_distinct)
from .operators.lookup import resolve_party, translate_code, xref_subset
from .plans import account, agreement, contact, targets as T
from .plans.address import STATE_CODE
from .plans.spec import checked_output, prepared, run_load
from .plans.xref import active, beneficiary_sor, participant_sor, real_icu
from .sources.fixtures import Sources, load_sources
from .sources.io import overwrite, scratch_path

AS_OF = "2001-01-01"
OLD_CUTOFF = "1999-01-01"


# -- scans, projections, strings ---------------------------------------------

@register("scan_project")
def q_scan_project(spark, sf):
    s = load_sources(spark, sf).sponsor
    return s.select(F.col("spnsr_cmpny_id").alias("sponsor_id"), "icu_id",
                    F.col("spnsr_cmpny_nm").alias("sponsor_name"), "rcrd_effctv_dt")


@register("clean_string")
def q_clean_string(spark, sf):
    p = load_sources(spark, sf).participant
    return p.select("prtcpnt_id", "plan_id", *[clean_string(c).alias(c) for c in
                    ("addrss_ln_1", "addrss_ln_3", "cstmr_id_2", "prtcpnt_tax_id", "zip_plus_4_cd")])


@register("normalise_text")
def q_normalise_text(spark, sf):
    p = load_sources(spark, sf).participant
    return p.select("prtcpnt_id", "plan_id", normalise("actv_rcrd_ind").alias("actv_norm"),
                    normalise("rsdnc_lctn_cd").alias("country_norm"),
                    F.lower(F.trim("stt_cd")).alias("state_lower"))


@register("active_filter")
def q_active_filter(spark, sf):
    p = load_sources(spark, sf).participant
    return p.filter(is_flag("actv_rcrd_ind")).select("icu_id", "plan_id", "prtcpnt_id")


@register("exclude_sentinels")
def q_exclude_sentinels(spark, sf):
    s = load_sources(spark, sf).sponsor
    return s.filter(real_icu(sentinels=agreement.SENTINEL_ICU_MCA)
                    & clean_string("spnsr_cmpny_tax_id").isNotNull()) \
            .select("spnsr_cmpny_key", "icu_id", clean_string("spnsr_cmpny_tax_id").alias("tax_id"))


@register("conform_schema")
def q_conform_schema(spark, sf):
    s = load_sources(spark, sf).sponsor
    return T.conform(s.select(clean_string("spnsr_cmpny_nm").alias("full_nm"),
                              int_text("spnsr_cmpny_id").alias("party_id")), T.PARTY)


# -- keys and digests -----------------------------------------------------------

@register("prehash_value")
def q_prehash_value(spark, sf):
    p = load_sources(spark, sf).participant
    return p.select("prtcpnt_id", "plan_id",
                    prehash_value("icu_id", int_text("spnsr_cmpny_id"), "plan_id", "prtcpnt_id")
                    .alias("agreement_nr"),
                    prehash_value("cstmr_id_1", "cstmr_id_2", "addrss_ln_3").alias("customer_text"))


@register("hash_key")
def q_hash_key(spark, sf):
    p = load_sources(spark, sf).participant
    return p.select("prtcpnt_id", "plan_id",
                    hash_key("icu_id", "plan_id", "prtcpnt_id").alias("contract_key"),
                    hash_key(F.lit(" TRAC "), "cstmr_id_2").alias("customer_key"))


@register("row_checksum")
def q_row_checksum(spark, sf):
    p = load_sources(spark, sf).plan
    return p.select("plan_id", row_checksum("plan_nm", "plan_nm_2", "plan_nm_3", "dflt_vlntry_dfrrl_pct",
                                           "rcrd_effctv_dt", is_flag("actv_rcrd_ind"))
                    .alias("check_sum"))


@register("composite_id")
def q_composite_id(spark, sf):
    p = load_sources(spark, sf).plan
    return p.select("plan_id", composite_id("icu_id", int_text("spnsr_cmpny_id"), "plan_id")
                    .alias("agreement_nr"),
                    composite_id("plan_nm_3", "plan_nm_2").alias("names"))


@register("nullable_hash")
def q_nullable_hash(spark, sf):
    p = load_sources(spark, sf).plan
    return p.select("plan_id", nullable_hash(clean_string("plan_nm_3")).alias("name3_key"))


# -- validity, control columns, flags ----------------------------------------------

@register("validity_bounds")
def q_validity_bounds(spark, sf):
    d = load_sources(spark, sf).demographics_hist
    b = bounds("pdcr_hist_fr_dt", "pdcr_hist_to_dt", "0001-01-01", "9999-12-31")
    return checked_output(d.select("business_partner_id", *[v.alias(k) for k, v in b.items()]))


@register("control_columns")
def q_control_columns(spark, sf):
    src = load_sources(spark, sf)
    s = src.sponsor.select("spnsr_cmpny_key")
    return control_columns(s, "203", audit_id_for(src.audit, "Trac_to_CIP"))


@register("audit_stamp")
def q_audit_stamp(spark, sf):
    src = load_sources(spark, sf)
    a = src.agreement_hist.select("hldg_key", "issue_dt")
    return a.select("*", audit_id_for(src.audit, "Customer_to_CIP").alias("audit_id"))


@register("flag_case")
def q_flag_case(spark, sf):
    src = load_sources(spark, sf)
    a = src.agreement_hist.select("hldg_key", "issue_dt", "conversion_end_date",
                                  expired("conversion_end_date", AS_OF).alias("conversion_expired_ind"))
    return a


@register("indicator_to_boolean")
def q_indicator_to_boolean(spark, sf):
    e = load_sources(spark, sf).enrollment
    return e.select("vru_enrllmnt_stts_key", "icu_id",
                    yes_no_to_boolean("pre_tax_auto_incrs_elctd_ind").alias("pre_tax_auto_ind"),
                    yes_no_to_boolean("eaca_prtcpnt_ind").alias("eaca_ind"),
                    to_boolean(clean_string("actv_rcrd_ind")).alias("active_ind"))


@register("flatten_whitespace")
def q_flatten_whitespace(spark, sf):
    s = load_sources(spark, sf).steps
    return s.select("transformation_seq",
                    F.coalesce(flatten_whitespace("transformation_desc"), F.lit("")).alias("description"),
                    flatten_whitespace("sql_statement").alias("sql_statement"))


# -- joins and lookups ---------------------------------------------------------------

@register("xref_subset")
def q_xref_subset(spark, sf):
    return xref_subset(load_sources(spark, sf).xref, "TRAC_PRTC_ID")


@register("join_inner_xref")
def q_join_inner_xref(spark, sf):
    src = load_sources(spark, sf)
    df = resolve_party(src.customer_agreement_hist, src.xref, "TD_PRTY_ID", F.col("prty_id"))
    return df.select("party_id", "prty_id", "cust_agmt_hist_fr_dt")


@register("join_composite_text_key")
def q_join_composite_text_key(spark, sf):
    src = load_sources(spark, sf)
    df = resolve_party(src.beneficiary, src.xref, "TRAC_BEN_ID", beneficiary_sor())
    return df.select("party_id", "icu_id", "plan_id", "prtcpnt_id", "bnfcry_id")


@register("join_normalised_both_sides")
def q_join_normalised_both_sides(spark, sf):
    src = load_sources(spark, sf)
    df = resolve_party(src.participant, src.xref, "TRAC_PRTC_ID", participant_sor(),
                       clean_xref_side=True)
    return df.select("party_id", "icu_id", "plan_id", "prtcpnt_id")


@register("join_left_composite")
def q_join_left_composite(spark, sf):
    src = load_sources(spark, sf)
    emp = src.employee.select("icu_id", "afflt_cmpny_id", "spnsr_cmpny_id", "emply_tax_id",
                              "hire_dt", "hce_ind")
    return src.participant.select("icu_id", "afflt_cmpny_id", "spnsr_cmpny_id", "emply_tax_id",
                                  "plan_id", "prtcpnt_id") \
        .join(emp, ["icu_id", "afflt_cmpny_id", "spnsr_cmpny_id", "emply_tax_id"], "left")


@register("left_join_turned_inner")
def q_left_join_turned_inner(spark, sf):
    src = load_sources(spark, sf)
    s = src.sponsor.select("icu_id", "spnsr_cmpny_id", "spnsr_cmpny_nm",
                           F.col("actv_rcrd_ind").alias("spn_actv"))
    df = src.plan.join(s, ["icu_id", "spnsr_cmpny_id"], "left").filter(active("spn_actv"))
    return df.select("plan_id", "icu_id", "spnsr_cmpny_id", "spnsr_cmpny_nm")


@register("translate_code")
def q_translate_code(spark, sf):
    src = load_sources(spark, sf)
    df = translate_code(src.participant, "stt_cd", src.translation, STATE_CODE, "state_cde")
    return df.select("prtcpnt_id", "plan_id", "stt_cd", "state_cde")


@register("phone_fan_out")
def q_phone_fan_out(spark, sf):
    src = load_sources(spark, sf)
    return contact.phone_fan_out(src.demographics_hist, src.xref)


# -- aggregates and latest rows ------------------------------------------------------

@register("balance_totals")
def q_balance_totals(spark, sf):
    b = account.balance_totals(load_sources(spark, sf).asset)
    return b.select(*account.CONTRACT,
                    F.col("total_balance_cash_amt").cast("decimal(18,2)").alias("total_balance_cash_amt"),
                    F.col("total_balance_share_amt").cast("decimal(18,2)").alias("total_balance_share_amt"))


@register("rollover_flag")
def q_rollover_flag(spark, sf):
    src = load_sources(spark, sf)
    b = account.balance_totals(src.asset).select(*account.CONTRACT, "_rollover")
    return src.participant.select(*account.CONTRACT).join(b, account.CONTRACT, "left") \
        .select(*account.CONTRACT, F.coalesce(F.col("_rollover"), F.lit(False)).alias("rollover_ind"))


@register("latest_per_key")
def q_latest_per_key(spark, sf):
    return account.latest_enrollment(load_sources(spark, sf).enrollment)


@register("latest_per_key_join")
def q_latest_per_key_join(spark, sf):
    src = load_sources(spark, sf)
    e = account.latest_enrollment(src.enrollment).select(
        *account.CONTRACT, "vru_enrllmnt_stts_key", "pre_tax_enrllmnt_amt")
    return src.participant.select(*account.CONTRACT, "afflt_cmpny_id").join(e, account.CONTRACT, "left")


@register("distinct_rows")
def q_distinct_rows(spark, sf):
    p = load_sources(spark, sf).participant
    return p.select("icu_id", "afflt_cmpny_id", clean_string("stt_cd").alias("stt_cd")).distinct()


# -- change capture scenario: an earlier batch (issue date before 1999) is the
#    conformed history, the full agreement history is the new batch. -------------

def _old_sources(src: Sources) -> Sources:
    old = src.agreement_hist.filter(F.col("issue_dt") < F.lit(OLD_CUTOFF).cast("date"))
    return Sources({**src.frames, "src_agreement_hist": old})


def _history_case(spark, sf):
    src = load_sources(spark, sf)
    spec = agreement.LOAD_CUSTOMER_AGREEMENT
    history = run_load(spec, _old_sources(src), None, AS_OF)
    rows = prepared(spec, src, AS_OF)
    return spec, src, history, rows


def _full_batch(spark, sf):
    spec = agreement.LOAD_CUSTOMER_AGREEMENT
    return spec, prepared(spec, load_sources(spark, sf), AS_OF)


def _classified(spark, sf):
    spec, src, history, rows = _history_case(spark, sf)
    return spec, classify_changes(rows, history, spec.keys)


@register("current_row_flag")
def q_current_row_flag(spark, sf):
    spec, rows = _full_batch(spark, sf)
    return checked_output(mark_current(rows, spec.keys))


@register("current_row_flag_composite")
def q_current_row_flag_composite(spark, sf):
    src = load_sources(spark, sf)
    spec = contact.LOAD_CUSTOMER_PARTY_ADDRESS
    return checked_output(mark_current(prepared(spec, src, AS_OF), spec.keys))


@register("change_classify")
def q_change_classify(spark, sf):
    _, c = _classified(spark, sf)
    return checked_output(c)


@register("begin_restart_on_update")
def q_begin_restart_on_update(spark, sf):
    _, c = _classified(spark, sf)
    return checked_output(restart_begin_on_update(keep_changes(c), AS_OF))


@register("anti_join_changed")
def q_anti_join_changed(spark, sf):
    """History rows that survive: no current open new row of the same key with
    another checksum."""
    spec, src, history, rows = _history_case(spark, sf)
    new = run_load(spec, src, history, AS_OF)
    cur = new.filter(F.col("current_row_ind") & (F.col("end_dt") == F.lit("9999-12-31").cast("date"))) \
             .select(F.col(spec.keys[0]).alias("_k"), F.col("check_sum").alias("_s"))
    kept = history.join(cur, (history[spec.keys[0]] == cur["_k"]) & (history["check_sum"] != cur["_s"]),
                        "left_anti")
    return checked_output(kept)


@register("effective_target")
def q_effective_target(spark, sf):
    spec, src, history, rows = _history_case(spark, sf)
    new = run_load(spec, src, history, AS_OF)
    return checked_output(effective_target(history, new, spec.keys))


@register("union_distinct_targets")
def q_union_distinct_targets(spark, sf):
    spec, src, history, rows = _history_case(spark, sf)
    new = run_load(spec, src, history, AS_OF)
    cols = [*spec.keys, "check_sum", "end_dt", "current_row_ind"]
    return union_distinct(history.select(*cols), new.select(*cols))


# -- batch control -------------------------------------------------------------------

@register("metadata_count")
def q_metadata_count(spark, sf):
    return control.step_count(load_sources(spark, sf).steps, "TRAC", "DIM_PARTY")


@register("metadata_steps")
def q_metadata_steps(spark, sf):
    return control.valid_steps(load_sources(spark, sf).steps, "TRAC", "DIM_PARTY", AS_OF)


@register("metadata_single_step")
def q_metadata_single_step(spark, sf):
    return control.single_step(load_sources(spark, sf).steps, "TRAC", "DIM_PARTY", AS_OF, 1)


AUDIT_NOW = "2001-01-01 06:00:00"


def _batches_out(df):
    return checked_output(df.withColumnRenamed("row_process_dtm", "processed_dtm"))


@register("audit_open")
def q_audit_open(spark, sf):
    b = load_sources(spark, sf).batches
    return _batches_out(control.audit_open(b, "batch_2", "cron", "I", AUDIT_NOW))


@register("audit_close")
def q_audit_close(spark, sf):
    b = load_sources(spark, sf).batches
    return _batches_out(control.audit_close(b, "batch_2", "S", AUDIT_NOW))


@register("sink_overwrite_roundtrip")
def q_sink_overwrite_roundtrip(spark, sf):
    s = load_sources(spark, sf).sponsor
    path = scratch_path(spark, f"sink-{uuid.uuid4().hex}")
    overwrite(s, path)
    overwrite(s, path)  # truncate-and-reload twice: no duplicates
    return spark.read.parquet(path)

