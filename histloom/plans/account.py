"""Account dimension (L06): one account per participant contract.

Inputs: cross-reference -> participant, left-joined to plan, balances,
latest enrollment, employee, rollover flag and employee-status translation.

Plan shape: balances and the rollover flag come from ONE aggregate over the
asset fact (``sum``, ``sum`` and ``max(src_cd in ...)``), instead of a
grouped scan plus a DISTINCT scan of the same fact.  The latest enrollment per
participant contract is a ``max(struct)`` aggregate, not a window, so a
participant with very many enrollment rows never lands in one sort task.
Balances, enrollment and rollover share the join key (icu, plan, participant)
so Spark can reuse one partitioning for them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (blank, bounds, clean_string, composite_id, hash_key, int_text, is_flag,
                         row_checksum, to_boolean, yes_no_to_boolean)
from ..operators.history import latest_per_key
from ..operators.lookup import resolve_party, translate_code
from . import targets as T
from .spec import LoadSpec
from .xref import participant_sor

ACCOUNT_KEY = ("dim_account_natural_key_hash_uuid",)
CONTRACT = ["icu_id", "plan_id", "prtcpnt_id"]

# Asset source codes that mark a rollover, and the translation
# of employee status codes.
ROLLOVER_SOURCES = (128, 129, 155, 112, 182)
EMPLOYEE_STATUS = {"src_cde": "TRAC", "src_tbl_nm": "DIM_PARTICIPANT",
                   "src_fld_nm": "EMPLOYEE_STTS_CD", "trnslt_fld_nm": "EMPLOYEE STATUS CODE"}
ENROLLMENT_ORDER = ("rcrd_effctv_dt", "vru_enrllmnt_stts_key")


def balance_totals(asset):
    """Per participant contract: total cash and share balance, and whether any
    asset row comes from a rollover source.  One partial+final aggregate.

    There are nearly as many contracts as rows, so its hash tables hold the whole
    task.  Rows are dealt by contract first: else the tables stand in the task of
    the join below (all contracts of a plan in one) beside its sorts, and AQE makes
    tasks of 64 MB of compressed rows, ten times that in a table.  AQE keeps a number
    that is given.  A session of few partitions gets twice as many, as a task holds
    two tables; with more than 200 the shuffle's writer would sort its rows, too."""
    parts = int(asset.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = asset.repartition(max(parts, min(2 * parts, 200)), *CONTRACT)
    return dealt.groupBy(*CONTRACT).agg(
        F.sum("asst_pstn_amt").alias("total_balance_cash_amt"),
        F.sum("shr_blnc_amt").alias("total_balance_share_amt"),
        F.max(F.col("src_cd").isin(*ROLLOVER_SOURCES)).alias("_rollover"),
    )


def latest_enrollment(enrollment):
    """Active enrollment row with the latest effective date (then key) per
    participant contract."""
    e = enrollment.filter(is_flag("actv_rcrd_ind")).drop("actv_rcrd_ind")
    return latest_per_key(e, CONTRACT, ENROLLMENT_ORDER)


def _derive_account(src, as_of):
    prt = src.participant.filter(is_flag("actv_rcrd_ind")).select(
        "icu_id", "afflt_cmpny_id", "plan_id", "spnsr_cmpny_id", "prtcpnt_id", "sspnd_strt_dt",
        "sspnd_end_dt", "emply_stts_cd", "emply_tax_id")
    plan = src.plan.filter(is_flag("actv_rcrd_ind")).select(
        "icu_id", "plan_id", "qlfd_plan_incptn_rt", "pre_tax_cntrbtn_incrs_rt")
    emp = src.employee.filter(is_flag("actv_rcrd_ind")).select(
        "icu_id", "afflt_cmpny_id", "spnsr_cmpny_id", "emply_tax_id", "hire_dt", "hce_ind",
        "key_emply_ind")
    # the widest rows come last: what is joined by contract does not move again
    df = prt.join(emp, ["icu_id", "afflt_cmpny_id", "spnsr_cmpny_id", "emply_tax_id"], "left").select(
        *CONTRACT, "spnsr_cmpny_id", "sspnd_strt_dt", "sspnd_end_dt", "emply_stts_cd", "hire_dt", "hce_ind", "key_emply_ind")
    df = resolve_party(df, src.xref, "TRAC_PRTC_ID", participant_sor(), clean_xref_side=True)
    df = (df.join(plan, ["icu_id", "plan_id"], "left")
            .join(balance_totals(src.asset), CONTRACT, "left")
            .join(latest_enrollment(src.enrollment), CONTRACT, "left"))
    df = translate_code(df, "emply_stts_cd", src.translation, EMPLOYEE_STATUS, "_emp_status")

    nr = composite_id(clean_string("icu_id"), clean_string(int_text("spnsr_cmpny_id")),
                      clean_string("plan_id"), clean_string("prtcpnt_id"))
    attrs = {
        "master_contract_group_id": composite_id(clean_string("icu_id"),
                                                 clean_string(int_text("spnsr_cmpny_id"))),
        "plan_id": F.col("plan_id"),
        "subscriber_id": blank(),
        "participant_id": F.col("prtcpnt_id"),
        "icu_id": F.col("icu_id"),
        "total_balance_share_amt": F.col("total_balance_share_amt"),
        "total_balance_cash_amt": F.col("total_balance_cash_amt"),
        "rollover_ind": F.coalesce(F.col("_rollover"), F.lit(False)),
        "suspension_start_dt": F.col("sspnd_strt_dt"),
        "suspension_end_dt": F.col("sspnd_end_dt"),
        "auto_deferral_ind": F.coalesce((F.col("qlfd_plan_incptn_rt") > 0)
                                        | (F.col("pre_tax_cntrbtn_incrs_rt") > 0), F.lit(False)),
        "pre_tax_auto_increase_election_ind": yes_no_to_boolean("pre_tax_auto_incrs_elctd_ind"),
        "deferral_enrollment_pre_tax_amt": F.col("pre_tax_enrllmnt_amt"),
        "deferral_enrollment_pre_tax_rt": F.col("pre_tax_enrllmnt_rt"),
        "deferral_enrollment_post_tax_amt": F.col("post_tax_enrllmnt_amt"),
        "deferral_enrollment_post_tax_rt": F.col("post_tax_enrllmnt_rt"),
        "deferral_enrollment_roth_amt": F.col("roth_elctv_dfrrl_enrllmnt_amt"),
        "deferral_enrollment_roth_rt": F.col("roth_elctv_dfrrl_enrllmnt_rt"),
        "deferral_enrollment_total_rt": blank(),
        "deferral_enrollment_total_amt": blank(),
        "deferral_enrollment_status_cde": F.col("enrllmnt_stts_cd"),
        "eaca_participation_ind": yes_no_to_boolean("eaca_prtcpnt_ind"),
        "eaca_opt_out_dt": F.col("eaca_opt_out_dt"),
        "eaca_start_dt": F.col("eaca_strt_dt"),
        "qaca_participation_ind": yes_no_to_boolean("qaca_prtcpnt_ind"),
        "qaca_opt_out_dt": F.col("qaca_opt_out_dt"),
        "qaca_next_deferral_increase_dt": F.col("qaca_next_incrs_dt"),
        "hire_dt": F.col("hire_dt"),
        "compensation_415_amt": blank(),
        "highly_compensated_employee_ind": to_boolean(clean_string("hce_ind")),
        "key_employee_ind": to_boolean(clean_string("key_emply_ind")),
        "employee_status_cde": clean_string("_emp_status"),
    }
    key = hash_key(F.lit("PTCP"), F.col("party_id"), F.lit("TRAC"), F.lit("PCA"), blank(), nr,
                   blank())
    b = bounds("rcrd_effctv_dt", "rcrd_trm_dt", "0001-01-01", "9999-12-31")
    # The source query de-duplicates here and again after the checksum; the
    # checksum is a function of the attributes, so the template's one
    # DISTINCT gives the same rows with one shuffle less.
    base = df.select(key.alias("dim_account_natural_key_hash_uuid"),
                     *[v.alias(k) for k, v in attrs.items()],
                     *[v.alias(k) for k, v in b.items()])
    return base.withColumn("check_sum", row_checksum(*attrs.keys()))


LOAD_ACCOUNT = LoadSpec("account", T.ACCOUNT, ACCOUNT_KEY, _derive_account,
                        restart_begin_on_update=True)
