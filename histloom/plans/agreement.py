"""Agreement dimension: master contracts, plans and participant contracts from
the record-keeping system (L10-L12) and customer agreements (L01).

Agreement key: ``hash_key(prefix, number, suffix, source, type)``; the type
code is part of the key, so the three record-keeping loads never share a key
and run as one pass (``independent``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (as_text, blank, bounds, clean_string, composite_id, expired,
                         hash_key, int_text, row_checksum)
from ..operators.lookup import translate_code
from . import targets as T
from .spec import LoadSpec
from .xref import active, real_icu

AGREEMENT_KEY = ("dim_agreement_natural_key_hash_uuid",)

# Agreement types, source code and placeholder ICU ids.
MASTER, PLAN, PARTICIPANT, CUSTOMER = "MCA", "PSA", "PCA", "IPA"
SOURCE = "TRAC"
SENTINEL_ICU_MCA = ("~", "00002", "-1")
PLAN_STATUS = {"src_cde": "TRAC", "src_tbl_nm": "DIM_PLAN", "src_fld_nm": "PLAN_STTS_CD",
               "trnslt_fld_nm": "STATUS CODE"}
PLAN_REASON = {**PLAN_STATUS, "trnslt_fld_nm": "STATUS REASON CODE"}
PARTICIPANT_STATUS = {"src_cde": "TRAC", "src_tbl_nm": "DIM_PARTICIPANT",
                      "src_fld_nm": "PARTCPNT_STTS_CD", "trnslt_fld_nm": "STATUS CODE"}
PARTICIPANT_REASON = {**PARTICIPANT_STATUS, "trnslt_fld_nm": "STATUS REASON CODE"}


def agreement_key(pfx, nr, sfx, source, type_):
    """The one agreement hash shared by the dimension and the bridges."""
    return hash_key(pfx, nr, sfx, source, type_)


def _derive_master(src, as_of):
    s = src.sponsor.filter(active() & real_icu(sentinels=SENTINEL_ICU_MCA))
    nr = composite_id("icu_id", int_text("spnsr_cmpny_id"))
    return s.select(
        agreement_key(blank(), nr, blank(), F.lit(SOURCE), F.lit(MASTER))
        .alias("dim_agreement_natural_key_hash_uuid"),
        nr.alias("agreement_nr"), F.lit(SOURCE).alias("agreement_source_cde"),
        F.lit(MASTER).alias("agreement_type_cde"), nr.alias("master_contract_group_id"),
        int_text("spnsr_cmpny_id").alias("sponsor_id"), clean_string("icu_id").alias("icu_id"),
        clean_string("spnsr_cmpny_nm").alias("master_contract_group_nm_national_desc"),
        row_checksum(nr, as_text("spnsr_cmpny_id"), *[blank()] * 3, "icu_id", "spnsr_cmpny_nm",
                     *[blank()] * 28).alias("check_sum"),
        *[v.alias(k) for k, v in bounds("rcrd_effctv_dt", "rcrd_trm_dt", None, None).items()],
    )


def _plan_status(df, tr, status, reason, exact=()):
    df = translate_code(df, "_status_src", tr, status, "_status", match="clean", exact=exact)
    return translate_code(df, "_status_src", tr, reason, "_reason", match="clean", exact=exact)


def _derive_plan(src, as_of):
    p = src.plan.alias("p")
    s = src.sponsor.select("icu_id", "spnsr_cmpny_id", "spnsr_cmpny_nm",
                           F.col("actv_rcrd_ind").alias("_spn_actv"))
    df = p.join(s, ["icu_id", "spnsr_cmpny_id"], "left")
    df = df.filter(active() & active("_spn_actv") & real_icu(sentinels=SENTINEL_ICU_MCA))
    df = _plan_status(df.withColumn("_status_src", F.col("plan_stts_cd")), src.translation,
                      PLAN_STATUS, PLAN_REASON)
    nr = composite_id("icu_id", int_text("spnsr_cmpny_id"), "plan_id")
    mcg = composite_id("icu_id", int_text("spnsr_cmpny_id"))
    return df.select(
        agreement_key(blank(), nr, blank(), F.lit(SOURCE), F.lit(PLAN))
        .alias("dim_agreement_natural_key_hash_uuid"),
        nr.alias("agreement_nr"), F.lit(SOURCE).alias("agreement_source_cde"),
        F.lit(PLAN).alias("agreement_type_cde"), mcg.alias("master_contract_group_id"),
        int_text("spnsr_cmpny_id").alias("sponsor_id"), clean_string("plan_id").alias("plan_id"),
        clean_string("icu_id").alias("icu_id"),
        clean_string("spnsr_cmpny_nm").alias("master_contract_group_nm_national_desc"),
        clean_string("plan_nm").alias("plan_nm_1_txt"), clean_string("plan_nm_2").alias("plan_nm_2_txt"),
        clean_string("plan_nm_3").alias("plan_nm_3_txt"),
        clean_string("_status").alias("agreement_status_cde"),
        clean_string("_reason").alias("agreement_status_reason_cde"),
        F.col("dflt_vlntry_dfrrl_pct").alias("default_voluntary_deferral_rt"),
        clean_string("intrnl_plan_id").alias("internal_plan_id"),
        F.col("pre_tax_cntrbtn_incrs_rt").alias("pre_tax_auto_increase_contribution_rt"),
        row_checksum(nr, as_text("spnsr_cmpny_id"), "plan_id", blank(), blank(), "icu_id",
                     "spnsr_cmpny_nm", "plan_nm", "plan_nm_2", "plan_nm_3", blank(), "_status",
                     "_reason", *[blank()] * 6, "dflt_vlntry_dfrrl_pct", *[blank()] * 4,
                     blank(), blank(), blank(), "intrnl_plan_id", *[blank()] * 6,
                     "pre_tax_cntrbtn_incrs_rt").alias("check_sum"),
        *[v.alias(k) for k, v in bounds("rcrd_effctv_dt", "rcrd_trm_dt", None, None).items()],
    )


def _derive_participant(src, as_of):
    prt = src.participant.select(
        "icu_id", "spnsr_cmpny_id", "plan_id", "prtcpnt_id", "prtcpnt_stts_cd", "intrnl_plan_id",
        "plan_enrllmnt_dt", "actv_rcrd_ind", "rcrd_effctv_dt", "rcrd_trm_dt")
    pl = src.plan.select("icu_id", "spnsr_cmpny_id", "plan_id", "plan_nm", "plan_nm_2", "plan_nm_3",
                         "dflt_vlntry_dfrrl_pct", "pre_tax_cntrbtn_incrs_rt",
                         F.col("actv_rcrd_ind").alias("_plan_actv"))
    s = src.sponsor.select("icu_id", "spnsr_cmpny_id", "spnsr_cmpny_nm",
                           F.col("actv_rcrd_ind").alias("_spn_actv"))
    df = prt.join(pl, ["icu_id", "spnsr_cmpny_id", "plan_id"], "left") \
            .join(s, ["icu_id", "spnsr_cmpny_id"], "left")
    df = df.filter(active("_plan_actv") & active("_spn_actv") & active() & real_icu())
    df = _plan_status(df.withColumn("_status_src", F.col("prtcpnt_stts_cd")), src.translation,
                      PARTICIPANT_STATUS, PARTICIPANT_REASON, exact=("src_tbl_nm",))
    nr = composite_id("icu_id", int_text("spnsr_cmpny_id"), "plan_id", "prtcpnt_id")
    mcg = composite_id("icu_id", int_text("spnsr_cmpny_id"))
    return df.select(
        agreement_key(blank(), nr, blank(), F.lit(SOURCE), F.lit(PARTICIPANT))
        .alias("dim_agreement_natural_key_hash_uuid"),
        nr.alias("agreement_nr"), F.lit(SOURCE).alias("agreement_source_cde"),
        F.lit(PARTICIPANT).alias("agreement_type_cde"), mcg.alias("master_contract_group_id"),
        int_text("spnsr_cmpny_id").alias("sponsor_id"), clean_string("plan_id").alias("plan_id"),
        clean_string("prtcpnt_id").alias("participant_id"), clean_string("icu_id").alias("icu_id"),
        clean_string("spnsr_cmpny_nm").alias("master_contract_group_nm_national_desc"),
        clean_string("plan_nm").alias("plan_nm_1_txt"), clean_string("plan_nm_2").alias("plan_nm_2_txt"),
        clean_string("plan_nm_3").alias("plan_nm_3_txt"),
        clean_string("_status").alias("agreement_status_cde"),
        clean_string("_reason").alias("agreement_status_reason_cde"),
        F.col("dflt_vlntry_dfrrl_pct").alias("default_voluntary_deferral_rt"),
        F.col("plan_enrllmnt_dt").alias("enrollment_dt"),
        clean_string("intrnl_plan_id").alias("internal_plan_id"),
        F.col("pre_tax_cntrbtn_incrs_rt").alias("pre_tax_auto_increase_contribution_rt"),
        row_checksum(mcg, as_text("spnsr_cmpny_id"), "plan_id", blank(), "prtcpnt_id", "icu_id",
                     "spnsr_cmpny_nm", "plan_nm", "plan_nm_2", "plan_nm_3", blank(), "_status",
                     "_reason", *[blank()] * 6, "dflt_vlntry_dfrrl_pct", "plan_enrllmnt_dt",
                     *[blank()] * 3, blank(), blank(), blank(), "intrnl_plan_id", *[blank()] * 6,
                     "pre_tax_cntrbtn_incrs_rt").alias("check_sum"),
        *[v.alias(k) for k, v in bounds("rcrd_effctv_dt", "rcrd_trm_dt", None, None).items()],
    )


LOAD_AGREEMENT_SPONSOR = LoadSpec("agreement_sponsor", T.AGREEMENT, AGREEMENT_KEY, _derive_master)
LOAD_AGREEMENT_PLAN = LoadSpec("agreement_plan", T.AGREEMENT, AGREEMENT_KEY, _derive_plan)
LOAD_AGREEMENT_PARTICIPANT = LoadSpec("agreement_participant", T.AGREEMENT, AGREEMENT_KEY,
                                      _derive_participant)
AGREEMENT_LOADS = [LOAD_AGREEMENT_SPONSOR, LOAD_AGREEMENT_PLAN, LOAD_AGREEMENT_PARTICIPANT]


def _derive_customer(src, as_of):
    a = src.agreement_hist
    pfx, nr, sfx, source = (clean_string(c) for c in
                            ("hldg_key_pfx", "hldg_key", "hldg_key_sfx", "agreement_source_cd"))
    exp = expired("conversion_end_date", as_of)
    return a.select(
        agreement_key(pfx, nr, sfx, source, F.lit(CUSTOMER)).alias("dim_agreement_natural_key_hash_uuid"),
        pfx.alias("agreement_nr_pfx"), nr.alias("agreement_nr"), sfx.alias("agreement_nr_sfx"),
        source.alias("agreement_source_cde"), F.lit(CUSTOMER).alias("agreement_type_cde"),
        clean_string("hldg_stus").alias("agreement_status_cde"),
        clean_string("stus_rsn").alias("agreement_status_reason_cde"),
        exp.alias("conversion_expired_ind"),
        F.col("conversion_start_date").alias("conversion_eligibility_start_dt"),
        F.col("conversion_end_date").alias("conversion_eligibility_end_dt"),
        F.col("face_amount").alias("face_amt"), F.col("issue_dt"),
        row_checksum(*[blank()] * 11, clean_string("hldg_stus"), clean_string("stus_rsn"),
                     *[blank()] * 3, as_text(exp), "conversion_start_date", "conversion_end_date",
                     *[blank()] * 5, blank(), blank(), "face_amount", blank(), "issue_dt",
                     *[blank()] * 6).alias("check_sum"),
        *[v.alias(k) for k, v in bounds("agmt_hist_fr_dt", "agmt_hist_to_dt", None, None).items()],
    )


LOAD_CUSTOMER_AGREEMENT = LoadSpec("customer_agreement", T.AGREEMENT, AGREEMENT_KEY,
                                   _derive_customer, batch_name="Customer_to_CIP",
                                   source_system_id="205")
