"""Party-agreement bridge (L25-L28): which party plays which role (group,
sponsor, participant, beneficiary) on which agreement.

Key: agreement, party and role hashes.  The role is part of the key, so the
four loads never share a key and run as one pass.  Sponsor and participant come from
one pass over the participants."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (blank, clean_string, composite_id, date_lit, hash_key, int_text, is_flag,
                         nullable_hash, row_checksum, to_dtm)
from ..operators.history import fan_out
from ..operators.lookup import product_lookup, product_subset, resolve_party, translate_code
from . import targets as T
from .agreement import MASTER, PARTICIPANT, SOURCE, agreement_key
from .party import sponsor_party_id
from .spec import LoadSpec
from .xref import active, beneficiary_sor, participant_sor

PARTY_AGREEMENT_KEY = ("dim_agreement_natural_key_hash_uuid", "dim_party_natural_key_hash_uuid",
                       "ref_party_role_natural_key_hash_uuid")

# Party roles and the role-category translation.
GROUP, SPONSOR, PARTICIPANT_ROLE, BENEFICIARY = "GRP", "SPNSR", "PTCP", "BENE"
ROLE_CATEGORY = {"src_cde": "TRAC", "src_tbl_nm": "DIM_PARTICIPANT", "src_fld_nm": "PRTCPNT_STTS_CD",
                 "trnslt_fld_nm": "ROLE CATEGORY"}


def _bridge(df, nr, type_, party_id, role, product=None, account=None, sub_role=None,
            checksum=None, begin=None, end=None):
    """Bridge row from the agreement number parts, party id and role code."""
    return df.select(
        agreement_key(blank(), nr, blank(), F.lit(SOURCE), F.lit(type_))
        .alias("dim_agreement_natural_key_hash_uuid"),
        hash_key(party_id).alias("dim_party_natural_key_hash_uuid"),
        hash_key(F.lit(role) if isinstance(role, str) else role).alias("ref_party_role_natural_key_hash_uuid"),
        (nullable_hash(sub_role) if sub_role is not None else blank())
        .alias("ref_party_sub_role_natural_key_hash_uuid"),
        (nullable_hash(product) if product is not None else blank())
        .alias("dim_product_natural_key_hash_uuid"),
        (account if account is not None else blank()).alias("dim_account_natural_key_hash_uuid"),
        checksum.alias("check_sum"),
        begin.cast("date").alias("begin_dt"), to_dtm(begin).alias("begin_dtm"),
        end.cast("date").alias("end_dt"), to_dtm(end).alias("end_dtm"),
    )


def _unbounded():
    return date_lit("0001-01-01"), date_lit("9999-12-31")


def _derive_group(src, as_of):
    s = src.sponsor.filter(active())
    c = (src.consent.filter(F.col("rcrd_trm_dt") == date_lit("9999-12-31"))
             .select(F.col("consent_cust_key").alias("spnsr_cmpny_key"),
                     F.col("client_id").alias("spnsr_cmpny_id"),
                     F.col("rcrd_effctv_dt").alias("_eff"), F.col("rcrd_trm_dt").alias("_trm")))
    df = s.join(c, ["spnsr_cmpny_key", "spnsr_cmpny_id"], "left")
    nr = composite_id(clean_string("icu_id"), clean_string(int_text("spnsr_cmpny_id")))
    return _bridge(df, nr, MASTER, sponsor_party_id(), GROUP,
                   checksum=row_checksum(blank(), blank(), blank()),
                   begin=F.coalesce(F.col("_eff"), _unbounded()[0]),
                   end=F.coalesce(F.col("_trm"), _unbounded()[1]))


def _with_plan(df, plan):
    pl = plan.select("icu_id", "plan_id", F.col("spnsr_cmpny_id").alias("_plan_spnsr"),
                     "plan_type_cd", F.col("actv_rcrd_ind").alias("_plan_actv"))
    return df.join(pl, ["icu_id", "plan_id"], "left")


def _derive_participant_roles(src, as_of):
    """Sponsor and participant role of every participant: the participants are joined
    to the cross-reference and the plans once, then each row gives the roles it has.
    The sponsor's product code is compared as it is, the participant's trimmed."""
    plan_type, status = F.col("plan_type_cd"), F.col("prtcpnt_stts_cd")
    df = resolve_party(src.participant, src.xref, "TRAC_PRTC_ID", participant_sor(), how="left")
    df = _with_plan(df, src.plan)
    df = fan_out(df, [
        (active("_plan_actv") & active(),
         {"_role": F.lit(SPONSOR), "_party": sponsor_party_id(), "_prod_key": F.upper(plan_type), "_status": blank()}),
        (is_flag("_plan_actv") & is_flag("actv_rcrd_ind") & F.col("party_id").isNotNull(),
         {"_role": F.lit(PARTICIPANT_ROLE), "_party": F.col("party_id"), "_prod_key": F.upper(F.trim(plan_type)),
          "_status": status})])
    products = product_subset(src.product, "_prod", trim_code=False).withColumn("_role", F.lit(SPONSOR)).unionByName(
        product_subset(src.product, "_prod", trim_code=True).withColumn("_role", F.lit(PARTICIPANT_ROLE)))
    df = df.join(products, ["_role", "_prod_key"], "left")
    df = translate_code(df, "_status", src.translation, ROLE_CATEGORY, "_sub_role")
    nr = composite_id("icu_id", int_text("spnsr_cmpny_id"), "plan_id", "prtcpnt_id")
    prod, sub, own = clean_string("_prod"), clean_string("_sub_role"), F.col("_role") == PARTICIPANT_ROLE
    parts = (F.lit(PARTICIPANT_ROLE), F.col("_party"), F.lit(SOURCE), F.lit(PARTICIPANT),
             blank(), nr, blank())
    return _bridge(df, nr, PARTICIPANT, F.col("_party"), F.col("_role"), product=prod,
                   account=F.when(own, hash_key(*parts)), sub_role=sub,
                   checksum=F.when(own, row_checksum(prod, *parts, sub))
                   .otherwise(row_checksum(prod, blank(), blank())),
                   begin=_unbounded()[0], end=_unbounded()[1])


def _derive_beneficiary_role(src, as_of):
    df = resolve_party(src.beneficiary, src.xref, "TRAC_BEN_ID", beneficiary_sor(),
                       clean_xref_side=True)
    df = _with_plan(df, src.plan).filter(is_flag("_plan_actv") & is_flag("actv_rcrd_ind"))
    df = product_lookup(df, "plan_type_cd", src.product, "_prod", trim_code=True)
    nr = composite_id("icu_id", int_text("_plan_spnsr"), "plan_id", "prtcpnt_id")
    prod = clean_string("_prod")
    return _bridge(df, nr, PARTICIPANT, F.col("party_id"), BENEFICIARY, product=prod,
                   checksum=row_checksum(prod, blank(), blank()),
                   begin=_unbounded()[0], end=_unbounded()[1])


PARTY_AGREEMENT_LOADS = [
    LoadSpec("party_agreement_group", T.PARTY_AGREEMENT, PARTY_AGREEMENT_KEY, _derive_group),
    LoadSpec("party_agreement_participant_roles", T.PARTY_AGREEMENT, PARTY_AGREEMENT_KEY,
             _derive_participant_roles),
    LoadSpec("party_agreement_beneficiary", T.PARTY_AGREEMENT, PARTY_AGREEMENT_KEY,
             _derive_beneficiary_role),
]
