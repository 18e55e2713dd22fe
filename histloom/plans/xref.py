"""Party cross-reference history (L14-L21): customer ids, tax ids and the
master id of each party.

Natural key: party hash, id type and source-system id, so a party keeps one
current row per id type (the original flagged one row per party across all
its ids).  Each load is compared with rows of its own id type."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (blank, bounds, clean_string, hash_key, join_text, prehash_value,
                         row_checksum)
from ..operators.history import fan_out
from ..operators.lookup import resolve_party
from . import targets as T
from .party import sponsor_party_id
from .spec import LoadSpec

XREF_KEY = ("dim_party_natural_key_hash_uuid", "party_id_type_cde", "sor_party_id")

# Id types read and written, and ICU ids that are not real.
PARTICIPANT_ID, BENEFICIARY_ID, EMPLOYEE_ID = "TRAC_PRTC_ID", "TRAC_BEN_ID", "TRAC_EMP_ID"
CUSTOMER_ID, TAX_ID_PERSON, TAX_ID_ENTITY, MASTER_ID = "TRAC_CUST_ID", "GOVT_ID_S", "GOVT_ID_T", "MSTR_PRTY_ID"
SENTINEL_ICU = ("00002", "-1")


def participant_sor():
    return clean_string(join_text("icu_id", "plan_id", "prtcpnt_id"))


def beneficiary_sor():
    return clean_string(join_text("icu_id", "plan_id", "prtcpnt_id", "bnfcry_id"))


def employee_sor():
    return clean_string(join_text("icu_id", "afflt_cmpny_id", "spnsr_cmpny_id", "emply_tax_id"))


def real_icu(col="icu_id", sentinels=SENTINEL_ICU):
    """ICU id present and not one of the placeholder ids."""
    c = clean_string(col)
    return c.isNotNull() & ~c.isin(*sentinels)


def active(col="actv_rcrd_ind"):
    """``upper(col) = 'Y'`` (no trim, as these loads compare)."""
    return F.coalesce(F.upper(col) == "Y", F.lit(False))


def _own_type_filter():
    return F.col("source_system_id") == "203"


def _xref_rows(df, sor_party_id, id_type):
    return df.select(
        hash_key("party_id").alias("dim_party_natural_key_hash_uuid"),
        F.col("party_id"),
        sor_party_id.alias("sor_party_id"),
        id_type.alias("party_id_type_cde"),
        row_checksum(blank()).alias("check_sum"),
        *[v.alias(k) for k, v in bounds("rcrd_effctv_dt", "rcrd_trm_dt", None, None).items()],
    )


def _customer_sor():
    return prehash_value(clean_string("cstmr_id_1"), clean_string("cstmr_id_2"))


def _derive_sponsor_master(src, as_of):
    s = src.sponsor.filter(active() & real_icu())
    pid = sponsor_party_id()
    return s.select(
        hash_key(pid).alias("dim_party_natural_key_hash_uuid"),
        hash_key(pid).alias("dim_prior_party_natural_key_hash_uuid"),
        pid.alias("party_id"), pid.alias("party_prior_id"),
        F.lit("").alias("sor_party_id"), F.lit(MASTER_ID).alias("party_id_type_cde"),
        row_checksum(blank()).alias("check_sum"),
        *[v.alias(k) for k, v in bounds("rcrd_effctv_dt", "rcrd_trm_dt", None, None).items()],
    )


def _derive_sponsor_tax(src, as_of):
    s = src.sponsor.filter(active() & real_icu() & clean_string("spnsr_cmpny_tax_id").isNotNull())
    pid = sponsor_party_id()
    return s.select(
        hash_key(pid).alias("dim_party_natural_key_hash_uuid"),
        pid.alias("party_id"),
        clean_string("spnsr_cmpny_tax_id").alias("sor_party_id"),
        F.lit(TAX_ID_ENTITY).alias("party_id_type_cde"),
        row_checksum(blank()).alias("check_sum"),
        *[v.alias(k) for k, v in bounds("rcrd_effctv_dt", "rcrd_trm_dt", None, None).items()],
    )


# -- three rounds: each source is joined to the cross-reference once and emits the
#    customer id and the tax id side by side.

def _person_ids(table, xref_type, sor_fn, tax_col):
    def derive(src, as_of):
        df = resolve_party(getattr(src, table).filter(active() & real_icu()), src.xref, xref_type, sor_fn())
        # a person has many contracts: one row of each id and period before ids fan out
        df = df.select("party_id", "cstmr_id_1", "cstmr_id_2", tax_col, "rcrd_effctv_dt", "rcrd_trm_dt").distinct()
        tax = clean_string(tax_col)
        both = clean_string("cstmr_id_1").isNotNull() & clean_string("cstmr_id_2").isNotNull()
        df = fan_out(df, [(both, {"_id": _customer_sor(), "_type": F.lit(CUSTOMER_ID)}),
                          (tax.isNotNull(), {"_id": tax, "_type": F.lit(TAX_ID_PERSON)})])
        return _xref_rows(df, F.col("_id"), F.col("_type"))
    return derive


def _round(name, derive):
    return LoadSpec(name, T.XREF, XREF_KEY, derive, target_filter=_own_type_filter)


XREF_ROUNDS = [
    [_round("xref_participant", _person_ids("participant", PARTICIPANT_ID, participant_sor, "prtcpnt_tax_id")),
     _round("xref_sponsor_master", _derive_sponsor_master), _round("xref_sponsor_tax", _derive_sponsor_tax)],
    [_round("xref_beneficiary", _person_ids("beneficiary", BENEFICIARY_ID, beneficiary_sor, "bnfcry_tax_id"))],
    [_round("xref_employee", _person_ids("employee", EMPLOYEE_ID, employee_sor, "emply_tax_id"))],
]
