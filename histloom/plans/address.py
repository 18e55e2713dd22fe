"""Address dimension from participant, beneficiary and employee rows (L07-L09).

The three loads append to one work table in order; a later load compares with
what the earlier ones wrote (``run_loads``) and, when a conformed address
history is passed, with that history through ``effective_target``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import blank, bounds, clean_string, hash_key, row_checksum
from ..operators.lookup import translate_code
from . import targets as T
from .spec import LoadSpec

ADDRESS_KEY = ("dim_address_natural_key_hash_uuid",)

# Translation filters for state and country codes.
STATE_CODE = {"src_cde": "TRAC", "src_fld_nm": "STT_CD", "trnslt_fld_nm": "STATE CODE"}
COUNTRY_CODE = {"src_cde": "TRAC", "src_fld_nm": "RSDNC_LCTN_CD", "trnslt_fld_nm": "COUNTRY CODE"}


# What an address is made of, with its dates.  Many participants share these, so rows are
# combined before codes are translated and keys hashed.
ADDRESS_COLUMNS = ("addrss_ln_1", "addrss_ln_2", "addrss_ln_3", "city_nm", "stt_cd", "rsdnc_lctn_cd", "zip_cd",
                   "zip_plus_4_cd", "rcrd_effctv_dt", "rcrd_trm_dt")


def with_state_country(df: DataFrame, translations: DataFrame) -> DataFrame:
    """Adds ``_state`` and ``_country`` translated from ``stt_cd`` and
    ``rsdnc_lctn_cd`` (codes compared upper-cased and trimmed)."""
    df = translate_code(df, "stt_cd", translations, STATE_CODE, "_state")
    return translate_code(df, "rsdnc_lctn_cd", translations, COUNTRY_CODE, "_country")


def address_parts():
    """The 11 parts of the address key, in key order."""
    return [blank(), clean_string("addrss_ln_1"), clean_string("addrss_ln_2"),
            clean_string("addrss_ln_3"), blank(), clean_string("city_nm"),
            clean_string("_state"), clean_string("zip_cd"), clean_string("zip_plus_4_cd"),
            blank(), clean_string("_country")]


def address_key():
    return hash_key(*address_parts())


def _derive_from(table: str):
    def derive(src, as_of):
        df = with_state_country(getattr(src, table).select(*ADDRESS_COLUMNS).distinct(), src.translation)
        p = address_parts()
        return df.select(
            address_key().alias("dim_address_natural_key_hash_uuid"),
            p[1].alias("address_street_1_txt"), p[2].alias("address_street_2_txt"),
            p[3].alias("address_street_3_txt"), p[5].alias("city_nm"), p[6].alias("state_cde"),
            p[7].alias("zip_cde"), p[8].alias("zip_6_9_cde"), p[10].alias("country_cde"),
            row_checksum(blank()).alias("check_sum"),
            *[v.alias(k) for k, v in bounds("rcrd_effctv_dt", "rcrd_trm_dt").items()],
        )
    return derive


LOAD_ADDRESS_PARTICIPANT = LoadSpec("address_participant", T.ADDRESS, ADDRESS_KEY,
                                    _derive_from("participant"))
LOAD_ADDRESS_BENEFICIARY = LoadSpec("address_beneficiary", T.ADDRESS, ADDRESS_KEY,
                                    _derive_from("beneficiary"))
LOAD_ADDRESS_EMPLOYEE = LoadSpec("address_employee", T.ADDRESS, ADDRESS_KEY,
                                 _derive_from("employee"))
ADDRESS_LOADS = [LOAD_ADDRESS_PARTICIPANT, LOAD_ADDRESS_BENEFICIARY, LOAD_ADDRESS_EMPLOYEE]
