"""Party dimension: one party per sponsor company (L13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import blank, bounds, clean_string, hash_key, int_text, prehash_value, row_checksum
from . import targets as T
from .spec import LoadSpec

PARTY_KEY = ("dim_party_natural_key_hash_uuid",)

# Fixed value: party id prefix of sponsor companies.
SPONSOR_ENTITY = "TRAC_ENTITY"


def sponsor_party_id(icu_id="icu_id", sponsor_id="spnsr_cmpny_id"):
    """Business id of a sponsor company as a party: ``TRAC_ENTITY|icu|sponsor``."""
    return prehash_value(F.lit(SPONSOR_ENTITY), icu_id, int_text(sponsor_id))


def _derive_party(src, as_of):
    s = src.sponsor
    pid = sponsor_party_id()
    name = clean_string("spnsr_cmpny_nm")
    return s.select(
        hash_key(pid).alias("dim_party_natural_key_hash_uuid"),
        pid.alias("party_id"),
        name.alias("full_nm"),
        row_checksum(blank(), blank(), blank(), name, *[blank()] * 18).alias("check_sum"),
        *[v.alias(k) for k, v in bounds("rcrd_effctv_dt", "rcrd_trm_dt").items()],
    )


LOAD_PARTY = LoadSpec("load_party", T.PARTY, PARTY_KEY, _derive_party)
