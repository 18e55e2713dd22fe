"""Sponsor and participant roles in one pass, and a current flag over part of the key."""

import pytest
from pyspark.sql import functions as F

from histloom.functions import blank, clean_string, composite_id, hash_key, int_text, is_flag, row_checksum
from histloom.operators.lookup import product_lookup, resolve_party, translate_code
from histloom.plans import contact
from histloom.plans import party_agreement as pa
from histloom.plans.party import sponsor_party_id
from histloom.plans.spec import run_loads
from histloom.plans.xref import active, participant_sor
from histloom.sources.fixtures import Sources

AS_OF = "2001-01-01"


def _apart(src, role):
    """One role by joins of its own: (party, agreement number, product, sub role, row checksum)."""
    df = src.participant
    if role == pa.PARTICIPANT_ROLE:
        df = resolve_party(df, src.xref, "TRAC_PRTC_ID", participant_sor())
    own = role == pa.PARTICIPANT_ROLE
    df = pa._with_plan(df, src.plan)
    df = df.filter((is_flag("_plan_actv") & is_flag("actv_rcrd_ind")) if own else (active("_plan_actv") & active()))
    df = product_lookup(df, "plan_type_cd", src.product, "_prod", trim_code=own)
    nr = composite_id("icu_id", int_text("spnsr_cmpny_id"), "plan_id", "prtcpnt_id")
    prod = clean_string("_prod")
    if own:
        df = translate_code(df, "prtcpnt_stts_cd", src.translation, pa.ROLE_CATEGORY, "_sub_role")
        parts = (F.lit(role), F.col("party_id"), F.lit(pa.SOURCE), F.lit(pa.PARTICIPANT), blank(), nr, blank())
        who, check = F.col("party_id"), row_checksum(prod, *parts, clean_string("_sub_role"))
    else:
        who, check = sponsor_party_id(), row_checksum(prod, blank(), blank())
    return {tuple(r) for r in df.select(hash_key(who), hash_key(F.lit(role)), check).collect()}


def test_roles_of_one_pass_equal_separate_passes(spark, src):
    """With flags and codes that only one role takes, parties found twice and not at all."""
    key = F.xxhash64("icu_id", "plan_id", "prtcpnt_id")
    bent = Sources({**src.frames,
        "src_participant": src.participant.withColumn("actv_rcrd_ind", F.when(key % 5 == 0, F.lit(" y "))
            .when(key % 5 == 1, F.lit(None)).otherwise(F.col("actv_rcrd_ind"))),
        "src_plan": src.plan.withColumn("plan_type_cd", F.when(F.xxhash64("plan_id") % 2 == 0,
            F.concat("plan_type_cd", F.lit(" "))).otherwise(F.col("plan_type_cd"))),
        "src_xref": src.xref.filter(F.xxhash64("sor_party_id") % 4 != 0).unionByName(
            src.xref.filter(F.xxhash64("sor_party_id") % 4 == 1).withColumn("party_id", F.concat("party_id", F.lit("2"))))})
    got = {tuple(r) for r in pa._derive_participant_roles(bent, AS_OF).select(
        "dim_party_natural_key_hash_uuid", "ref_party_role_natural_key_hash_uuid", "check_sum").collect()}
    sponsors, participants = _apart(bent, pa.SPONSOR), _apart(bent, pa.PARTICIPANT_ROLE)
    assert sponsors and participants and got == sponsors | participants


def test_participants_are_read_once(spark, src, tmp_path):
    stored = src.materialize(spark, str(tmp_path))
    plan = pa._derive_participant_roles(stored, AS_OF)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert [sum(c in s for s in scans) for c in ("prtcpnt_stts_cd", "plan_type_cd", "sor_party_id")] == [1, 1, 1]


def test_flag_over_part_of_the_key(spark, src):
    rows = run_loads([contact.LOAD_PHONE_BY_NUMBER], src, as_of=AS_OF)
    whole = run_loads([contact.LOAD_PARTY_PHONE], src, as_of=AS_OF)
    assert rows.count() == whole.count()
    current = rows.filter("current_row_ind")
    worst = current.groupBy(*contact.PARTY_PHONE_KEY[:2]).count().agg(F.max("count")).first()[0]
    assert worst == 1 and whole.filter("current_row_ind").count() > current.count() > 0


def test_one_round_has_one_flag(spark, src):
    with pytest.raises(ValueError):
        run_loads([contact.LOAD_PARTY_PHONE, contact.LOAD_PHONE_BY_NUMBER], src, independent=True)
