"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Every query derives its inputs from the driver tables of ``sf_dir`` (see
``sources.fixtures``) and runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import account, address, agreement, contact, party, party_agreement, xref
from .plans.spec import checked_output, run_loads, run_rounds
from .sources.fixtures import PARTICIPANTS, PEOPLE, Sources, load_sources
from .sources.io import cut_lineage, cuts_made, release_cuts

#: The processing date of the registered queries (a run without one uses today's).
AS_OF = "2001-01-01"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _released(made: int, out: DataFrame) -> DataFrame:
    """``out``; of the cuts since ``made`` only those that it reads are left."""
    release_cuts(out.sparkSession, made, out)
    return out


def _loads(name, specs, independent=False, stored=()):
    """``stored``: stand-ins that the load reads, or derives others from, several times."""
    @register(name)
    def q(spark, sf_dir):
        made = cuts_made()
        src = load_sources(spark, sf_dir, stored)
        return _released(made, checked_output(run_loads(specs, src, as_of=AS_OF, independent=independent)))
    q.__name__ = f"q_{name}"
    q.__doc__ = f"History load ``{name}`` over the stand-in sources of ``sf_dir``."
    return q


_loads("load_party", [party.LOAD_PARTY])
_loads("load_account", [account.LOAD_ACCOUNT], stored=PARTICIPANTS)
_loads("load_address_all", address.ADDRESS_LOADS, stored=PARTICIPANTS)
_loads("load_agreement_sponsor", [agreement.LOAD_AGREEMENT_SPONSOR])
_loads("load_agreement_plan", [agreement.LOAD_AGREEMENT_PLAN])
_loads("load_agreement_participant", [agreement.LOAD_AGREEMENT_PARTICIPANT])
_loads("load_agreement_all", agreement.AGREEMENT_LOADS, independent=True)
_loads("load_customer_agreement", [agreement.LOAD_CUSTOMER_AGREEMENT])
_loads("load_customer_party_address", [contact.LOAD_CUSTOMER_PARTY_ADDRESS])
_loads("load_party_address_all", contact.PARTY_ADDRESS_LOADS, stored=PARTICIPANTS)
_loads("load_party_email", [contact.LOAD_PARTY_EMAIL])
_loads("load_party_phone_all", [contact.LOAD_PARTY_PHONE])
_loads("load_phone_by_number", [contact.LOAD_PHONE_BY_NUMBER])
_loads("load_party_agreement_all", party_agreement.PARTY_AGREEMENT_LOADS, independent=True, stored=PARTICIPANTS)


def _incremental(name, specs, change, independent=False, stored=()):
    """Three batches: base, changed sources, the same sources again.  Batch 2
    updates what changed; batch 3 must not update anything."""
    @register(name)
    def q(spark, sf_dir):
        start = cuts_made()
        src = load_sources(spark, sf_dir, stored)
        changed = Sources({**src.frames, **change(src)})
        history, out = None, None
        for number, batch in enumerate((src, changed, changed), 1):
            made = cuts_made()
            new = _released(made, cut_lineage(run_loads(
                specs, batch, history, AS_OF, F.lit(f"2001-01-0{number} 06:00:00"), independent=independent)))
            history = new if history is None else history.unionByName(new)
            rows = checked_output(new).withColumn("batch_no", F.lit(number))
            out = rows if out is None else out.unionByName(rows)
        return _released(start, out)
    q.__name__ = f"q_{name}"
    return q


_incremental("load_party_incremental", [party.LOAD_PARTY], lambda src: {"src_sponsor": src.sponsor.withColumn(
    "spnsr_cmpny_nm", F.when(F.col("spnsr_cmpny_key") % 3 == 0, F.concat("spnsr_cmpny_nm", F.lit("II")))
    .otherwise(F.col("spnsr_cmpny_nm")))})
_incremental("load_agreement_incremental", [agreement.LOAD_CUSTOMER_AGREEMENT],
             lambda src: {"src_agreement_hist": src.agreement_hist.withColumn(
                 "hldg_stus", F.concat("hldg_stus", F.lit("2")))})
_incremental("load_address_incremental", address.ADDRESS_LOADS, lambda src: {
    "src_participant": src.participant.withColumn("addrss_ln_2", F.concat("addrss_ln_2", F.lit(" II")))},
    stored=PEOPLE)
_incremental("load_account_incremental", [account.LOAD_ACCOUNT], lambda src: {
    "src_employee": src.employee.withColumn("hire_dt", F.date_add("hire_dt", 1))},
    stored=PEOPLE)


@register("load_party_xref_all")
def q_load_party_xref_all(spark, sf_dir):
    """The eight cross-reference loads in three rounds: a source is joined to the
    cross-reference once, id types side by side (they never share a key)."""
    made = cuts_made()
    src = load_sources(spark, sf_dir, PARTICIPANTS)
    return _released(made, checked_output(run_rounds(xref.XREF_ROUNDS, src, as_of=AS_OF)))


from . import catalog_ops, catalog_stored  # noqa: E402,F401  (register the operator-level queries)
