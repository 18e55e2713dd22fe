"""Balances and rollover flag: the contracts of one large plan, behind a sort-merge
join on the plan, are dealt over the tasks of the aggregate; results against plain
Python, with NULL keys, NULL amounts and repeated rows."""

from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from histloom import catalog
from histloom.plans import account
from histloom.sources.fixtures import Sources, use_sources

ASSET = ("plan_id string, prtcpnt_id string, asst_pstn_amt decimal(18,2), shr_blnc_amt decimal(18,2), "
         "src_cd int")


def _rows():
    """(plan, participant, cash, shares, source); nine tenths are of plan 'hot'."""
    out = []
    for i in range(4000):
        plan = f"p{i % 7}" if i % 10 == 0 else "hot"
        who = None if i % 97 == 0 else str(i % 1300)
        cash = None if i % 11 == 0 else Decimal(i % 501) / 100
        out.append((plan, who, cash, None if who == "5" else Decimal(i), 120 + i % 17 if i % 3 else None))
    return out + out[:200]


@pytest.fixture
def asset(spark):
    """Asset rows as a source builds them: joined to the plans by a sort-merge join."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    plans = spark.createDataFrame([("hot", None), *[(f"p{i}", f"0{i}") for i in range(7)]], "plan_id string, icu_id string")
    yield spark.createDataFrame(_rows(), ASSET).join(plans, "plan_id").select(
        *account.CONTRACT, "asst_pstn_amt", "shr_blnc_amt", "src_cd")
    spark.conf.set(key, old)


def _icu(plan):
    return None if plan == "hot" else f"0{plan[1:]}"


def _total(values):
    values = [v for v in values if v is not None]
    return sum(values) if values else None


def _groups_per_task(df):
    """Rows of each task of the stage that makes ``df`` (empty tasks are left out)."""
    t = df.groupBy(F.spark_partition_id().alias("t"))
    return [r.n for r in t.agg(F.count(F.lit(1)).alias("n"), F.max(F.hash(*df.columns))).collect()]


def test_contracts_of_one_plan_are_dealt_over_tasks(spark, asset):
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = _groups_per_task(account.balance_totals(asset))
    assert len(groups) == n
    assert max(groups) < 2 * sum(groups) / n


def test_balance_totals_match_plain_sums(spark, asset):
    use_sources(spark, "balances", Sources({"src_asset": asset}))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in catalog.QUERIES["balance_totals"](spark, "balances").collect()}
    cash, shares = defaultdict(list), defaultdict(list)
    for plan, who, c, s, _ in _rows():
        cash[_icu(plan), plan, who].append(c)
        shares[_icu(plan), plan, who].append(s)
    assert got == {k: (_total(cash[k]), _total(shares[k])) for k in cash}


def test_rollover_flags_match_plain_rows(spark, asset):
    """Dealt as the totals are; a NULL in the key matches nothing."""
    participants = [(_icu(p), p, w) for p, w in sorted({(r[0], r[1] or "none") for r in _rows()})] * 2
    own = spark.createDataFrame(participants, "icu_id string, plan_id string, prtcpnt_id string")
    keyed = asset.withColumn("icu_id", F.coalesce("icu_id", F.lit("00")))
    use_sources(spark, "rollover", Sources({"src_asset": keyed, "src_participant": own.fillna("00", ["icu_id"])}))
    df = catalog.QUERIES["rollover_flag"](spark, "rollover")
    marked = {(p, w) for p, w, _, _, s in _rows() if w is not None and s in account.ROLLOVER_SOURCES}
    assert sorted(tuple(r) for r in df.collect()) == sorted(
        (i or "00", p, w, (p, w) in marked) for i, p, w in participants)
    assert len(_groups_per_task(df)) == 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
