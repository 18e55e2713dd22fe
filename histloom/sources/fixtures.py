"""Stand-in source tables derived from the driver's parquet tables.

The reference loads read private warehouse tables (sponsor, plan, participant,
cross-reference, ...).  Each stand-in below is one portable SQL statement over
the driver's TPC-H style tables that runs unchanged in Spark SQL and DuckDB:
Spark registers them as temporary views, the DuckDB oracle inlines them as
CTEs.  They only shape rows into the schema a load expects; all load logic
lives in ``histloom.operators`` / ``histloom.plans``.

``{name}`` placeholders stand for relations: driver tables and earlier
stand-ins.  Spark fills them with session-unique view names, DuckDB with the
plain names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .io import cut_lineage

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# name -> SQL text; order matters (later ones read earlier ones).
FIXTURE_SQL: dict[str, str] = {
    "src_sponsor": """
select s_suppkey as spnsr_cmpny_key, cast(s_suppkey as int) as spnsr_cmpny_id,
 lpad(cast(s_nationkey as string),5,'0') as icu_id, concat(' ',s_name,' ') as spnsr_cmpny_nm,
 case when s_suppkey%7=0 then '  ' else concat('T',cast(s_suppkey as string)) end as spnsr_cmpny_tax_id,
 case when s_suppkey%5=0 then 'N' when s_suppkey%2=0 then 'y' else 'Y' end as actv_rcrd_ind,
 date '1995-01-01' + cast(s_suppkey%365 as int) as rcrd_effctv_dt,
 case when s_suppkey%11=0 then cast(null as date) when s_suppkey%4=0 then date '2000-12-31' else date '9999-12-31' end as rcrd_trm_dt
from {supplier}""",
    "src_plan": """
select s.icu_id, s.spnsr_cmpny_id, cast(p.p_partkey as string) as plan_id, p.p_name as plan_nm,
 p.p_brand as plan_nm_2, case when p.p_partkey%3=0 then ' ' else p.p_type end as plan_nm_3, p.p_type as plan_type_cd,
 p.p_brand as plan_stts_cd, concat('I',cast(p.p_size as string)) as intrnl_plan_id,
 cast(p.p_size%10 as decimal(9,4)) as dflt_vlntry_dfrrl_pct, cast(p.p_size%4 as decimal(9,4)) as pre_tax_cntrbtn_incrs_rt,
 cast(p.p_size%3 as decimal(9,4)) as qlfd_plan_incptn_rt,
 case when p.p_partkey%17=0 then 'N' else 'Y' end as actv_rcrd_ind,
 date '1995-01-01' + cast(p.p_partkey%365 as int) as rcrd_effctv_dt, date '9999-12-31' as rcrd_trm_dt
from (select {part}.*, p_partkey % (select count(*) from {supplier}) as sup from {part}) p
join {src_sponsor} s on s.spnsr_cmpny_key = p.sup""",
    "src_participant": """
select pl.icu_id, pl.spnsr_cmpny_id, pl.plan_id, cast(g.o_custkey as string) as prtcpnt_id,
 cast(c.c_nationkey as string) as afflt_cmpny_id, concat('E',cast(g.o_custkey as string)) as emply_tax_id,
 case when g.o_custkey%9=0 then '' else concat('E',cast(g.o_custkey as string)) end as prtcpnt_tax_id,
 cast(g.o_custkey as string) as cstmr_id_1, case when g.o_custkey%10=0 then ' ' else cast(c.c_nationkey as string) end as cstmr_id_2,
 concat(c.c_name,' ') as addrss_ln_1, c.c_mktsegment as addrss_ln_2, cast(null as string) as addrss_ln_3, n.n_name as city_nm,
 lower(c.c_mktsegment) as stt_cd, concat(' ',lower(n.n_name)) as rsdnc_lctn_cd,
 lpad(cast(g.o_custkey%1000 as string),5,'0') as zip_cd, '' as zip_plus_4_cd, g.stts as prtcpnt_stts_cd, g.stts as emply_stts_cd,
 pl.intrnl_plan_id, g.first_dt as plan_enrllmnt_dt, cast(null as date) as sspnd_strt_dt, cast(null as date) as sspnd_end_dt,
 case when g.o_custkey%19=0 then 'n' else 'y' end as actv_rcrd_ind, g.first_dt as rcrd_effctv_dt,
 case when g.o_custkey%6=0 then g.last_dt when g.o_custkey%8=0 then cast(null as date) else date '9999-12-31' end as rcrd_trm_dt
from (select o_custkey, l_partkey, cast(min(o_orderdate) as date) as first_dt, cast(max(o_orderdate) as date) as last_dt,
             max(o_orderstatus) as stts
      from {lineitem} join {orders} on l_orderkey=o_orderkey group by o_custkey, l_partkey) g
join {customer} c on c.c_custkey=g.o_custkey join {nation} n on n.n_nationkey=c.c_nationkey
join {src_plan} pl on pl.plan_id=cast(g.l_partkey as string)""",
    "src_beneficiary": """
select icu_id, plan_id, prtcpnt_id, '1' as bnfcry_id, concat('B',prtcpnt_id) as bnfcry_tax_id, concat('B',cstmr_id_1) as cstmr_id_1,
 cstmr_id_2, addrss_ln_1, addrss_ln_2, addrss_ln_3, city_nm, stt_cd, rsdnc_lctn_cd, zip_cd, zip_plus_4_cd,
 case when plan_enrllmnt_dt < date '1996-01-01' then 'N' else actv_rcrd_ind end as actv_rcrd_ind, rcrd_effctv_dt, rcrd_trm_dt
from {src_participant}""",
    "src_employee": """
select icu_id, afflt_cmpny_id, spnsr_cmpny_id, emply_tax_id, min(cstmr_id_1) as cstmr_id_1, min(cstmr_id_2) as cstmr_id_2,
 min(addrss_ln_1) as addrss_ln_1, 'EMPLOYEE' as addrss_ln_2, min(addrss_ln_3) as addrss_ln_3, min(city_nm) as city_nm, min(stt_cd) as stt_cd,
 min(rsdnc_lctn_cd) as rsdnc_lctn_cd, min(zip_cd) as zip_cd, min(zip_plus_4_cd) as zip_plus_4_cd, min(rcrd_effctv_dt) as hire_dt,
 case when min(cast(prtcpnt_id as int))%2=0 then 'Y' else 'N' end as hce_ind, 'N' as key_emply_ind,
 max(actv_rcrd_ind) as actv_rcrd_ind, min(rcrd_effctv_dt) as rcrd_effctv_dt, max(rcrd_trm_dt) as rcrd_trm_dt
from {src_participant} group by icu_id, afflt_cmpny_id, spnsr_cmpny_id, emply_tax_id""",
    "src_asset": """
select pl.icu_id, pl.plan_id, cast(o_custkey as string) as prtcpnt_id, cast(l_extendedprice as decimal(18,2)) as asst_pstn_amt,
 cast(l_quantity as decimal(18,2)) as shr_blnc_amt, 125+l_linenumber as src_cd
from {lineitem} join {orders} on l_orderkey=o_orderkey join {src_plan} pl on pl.plan_id=cast(l_partkey as string)""",
    "src_enrollment": """
select pl.icu_id, pl.plan_id, cast(o_custkey as string) as prtcpnt_id, l_orderkey*10+l_linenumber as vru_enrllmnt_stts_key,
 o_orderstatus as enrllmnt_stts_cd, case when l_linenumber%3=0 then 'x' when l_linenumber%3=1 then 'y' else 'N' end as pre_tax_auto_incrs_elctd_ind,
 cast(l_extendedprice as decimal(18,2)) as pre_tax_enrllmnt_amt, cast(l_discount as decimal(9,4)) as pre_tax_enrllmnt_rt,
 cast(l_quantity as decimal(18,2)) as post_tax_enrllmnt_amt, cast(l_tax as decimal(9,4)) as post_tax_enrllmnt_rt,
 cast(null as decimal(18,2)) as roth_elctv_dfrrl_enrllmnt_amt, cast(l_linenumber as decimal(9,4)) as roth_elctv_dfrrl_enrllmnt_rt,
 cast(null as date) as eaca_opt_out_dt, cast(l_shipdate as date) as eaca_strt_dt, l_linestatus as qaca_prtcpnt_ind,
 cast(l_shipdate as date) as qaca_opt_out_dt, cast(l_shipdate as date) + 365 as qaca_next_incrs_dt,
 case when l_returnflag='A' then ' y' else l_returnflag end as eaca_prtcpnt_ind, case when o_orderkey%12=0 then 'N' else 'Y' end as actv_rcrd_ind,
 cast(o_orderdate as date) as rcrd_effctv_dt, cast(null as date) as rcrd_trm_dt
from {lineitem} join {orders} on l_orderkey=o_orderkey join {src_plan} pl on pl.plan_id=cast(l_partkey as string)""",
    "src_xref": """
select distinct concat('P',prtcpnt_id) as party_id, concat(icu_id,'_',plan_id,'_',prtcpnt_id) as sor_party_id, 'TRAC_PRTC_ID' as party_id_type_cde,
 cast(prtcpnt_id as int)%13=0 as logical_delete_ind from {src_participant}
union all select distinct concat('B',prtcpnt_id), concat(icu_id,'_',plan_id,'_',prtcpnt_id,'_',bnfcry_id), 'TRAC_BEN_ID', false from {src_beneficiary}
union all select distinct concat('P',substring(emply_tax_id,2)), concat(icu_id,'_',afflt_cmpny_id,'_',cast(spnsr_cmpny_id as string),'_',emply_tax_id), 'TRAC_EMP_ID', false from {src_employee}
union all select concat('P',cast(c_custkey as string)), concat(cast(c_custkey as string),'|',cast(c_nationkey as string)), 'TRAC_CUST_ID', c_custkey%13=0 from {customer}
union all select concat('P',cast(c_custkey as string)), cast(c_custkey as string), 'TD_PRTY_ID', false from {customer}
union all select concat('P',cast(c_custkey as string)), cast(c_custkey as string), 'BP_ID', false from {customer}""",
    "src_translation": """
select 'TRAC' as src_cde, 'DIM_PARTICIPANT' as src_tbl_nm, 'RSDNC_LCTN_CD' as src_fld_nm, n_name as src_fld_val, 'COUNTRY CODE' as trnslt_fld_nm,
 concat('C',cast(n_nationkey as string)) as trnslt_fld_val from {nation} where n_regionkey<>0
union all select 'PARTY','PARTY','CNTRY_NM', n_name, 'COUNTRY NAME', n_name from {nation}
union all select distinct 'trac','DIM_PARTICIPANT','STT_CD', c_mktsegment, 'STATE CODE', substring(c_mktsegment,1,2) from {customer}
union all select distinct 'TRAC','DIM_PLAN','PLAN_STTS_CD', p_brand, 'STATUS CODE', concat('C',p_brand) from {part}
union all select distinct 'TRAC','DIM_PLAN','PLAN_STTS_CD', p_brand, 'STATUS REASON CODE', concat('R',p_brand) from {part}
union all select distinct 'TRAC','DIM_PARTICIPANT','PARTCPNT_STTS_CD', o_orderstatus, 'STATUS CODE', concat('ST',o_orderstatus) from {orders}
union all select distinct 'TRAC','DIM_PARTICIPANT','PARTCPNT_STTS_CD', o_orderstatus, 'STATUS REASON CODE', concat('SR',o_orderstatus) from {orders}
union all select distinct 'TRAC','DIM_PARTICIPANT','PRTCPNT_STTS_CD', o_orderstatus, 'ROLE CATEGORY', concat('RO',o_orderstatus) from {orders}
union all select distinct 'TRAC','DIM_PARTICIPANT','EMPLOYEE_STTS_CD', o_orderstatus, 'EMPLOYEE STATUS CODE', concat('EM',o_orderstatus) from {orders}""",
    "src_product": """
select distinct p_type as knd_min_cde, 'trac' as admn_sys_cde, concat('PROD',cast(length(p_type) as string)) as prod_id
from {part} where p_size>5 or p_type is not null""",
    "src_consent": """
select c_custkey as consent_cust_key, cast(c_custkey as int) as client_id, cast(c_custkey as string) as customer_id1, cast(c_nationkey as string) as customer_id2,
 case when c_custkey%14=0 then ' ' else concat(lower(c_name),'@example.org') end as stm_eml_adr_txt, case when c_custkey%4=0 then 'N' else ' y' end as actv_rcrd_ind,
 date '1996-01-01' + cast(c_custkey%365 as int) as rcrd_effctv_dt, case when c_custkey%5=0 then date '1999-06-30' else date '9999-12-31' end as rcrd_trm_dt
from {customer}""",
    "src_agreement_hist": """
select case when o_orderkey%3=0 then '' else substring(o_orderpriority,1,1) end as hldg_key_pfx, cast(o_custkey as string) as hldg_key,
 cast(null as string) as hldg_key_sfx, 'ORD' as agreement_source_cd, o_orderstatus as hldg_stus, o_orderpriority as stus_rsn,
 cast(o_totalprice as decimal(18,2)) as face_amount, cast(o_orderdate as date) as issue_dt, cast(o_orderdate as date) as conversion_start_date,
 cast(o_orderdate as date) + 365 as conversion_end_date, cast(o_orderdate as date) as agmt_hist_fr_dt,
 coalesce(cast(lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as date), date '9999-12-31') as agmt_hist_to_dt
from {orders}""",
    "src_customer_agreement_hist": """
select cast(o_custkey as string) as prty_id, concat('ATTN ',c_name) as attn_line, c_name as ad_l1_txt, c_mktsegment as ad_l2_txt, '' as ad_l3_txt,
 cast(null as string) as ad_l4_txt, n_name as city, substring(n_name,1,2) as state, lpad(cast(o_custkey%1000 as string),5,'0') as zip_1_5_nr,
 '' as zip_6_9_nr, '' as zip_10_13_nr, concat(n_name,' ') as ctry_cd,
 case when o_orderkey%2=0 then cast(null as string) else substring(o_orderpriority,1,1) end as ad_typ_cd, cast(o_orderdate as date) as cust_agmt_hist_fr_dt,
 coalesce(cast(lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as date), date '9999-12-31') as cust_agmt_hist_to_dt
from {orders} join {customer} on o_custkey=c_custkey join {nation} on c_nationkey=n_nationkey""",
    "src_demographics_hist": """
select concat(cast(c_custkey as string),' ') as business_partner_id, '1' as preftel_ctry_cd_nr, lpad(cast(c_custkey as string),10,'5') as preftel_nr_10digit,
 cast(null as string) as preftel_xtn_nr, '1' as restel_ctry_cd_nr, case when c_custkey%3=0 then ' ' else lpad(cast(c_custkey as string),10,'6') end as restel_nr_10digit,
 cast(c_custkey%100 as string) as restel_xtn_nr, '' as prefax_tel_ctry_cd_nr, lpad(cast(c_custkey%50 as string),10,'7') as prefax_tel_nr_10digit,
 case when c_custkey%4=0 then cast(null as date) else date '1996-01-01' + cast(c_custkey%365 as int) end as pdcr_hist_fr_dt,
 case when c_custkey%5=0 then cast(null as date) when c_custkey%7=0 then date '2000-01-01' else date '9999-12-31' end as pdcr_hist_to_dt
from {customer}""",
    "src_audit": """
select audit_id, batch_name, 1 as record_aligner from (
 select 42 as audit_id, 'Trac_to_CIP' as batch_name union all select 43, 'Customer_to_CIP' union all select 44, 'Producer_to_CIP') a""",
    "src_steps": """
select case when s_nationkey%2=0 then ' TRAC ' else 'trac' end as source_cd,
 case when s_suppkey%3=0 then 'DIM_PLAN' else 'Dim_Party' end as work_table, cast(s_suppkey as int) as transformation_seq,
 case when s_suppkey%4=0 then cast(null as string) else concat(' step',chr(13),chr(10),s_name,chr(9)) end as transformation_desc,
 concat('select count(*) as n',chr(10),'from',chr(9),'supplier where s_nationkey = ',cast(s_nationkey as string)) as sql_statement,
 date '2000-01-01' + cast(s_suppkey%7 as int) as valid_from,
 case when s_suppkey%5=0 then date '2000-06-30' else date '9999-12-31' end as valid_to
from {supplier}""",
    "src_batches": """
select cast(o_orderkey as int) as audit_id, concat('batch_',cast(o_custkey%5 as string)) as batch_name, 'cron' as scheduler,
 o_orderdate as batch_start_dtm,
 case when o_orderkey%3=0 then null else o_orderdate + interval 1 day end as batch_end_dtm,
 case when o_orderkey%3=0 then 'I' else 'S' end as batch_load_stus_ind,
 o_orderdate as row_process_dtm
from {orders}""",
}

_REF = re.compile(r"\{(\w+)\}")


def deps(name: str) -> list[str]:
    """Stand-ins ``name`` reads, directly or indirectly, in definition order."""
    seen: set[str] = set()

    def walk(n: str) -> None:
        for r in _REF.findall(FIXTURE_SQL[n]):
            if r in FIXTURE_SQL and r not in seen:
                walk(r)
                seen.add(r)

    walk(name)
    seen.add(name)
    return [n for n in FIXTURE_SQL if n in seen]


def sql_ctes(names: list[str]) -> str:
    """``WITH`` prefix defining the named stand-ins (and what they read) for
    the DuckDB oracle, where the driver tables are plain views."""
    needed: list[str] = []
    for n in names:
        for d in deps(n):
            if d not in needed:
                needed.append(d)
    order = [n for n in FIXTURE_SQL if n in needed]
    parts = [f"{n} AS ({_REF.sub(lambda m: m.group(1), FIXTURE_SQL[n]).strip()})" for n in order]
    return "WITH " + ",\n".join(parts)


@dataclass
class Sources:
    """The stand-in source tables as Spark DataFrames."""
    frames: dict[str, DataFrame]

    def __getattr__(self, item: str) -> DataFrame:
        frames = self.__dict__.get("frames", {})
        key = item if item.startswith("src_") else f"src_{item}"
        if key in frames:
            return frames[key]
        raise AttributeError(item)

    def materialize(self, spark: SparkSession, path: str) -> "Sources":
        """Write every stand-in once as parquet and read it back, so timed
        loads start from stored tables like the real sources."""
        out = {}
        for name, df in self.frames.items():
            df.write.mode("overwrite").parquet(f"{path}/{name}")
            out[name] = spark.read.parquet(f"{path}/{name}")
        return Sources(out)


_cache: dict[tuple[int, str], Sources] = {}
_given: set[tuple[int, str]] = set()

#: The stand-in that the beneficiaries, the employees and the cross-reference are made from.
PARTICIPANTS = ("src_participant",)
#: With the employees, for loads of several batches.
PEOPLE = (*PARTICIPANTS, "src_employee")


def use_sources(spark: SparkSession, sf_dir: str, sources: Sources) -> None:
    """Make ``load_sources(spark, sf_dir)`` return ``sources`` (e.g. the
    stand-ins after ``materialize``)."""
    _cache[(id(spark), sf_dir)] = sources
    _given.add((id(spark), sf_dir))


def load_sources(spark: SparkSession, sf_dir: str, stored: Sequence[str] = ()) -> Sources:
    """Register the driver tables of ``sf_dir`` and the stand-ins as temporary
    views with session-unique names; return the stand-ins as DataFrames.

    Those named in ``stored`` are written once, as a lineage cut of this call: a load that
    reads one several times, or others made from it, does not derive it each time."""
    key = (id(spark), sf_dir)
    if key in _cache and (not stored or key in _given):
        return _cache[key]
    tag = uuid.uuid4().hex[:8] if stored else hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    names: dict[str, str] = {}
    for t in DRIVER_TABLES:
        v = f"hl_{t}_{tag}"
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(v)
        names[t] = v
    frames: dict[str, DataFrame] = {}
    for n, text in FIXTURE_SQL.items():
        v = f"hl_{n}_{tag}"
        df = spark.sql(_REF.sub(lambda m: names[m.group(1)], text))
        if n in stored:
            df = cut_lineage(df)
        df.createOrReplaceTempView(v)
        names[n] = v
        frames[n] = df
    src = Sources(frames)
    if stored:
        for v in names.values():
            spark.catalog.dropTempView(v)
    else:
        _cache[key] = src
    return src
