"""Oracle SQL for the history loads (DuckDB dialect, one statement each)."""

from __future__ import annotations

from dataclasses import replace

from . import layouts as T

from .sqlgen import (NULL_S, SqlSpec, bounds, cs, hk, incremental_query, itxt, load_query, norm, ph, q, tobool,
                     yn_bool)

N = NULL_S
XK = ("dim_party_natural_key_hash_uuid", "party_id_type_cde", "sor_party_id")
PA_KEY = ("dim_address_natural_key_hash_uuid", "ref_address_type_natural_key_hash_uuid",
          "ref_party_contact_source_natural_key_hash_uuid", "dim_party_natural_key_hash_uuid")
PP_KEY = ("dim_phone_natural_key_hash_uuid", "ref_phone_type_natural_key_hash_uuid",
          "ref_party_contact_source_natural_key_hash_uuid", "dim_party_natural_key_hash_uuid")
PE_KEY = ("ref_electronic_address_type_natural_key_hash_uuid",
          "dim_electronic_address_natural_key_hash_uuid",
          "ref_party_contact_source_natural_key_hash_uuid", "dim_party_natural_key_hash_uuid")
PG_KEY = ("dim_agreement_natural_key_hash_uuid", "dim_party_natural_key_hash_uuid",
          "ref_party_role_natural_key_hash_uuid")


def sponsor_party_id(icu="icu_id", spn="spnsr_cmpny_id") -> str:
    return ph(q("TRAC_ENTITY"), icu, itxt(spn))


def active(c="actv_rcrd_ind") -> str:
    return f"coalesce(upper({c}) = 'Y', false)"


def active_trim(c="actv_rcrd_ind") -> str:
    return f"coalesce({norm(c)} = 'Y', false)"


def real_icu(c="icu_id", sentinels=("00002", "-1")) -> str:
    lst = ", ".join(q(s) for s in sentinels)
    return f"({cs(c)} IS NOT NULL AND {cs(c)} NOT IN ({lst}))"


def xref(id_type: str) -> str:
    return (f"(SELECT DISTINCT party_id, sor_party_id FROM src_xref WHERE party_id_type_cde = "
            f"{q(id_type)} AND logical_delete_ind = false)")


def tr(filters: dict, key: str = "upper_trim", exact=()) -> str:
    """Translation lookup subquery with a ``k`` join key and ``v`` value."""
    conds = [f"{c} = {q(v)}" if c in exact else f"{norm(c)} = {q(v)}" for c, v in filters.items()]
    k = {"upper_trim": norm("src_fld_val"), "clean": cs("src_fld_val"), "exact": "src_fld_val"}[key]
    return f"(SELECT {k} AS k, trnslt_fld_val AS v FROM src_translation WHERE {' AND '.join(conds)})"


def join_txt(*cols) -> str:
    return cs("||'_'||".join(f"CAST({c} AS VARCHAR)" for c in cols))


# -- party ---------------------------------------------------------------------

def party_specs() -> list[SqlSpec]:
    pid = sponsor_party_id()
    name = cs("spnsr_cmpny_nm")
    return [SqlSpec(
        T.PARTY, ("dim_party_natural_key_hash_uuid",), "src_sponsor",
        {"dim_party_natural_key_hash_uuid": hk(pid), "party_id": pid, "full_nm": name,
         "check_sum": hk(N, N, N, name, *[N] * 18),
         **bounds("rcrd_effctv_dt", "rcrd_trm_dt")},
        fixtures=["src_sponsor"])]


# -- address -------------------------------------------------------------------

STATE = {"src_cde": "TRAC", "src_fld_nm": "STT_CD", "trnslt_fld_nm": "STATE CODE"}
COUNTRY = {"src_cde": "TRAC", "src_fld_nm": "RSDNC_LCTN_CD", "trnslt_fld_nm": "COUNTRY CODE"}


def _addr_from(table: str, alias: str = "t") -> str:
    return (f"{table} {alias} LEFT JOIN {tr(STATE)} st ON st.k = {norm(alias + '.stt_cd')} "
            f"LEFT JOIN {tr(COUNTRY)} co ON co.k = {norm(alias + '.rsdnc_lctn_cd')}")


def _addr_parts(a="t") -> list[str]:
    return [N, cs(f"{a}.addrss_ln_1"), cs(f"{a}.addrss_ln_2"), cs(f"{a}.addrss_ln_3"), N,
            cs(f"{a}.city_nm"), cs("st.v"), cs(f"{a}.zip_cd"), cs(f"{a}.zip_plus_4_cd"), N, cs("co.v")]


def address_specs() -> list[SqlSpec]:
    out = []
    for table in ("src_participant", "src_beneficiary", "src_employee"):
        p = _addr_parts()
        out.append(SqlSpec(
            T.ADDRESS, ("dim_address_natural_key_hash_uuid",), _addr_from(table),
            {"dim_address_natural_key_hash_uuid": hk(*p), "address_street_1_txt": p[1],
             "address_street_2_txt": p[2], "address_street_3_txt": p[3], "city_nm": p[5],
             "state_cde": p[6], "zip_cde": p[7], "zip_6_9_cde": p[8], "country_cde": p[10],
             "check_sum": hk(N), **bounds("t.rcrd_effctv_dt", "t.rcrd_trm_dt", None, "9999-12-31")},
            fixtures=[table, "src_translation"]))
    return out


# -- party cross-reference -----------------------------------------------------

def _xref_spec(table, xtype, sor_cols, out_type, sor_value, required):
    where = [active("t.actv_rcrd_ind"), real_icu("t.icu_id")] + [f"{cs('t.' + c)} IS NOT NULL" for c in required]
    return SqlSpec(
        T.XREF, XK, f"{table} t JOIN {xref(xtype)} x ON x.sor_party_id = {join_txt(*['t.' + c for c in sor_cols])}",
        {"dim_party_natural_key_hash_uuid": hk("x.party_id"), "party_id": "x.party_id",
         "sor_party_id": sor_value, "party_id_type_cde": q(out_type), "check_sum": hk(N),
         **bounds("t.rcrd_effctv_dt", "t.rcrd_trm_dt", None, None)},
        where=" AND ".join(where), target_filter="source_system_id = '203'",
        fixtures=[table, "src_xref"])


def xref_specs() -> list[SqlSpec]:
    prt = ("icu_id", "plan_id", "prtcpnt_id")
    ben = ("icu_id", "plan_id", "prtcpnt_id", "bnfcry_id")
    emp = ("icu_id", "afflt_cmpny_id", "spnsr_cmpny_id", "emply_tax_id")
    cust = ph(cs("t.cstmr_id_1"), cs("t.cstmr_id_2"))
    ids = ("cstmr_id_1", "cstmr_id_2")
    pid = sponsor_party_id("s.icu_id", "s.spnsr_cmpny_id")
    spn_where = f"{active('s.actv_rcrd_ind')} AND {real_icu('s.icu_id')}"
    return [
        _xref_spec("src_participant", "TRAC_PRTC_ID", prt, "TRAC_CUST_ID", cust, ids),
        _xref_spec("src_beneficiary", "TRAC_BEN_ID", ben, "TRAC_CUST_ID", cust, ids),
        _xref_spec("src_employee", "TRAC_EMP_ID", emp, "TRAC_CUST_ID", cust, ids),
        _xref_spec("src_participant", "TRAC_PRTC_ID", prt, "GOVT_ID_S", cs("t.prtcpnt_tax_id"), ("prtcpnt_tax_id",)),
        _xref_spec("src_beneficiary", "TRAC_BEN_ID", ben, "GOVT_ID_S", cs("t.bnfcry_tax_id"), ("bnfcry_tax_id",)),
        _xref_spec("src_employee", "TRAC_EMP_ID", emp, "GOVT_ID_S", cs("t.emply_tax_id"), ("emply_tax_id",)),
        SqlSpec(T.XREF, XK, "src_sponsor s",
                {"dim_party_natural_key_hash_uuid": hk(pid), "dim_prior_party_natural_key_hash_uuid": hk(pid),
                 "party_id": pid, "party_prior_id": pid, "sor_party_id": "''",
                 "party_id_type_cde": q("MSTR_PRTY_ID"), "check_sum": hk(N),
                 **bounds("s.rcrd_effctv_dt", "s.rcrd_trm_dt", None, None)},
                where=spn_where, target_filter="source_system_id = '203'", fixtures=["src_sponsor"]),
        SqlSpec(T.XREF, XK, "src_sponsor s",
                {"dim_party_natural_key_hash_uuid": hk(pid), "party_id": pid,
                 "sor_party_id": cs("s.spnsr_cmpny_tax_id"), "party_id_type_cde": q("GOVT_ID_T"),
                 "check_sum": hk(N), **bounds("s.rcrd_effctv_dt", "s.rcrd_trm_dt", None, None)},
                where=f"{spn_where} AND {cs('s.spnsr_cmpny_tax_id')} IS NOT NULL",
                target_filter="source_system_id = '203'", fixtures=["src_sponsor"]),
    ]


# -- party-address, e-mail, phone ------------------------------------------------

def party_address_specs() -> list[SqlSpec]:
    out = []
    for table, xtype, cols in (
            ("src_participant", "TRAC_PRTC_ID", ("icu_id", "plan_id", "prtcpnt_id")),
            ("src_beneficiary", "TRAC_BEN_ID", ("icu_id", "plan_id", "prtcpnt_id", "bnfcry_id")),
            ("src_employee", "TRAC_EMP_ID", ("icu_id", "afflt_cmpny_id", "spnsr_cmpny_id", "emply_tax_id"))):
        frm = (f"{table} t JOIN {xref(xtype)} x ON x.sor_party_id = {join_txt(*['t.' + c for c in cols])} "
               f"LEFT JOIN {tr(STATE)} st ON st.k = {norm('t.stt_cd')} "
               f"LEFT JOIN {tr(COUNTRY)} co ON co.k = {norm('t.rsdnc_lctn_cd')}")
        out.append(SqlSpec(
            T.PARTY_ADDRESS, PA_KEY, frm,
            {"dim_address_natural_key_hash_uuid": hk(*_addr_parts()),
             "ref_address_type_natural_key_hash_uuid": hk(q("STDA")),
             "ref_party_contact_source_natural_key_hash_uuid": hk(q("TRAC")),
             "dim_party_natural_key_hash_uuid": hk("x.party_id"),
             "check_sum": hk(N),
             **bounds("t.rcrd_effctv_dt", "t.rcrd_trm_dt", None, None)},
            fixtures=[table, "src_xref", "src_translation"]))
    return out


def customer_party_address_specs() -> list[SqlSpec]:
    cn = {"src_cde": "PARTY", "src_fld_nm": "CNTRY_NM", "trnslt_fld_nm": "COUNTRY NAME"}
    frm = (f"src_customer_agreement_hist t JOIN {xref('TD_PRTY_ID')} x ON x.sor_party_id = t.prty_id "
           f"LEFT JOIN {tr(cn, 'clean', exact=tuple(cn))} co ON co.k = {cs('t.ctry_cd')}")
    parts = [cs("t." + c) for c in ("attn_line", "ad_l1_txt", "ad_l2_txt", "ad_l3_txt", "ad_l4_txt",
                                    "city", "state", "zip_1_5_nr", "zip_6_9_nr", "zip_10_13_nr")] + [cs("co.v")]
    return [SqlSpec(
        T.PARTY_ADDRESS, PA_KEY, frm,
        {"dim_address_natural_key_hash_uuid": hk(*parts),
         "ref_address_type_natural_key_hash_uuid": hk("coalesce(t.ad_typ_cd, 'STDA')"),
         "ref_party_contact_source_natural_key_hash_uuid": hk(q("ECDM")),
         "dim_party_natural_key_hash_uuid": hk("x.party_id"), "check_sum": hk(N),
         **bounds("t.cust_agmt_hist_fr_dt", "t.cust_agmt_hist_to_dt", None, None)},
        batch="Customer_to_CIP", source_system_id="205",
        fixtures=["src_customer_agreement_hist", "src_xref", "src_translation"])]


def party_email_specs() -> list[SqlSpec]:
    frm = (f"src_consent t JOIN {xref('TRAC_CUST_ID')} x ON x.sor_party_id = "
           f"{ph(cs('t.customer_id1'), cs('t.customer_id2'))}")
    return [SqlSpec(
        T.PARTY_EMAIL, PE_KEY, frm,
        {"ref_electronic_address_type_natural_key_hash_uuid": hk(q("SRV")),
         "dim_electronic_address_natural_key_hash_uuid": hk(cs("t.stm_eml_adr_txt")),
         "ref_party_contact_source_natural_key_hash_uuid": hk(q("TRAC")),
         "dim_party_natural_key_hash_uuid": hk("x.party_id"), "check_sum": hk(N, N),
         **bounds("t.rcrd_effctv_dt", "t.rcrd_trm_dt", None, None)},
        where=active_trim("t.actv_rcrd_ind"), fixtures=["src_consent", "src_xref"])]


def party_phone_specs() -> list[SqlSpec]:
    """Three separate scans, as the original does; the Spark side fans out."""
    out = []
    kinds = (("PREFTEL", [cs("d.preftel_ctry_cd_nr"), cs("d.preftel_nr_10digit"), "d.preftel_xtn_nr"]),
             ("RESTEL", [cs("d.restel_ctry_cd_nr"), cs("d.restel_nr_10digit"), "d.restel_xtn_nr"]),
             ("PREFAX", [cs("d.prefax_tel_ctry_cd_nr"), cs("d.prefax_tel_nr_10digit")]))
    for kind, parts in kinds:
        frm = (f"(SELECT DISTINCT {q(kind)} AS phone_type_cde, {hk(*parts)} AS phone_id, x.party_id, "
               f"d.pdcr_hist_fr_dt, d.pdcr_hist_to_dt FROM src_demographics_hist d "
               f"JOIN {xref('BP_ID')} x ON x.sor_party_id = {cs('d.business_partner_id')}) t1")
        out.append(SqlSpec(
            T.PARTY_PHONE, PP_KEY, frm,
            {"dim_phone_natural_key_hash_uuid": hk("t1.phone_id"),
             "ref_phone_type_natural_key_hash_uuid": hk("t1.phone_type_cde"),
             "ref_party_contact_source_natural_key_hash_uuid": hk(q("DSP")),
             "dim_party_natural_key_hash_uuid": hk("t1.party_id"), "check_sum": hk(N, N),
             **bounds("t1.pdcr_hist_fr_dt", "t1.pdcr_hist_to_dt", "0001-01-01", "9999-12-31")},
            batch="Producer_to_CIP", source_system_id="207",
            fixtures=["src_demographics_hist", "src_xref"]))
    return out


# -- agreements ------------------------------------------------------------------

def agreement_key(pfx, nr, sfx, source, type_) -> str:
    return hk(pfx, nr, sfx, source, type_)


PLAN_STATUS = {"src_cde": "TRAC", "src_tbl_nm": "DIM_PLAN", "src_fld_nm": "PLAN_STTS_CD",
               "trnslt_fld_nm": "STATUS CODE"}
PLAN_REASON = {**PLAN_STATUS, "trnslt_fld_nm": "STATUS REASON CODE"}
PRT_STATUS = {"src_cde": "TRAC", "src_tbl_nm": "DIM_PARTICIPANT", "src_fld_nm": "PARTCPNT_STTS_CD",
              "trnslt_fld_nm": "STATUS CODE"}
PRT_REASON = {**PRT_STATUS, "trnslt_fld_nm": "STATUS REASON CODE"}
AK = ("dim_agreement_natural_key_hash_uuid",)


def agreement_specs() -> list[SqlSpec]:
    mca_icu = ("~", "00002", "-1")
    nr1 = ph("s.icu_id", itxt("s.spnsr_cmpny_id"))
    sponsor = SqlSpec(
        T.AGREEMENT, AK, "src_sponsor s",
        {"dim_agreement_natural_key_hash_uuid": agreement_key(N, nr1, N, q("TRAC"), q("MCA")),
         "agreement_nr": nr1, "agreement_source_cde": q("TRAC"), "agreement_type_cde": q("MCA"),
         "master_contract_group_id": nr1, "sponsor_id": itxt("s.spnsr_cmpny_id"),
         "icu_id": cs("s.icu_id"), "master_contract_group_nm_national_desc": cs("s.spnsr_cmpny_nm"),
         "check_sum": hk(nr1, "CAST(s.spnsr_cmpny_id AS VARCHAR)", N, N, N, "s.icu_id", "s.spnsr_cmpny_nm",
                         *[N] * 28),
         **bounds("s.rcrd_effctv_dt", "s.rcrd_trm_dt", None, None)},
        where=f"{active('s.actv_rcrd_ind')} AND {real_icu('s.icu_id', mca_icu)}", fixtures=["src_sponsor"])

    nr2 = ph("p.icu_id", itxt("p.spnsr_cmpny_id"), "p.plan_id")
    mcg2 = ph("p.icu_id", itxt("p.spnsr_cmpny_id"))
    plan = SqlSpec(
        T.AGREEMENT, AK,
        f"src_plan p LEFT JOIN src_sponsor s ON p.icu_id = s.icu_id AND p.spnsr_cmpny_id = s.spnsr_cmpny_id "
        f"LEFT JOIN {tr(PLAN_STATUS, 'clean')} s1 ON s1.k = {cs('p.plan_stts_cd')} "
        f"LEFT JOIN {tr(PLAN_REASON, 'clean')} s2 ON s2.k = {cs('p.plan_stts_cd')}",
        {"dim_agreement_natural_key_hash_uuid": agreement_key(N, nr2, N, q("TRAC"), q("PSA")),
         "agreement_nr": nr2, "agreement_source_cde": q("TRAC"), "agreement_type_cde": q("PSA"),
         "master_contract_group_id": mcg2, "sponsor_id": itxt("p.spnsr_cmpny_id"),
         "plan_id": cs("p.plan_id"), "icu_id": cs("p.icu_id"),
         "master_contract_group_nm_national_desc": cs("s.spnsr_cmpny_nm"),
         "plan_nm_1_txt": cs("p.plan_nm"), "plan_nm_2_txt": cs("p.plan_nm_2"), "plan_nm_3_txt": cs("p.plan_nm_3"),
         "agreement_status_cde": cs("s1.v"), "agreement_status_reason_cde": cs("s2.v"),
         "default_voluntary_deferral_rt": "p.dflt_vlntry_dfrrl_pct",
         "internal_plan_id": cs("p.intrnl_plan_id"),
         "pre_tax_auto_increase_contribution_rt": "p.pre_tax_cntrbtn_incrs_rt",
         "check_sum": hk(nr2, "CAST(p.spnsr_cmpny_id AS VARCHAR)", "p.plan_id", N, N, "p.icu_id",
                         "s.spnsr_cmpny_nm", "p.plan_nm", "p.plan_nm_2", "p.plan_nm_3", N, "s1.v", "s2.v",
                         *[N] * 6, "p.dflt_vlntry_dfrrl_pct", *[N] * 4, N, N, N, "p.intrnl_plan_id",
                         *[N] * 6, "p.pre_tax_cntrbtn_incrs_rt"),
         **bounds("p.rcrd_effctv_dt", "p.rcrd_trm_dt", None, None)},
        where=f"{active('p.actv_rcrd_ind')} AND {active('s.actv_rcrd_ind')} AND {real_icu('p.icu_id', mca_icu)}",
        fixtures=["src_plan", "src_sponsor", "src_translation"])

    nr3 = ph("t.icu_id", itxt("t.spnsr_cmpny_id"), "t.plan_id", "t.prtcpnt_id")
    mcg3 = ph("t.icu_id", itxt("t.spnsr_cmpny_id"))
    prt = SqlSpec(
        T.AGREEMENT, AK,
        f"src_participant t LEFT JOIN src_plan p ON p.icu_id = t.icu_id AND p.spnsr_cmpny_id = t.spnsr_cmpny_id "
        f"AND p.plan_id = t.plan_id LEFT JOIN src_sponsor s ON p.icu_id = s.icu_id AND p.spnsr_cmpny_id = s.spnsr_cmpny_id "
        f"LEFT JOIN {tr(PRT_STATUS, 'clean', exact=('src_tbl_nm',))} s1 ON s1.k = {cs('t.prtcpnt_stts_cd')} "
        f"LEFT JOIN {tr(PRT_REASON, 'clean', exact=('src_tbl_nm',))} s2 ON s2.k = {cs('t.prtcpnt_stts_cd')}",
        {"dim_agreement_natural_key_hash_uuid": agreement_key(N, nr3, N, q("TRAC"), q("PCA")),
         "agreement_nr": nr3, "agreement_source_cde": q("TRAC"), "agreement_type_cde": q("PCA"),
         "master_contract_group_id": mcg3, "sponsor_id": itxt("t.spnsr_cmpny_id"),
         "plan_id": cs("t.plan_id"), "participant_id": cs("t.prtcpnt_id"), "icu_id": cs("t.icu_id"),
         "master_contract_group_nm_national_desc": cs("s.spnsr_cmpny_nm"),
         "plan_nm_1_txt": cs("p.plan_nm"), "plan_nm_2_txt": cs("p.plan_nm_2"), "plan_nm_3_txt": cs("p.plan_nm_3"),
         "agreement_status_cde": cs("s1.v"), "agreement_status_reason_cde": cs("s2.v"),
         "default_voluntary_deferral_rt": "p.dflt_vlntry_dfrrl_pct", "enrollment_dt": "t.plan_enrllmnt_dt",
         "internal_plan_id": cs("t.intrnl_plan_id"),
         "pre_tax_auto_increase_contribution_rt": "p.pre_tax_cntrbtn_incrs_rt",
         "check_sum": hk(mcg3, "CAST(t.spnsr_cmpny_id AS VARCHAR)", "t.plan_id", N, "t.prtcpnt_id", "t.icu_id",
                         "s.spnsr_cmpny_nm", "p.plan_nm", "p.plan_nm_2", "p.plan_nm_3", N, "s1.v", "s2.v",
                         *[N] * 6, "p.dflt_vlntry_dfrrl_pct", "t.plan_enrllmnt_dt", *[N] * 3, N, N, N,
                         "t.intrnl_plan_id", *[N] * 6, "p.pre_tax_cntrbtn_incrs_rt"),
         **bounds("t.rcrd_effctv_dt", "t.rcrd_trm_dt", None, None)},
        where=(f"{active('p.actv_rcrd_ind')} AND {active('s.actv_rcrd_ind')} AND {active('t.actv_rcrd_ind')} "
               f"AND {real_icu('t.icu_id')}"),
        fixtures=["src_participant", "src_plan", "src_sponsor", "src_translation"])
    return [sponsor, plan, prt]


def customer_agreement_specs(as_of: str = "2001-01-01") -> list[SqlSpec]:
    pfx, nr, sfx, src = (cs("a." + c) for c in ("hldg_key_pfx", "hldg_key", "hldg_key_sfx", "agreement_source_cd"))
    exp = f"coalesce(a.conversion_end_date < DATE {q(as_of)}, false)"
    return [SqlSpec(
        T.AGREEMENT, AK, "src_agreement_hist a",
        {"dim_agreement_natural_key_hash_uuid": agreement_key(pfx, nr, sfx, src, q("IPA")),
         "agreement_nr_pfx": pfx, "agreement_nr": nr, "agreement_nr_sfx": sfx,
         "agreement_source_cde": src, "agreement_type_cde": q("IPA"),
         "agreement_status_cde": cs("a.hldg_stus"), "agreement_status_reason_cde": cs("a.stus_rsn"),
         "conversion_expired_ind": exp, "conversion_eligibility_start_dt": "a.conversion_start_date",
         "conversion_eligibility_end_dt": "a.conversion_end_date", "face_amt": "a.face_amount",
         "issue_dt": "a.issue_dt",
         "check_sum": hk(*[N] * 11, cs("a.hldg_stus"), cs("a.stus_rsn"), *[N] * 3, f"CAST({exp} AS VARCHAR)",
                         "a.conversion_start_date", "a.conversion_end_date", *[N] * 5, N, N, "a.face_amount",
                         N, "a.issue_dt", *[N] * 6),
         **bounds("a.agmt_hist_fr_dt", "a.agmt_hist_to_dt", None, None)},
        batch="Customer_to_CIP", source_system_id="205", fixtures=["src_agreement_hist"])]


# -- party-agreement -------------------------------------------------------------

def _bridge(nr, type_, party, role, product=None, account=None, sub_role=None, checksum=None,
            begin="DATE '0001-01-01'", end="DATE '9999-12-31'"):
    def nh(x):
        return f"CASE WHEN {x} IS NULL THEN NULL ELSE {hk(x)} END"
    return {
        "dim_agreement_natural_key_hash_uuid": agreement_key(N, nr, N, q("TRAC"), q(type_)),
        "dim_party_natural_key_hash_uuid": hk(party),
        "ref_party_role_natural_key_hash_uuid": hk(q(role)),
        "ref_party_sub_role_natural_key_hash_uuid": nh(sub_role) if sub_role else "NULL",
        "dim_product_natural_key_hash_uuid": nh(product) if product else "NULL",
        "dim_account_natural_key_hash_uuid": account or "NULL",
        "check_sum": checksum,
        "begin_dt": f"CAST({begin} AS DATE)", "begin_dtm": f"CAST({begin} AS TIMESTAMP)",
        "end_dt": f"CAST({end} AS DATE)", "end_dtm": f"CAST({end} AS TIMESTAMP)",
    }


def party_agreement_specs() -> list[SqlSpec]:
    grp_nr = ph(cs("s.icu_id"), cs(itxt("s.spnsr_cmpny_id")))
    grp = SqlSpec(
        T.PARTY_AGREEMENT, PG_KEY,
        "src_sponsor s LEFT JOIN src_consent c ON s.spnsr_cmpny_key = c.consent_cust_key "
        "AND s.spnsr_cmpny_id = c.client_id AND c.rcrd_trm_dt = DATE '9999-12-31'",
        _bridge(grp_nr, "MCA", sponsor_party_id("s.icu_id", "s.spnsr_cmpny_id"), "GRP",
                checksum=hk(N, N, N),
                begin="coalesce(c.rcrd_effctv_dt, DATE '0001-01-01')",
                end="coalesce(c.rcrd_trm_dt, DATE '9999-12-31')"),
        where=active("s.actv_rcrd_ind"), fixtures=["src_sponsor", "src_consent"])

    def prod(trim):
        code = "upper(trim(knd_min_cde))" if trim else "upper(knd_min_cde)"
        return (f"(SELECT DISTINCT {code} AS k, prod_id FROM src_product "
                f"WHERE {norm('admn_sys_cde')} = 'TRAC')")

    nr = ph("t.icu_id", itxt("t.spnsr_cmpny_id"), "t.plan_id", "t.prtcpnt_id")
    sp = SqlSpec(
        T.PARTY_AGREEMENT, PG_KEY,
        f"src_participant t LEFT JOIN src_plan p ON t.icu_id = p.icu_id AND t.plan_id = p.plan_id "
        f"LEFT JOIN {prod(False)} pr ON pr.k = upper(p.plan_type_cd)",
        _bridge(nr, "PCA", sponsor_party_id("t.icu_id", "t.spnsr_cmpny_id"), "SPNSR",
                product=cs("pr.prod_id"), checksum=hk(cs("pr.prod_id"), N, N)),
        where=f"{active('t.actv_rcrd_ind')} AND {active('p.actv_rcrd_ind')}",
        fixtures=["src_participant", "src_plan", "src_product"])

    role_cat = {"src_cde": "TRAC", "src_tbl_nm": "DIM_PARTICIPANT", "src_fld_nm": "PRTCPNT_STTS_CD",
                "trnslt_fld_nm": "ROLE CATEGORY"}
    parts = (q("PTCP"), "x.party_id", q("TRAC"), q("PCA"), N, nr, N)
    pt = SqlSpec(
        T.PARTY_AGREEMENT, PG_KEY,
        f"src_participant t JOIN {xref('TRAC_PRTC_ID')} x ON x.sor_party_id = "
        f"{join_txt('t.icu_id', 't.plan_id', 't.prtcpnt_id')} "
        f"LEFT JOIN src_plan p ON t.icu_id = p.icu_id AND t.plan_id = p.plan_id "
        f"LEFT JOIN {prod(True)} pr ON pr.k = upper(trim(p.plan_type_cd)) "
        f"LEFT JOIN {tr(role_cat)} rc ON rc.k = {norm('t.prtcpnt_stts_cd')}",
        _bridge(nr, "PCA", "x.party_id", "PTCP", product=cs("pr.prod_id"), account=hk(*parts),
                sub_role=cs("rc.v"), checksum=hk(cs("pr.prod_id"), *parts, cs("rc.v"))),
        where=f"{active_trim('t.actv_rcrd_ind')} AND {active_trim('p.actv_rcrd_ind')}",
        fixtures=["src_participant", "src_plan", "src_product", "src_xref", "src_translation"])

    bnr = ph("b.icu_id", itxt("p.spnsr_cmpny_id"), "p.plan_id", "b.prtcpnt_id")
    bn = SqlSpec(
        T.PARTY_AGREEMENT, PG_KEY,
        f"src_beneficiary b JOIN {xref('TRAC_BEN_ID')} x ON {cs('x.sor_party_id')} = "
        f"{join_txt('b.icu_id', 'b.plan_id', 'b.prtcpnt_id', 'b.bnfcry_id')} "
        f"LEFT JOIN src_plan p ON b.icu_id = p.icu_id AND b.plan_id = p.plan_id "
        f"LEFT JOIN {prod(True)} pr ON pr.k = upper(trim(p.plan_type_cd))",
        _bridge(bnr, "PCA", "x.party_id", "BENE", product=cs("pr.prod_id"),
                checksum=hk(cs("pr.prod_id"), N, N)),
        where=f"{active_trim('b.actv_rcrd_ind')} AND {active_trim('p.actv_rcrd_ind')}",
        fixtures=["src_beneficiary", "src_plan", "src_product", "src_xref"])
    return [grp, sp, pt, bn]


# -- account ----------------------------------------------------------------------

ACCOUNT_ATTRS = [
    "master_contract_group_id", "plan_id", "subscriber_id", "participant_id", "icu_id",
    "total_balance_share_amt", "total_balance_cash_amt", "rollover_ind", "suspension_start_dt",
    "suspension_end_dt", "auto_deferral_ind", "pre_tax_auto_increase_election_ind",
    "deferral_enrollment_pre_tax_amt", "deferral_enrollment_pre_tax_rt",
    "deferral_enrollment_post_tax_amt", "deferral_enrollment_post_tax_rt",
    "deferral_enrollment_roth_amt", "deferral_enrollment_roth_rt", "deferral_enrollment_total_rt",
    "deferral_enrollment_total_amt", "deferral_enrollment_status_cde", "eaca_participation_ind",
    "eaca_opt_out_dt", "eaca_start_dt", "qaca_participation_ind", "qaca_opt_out_dt",
    "qaca_next_deferral_increase_dt", "hire_dt", "compensation_415_amt",
    "highly_compensated_employee_ind", "key_employee_ind", "employee_status_cde",
]


# Latest enrollment: effective date, then key, then every other column breaks
# remaining ties (all descending, NULLs last) -- a total order.
ENROLLMENT_TIEBREAK = ", ".join(f"{c} DESC NULLS LAST" for c in (
    "rcrd_effctv_dt", "vru_enrllmnt_stts_key", "enrllmnt_stts_cd", "pre_tax_auto_incrs_elctd_ind",
    "pre_tax_enrllmnt_amt", "pre_tax_enrllmnt_rt", "post_tax_enrllmnt_amt", "post_tax_enrllmnt_rt",
    "roth_elctv_dfrrl_enrllmnt_amt", "roth_elctv_dfrrl_enrllmnt_rt", "eaca_opt_out_dt", "eaca_strt_dt",
    "qaca_prtcpnt_ind", "qaca_opt_out_dt", "qaca_next_incrs_dt", "eaca_prtcpnt_ind", "rcrd_trm_dt"))


def account_specs(as_of: str = "2001-01-01") -> list[SqlSpec]:
    emp_status = {"src_cde": "TRAC", "src_tbl_nm": "DIM_PARTICIPANT", "src_fld_nm": "EMPLOYEE_STTS_CD",
                  "trnslt_fld_nm": "EMPLOYEE STATUS CODE"}
    nr = ph(cs("t.icu_id"), cs(itxt("t.spnsr_cmpny_id")), cs("t.plan_id"), cs("t.prtcpnt_id"))
    t1 = f"""(SELECT DISTINCT
 {hk(q('PTCP'), 'x.party_id', q('TRAC'), q('PCA'), N, nr, N)} AS dim_account_natural_key_hash_uuid,
 {ph(cs('t.icu_id'), cs(itxt('t.spnsr_cmpny_id')))} AS master_contract_group_id,
 t.plan_id AS plan_id, {N} AS subscriber_id, t.prtcpnt_id AS participant_id, t.icu_id AS icu_id,
 bal.share AS total_balance_share_amt, bal.cash AS total_balance_cash_amt,
 roll.icu_id IS NOT NULL AS rollover_ind,
 t.sspnd_strt_dt AS suspension_start_dt, t.sspnd_end_dt AS suspension_end_dt,
 coalesce(p.qlfd_plan_incptn_rt > 0 OR p.pre_tax_cntrbtn_incrs_rt > 0, false) AS auto_deferral_ind,
 {yn_bool('e.pre_tax_auto_incrs_elctd_ind')} AS pre_tax_auto_increase_election_ind,
 e.pre_tax_enrllmnt_amt AS deferral_enrollment_pre_tax_amt, e.pre_tax_enrllmnt_rt AS deferral_enrollment_pre_tax_rt,
 e.post_tax_enrllmnt_amt AS deferral_enrollment_post_tax_amt, e.post_tax_enrllmnt_rt AS deferral_enrollment_post_tax_rt,
 e.roth_elctv_dfrrl_enrllmnt_amt AS deferral_enrollment_roth_amt, e.roth_elctv_dfrrl_enrllmnt_rt AS deferral_enrollment_roth_rt,
 {N} AS deferral_enrollment_total_rt, {N} AS deferral_enrollment_total_amt,
 e.enrllmnt_stts_cd AS deferral_enrollment_status_cde,
 {yn_bool('e.eaca_prtcpnt_ind')} AS eaca_participation_ind, e.eaca_opt_out_dt AS eaca_opt_out_dt,
 e.eaca_strt_dt AS eaca_start_dt, {yn_bool('e.qaca_prtcpnt_ind')} AS qaca_participation_ind,
 e.qaca_opt_out_dt AS qaca_opt_out_dt, e.qaca_next_incrs_dt AS qaca_next_deferral_increase_dt,
 m.hire_dt AS hire_dt, {N} AS compensation_415_amt,
 {tobool(cs('m.hce_ind'))} AS highly_compensated_employee_ind, {tobool(cs('m.key_emply_ind'))} AS key_employee_ind,
 {cs('sd.v')} AS employee_status_cde,
 {', '.join(f'{v} AS {k}' for k, v in bounds('e.rcrd_effctv_dt', 'e.rcrd_trm_dt', '0001-01-01', '9999-12-31').items())}
FROM {xref('TRAC_PRTC_ID')} x
JOIN (SELECT * FROM src_participant WHERE {active_trim()}) t
  ON {cs('x.sor_party_id')} = {join_txt('t.icu_id', 't.plan_id', 't.prtcpnt_id')}
LEFT JOIN (SELECT * FROM src_plan WHERE {active_trim()}) p ON t.icu_id = p.icu_id AND t.plan_id = p.plan_id
LEFT JOIN (SELECT icu_id, prtcpnt_id, plan_id, sum(asst_pstn_amt) AS cash, sum(shr_blnc_amt) AS share
           FROM src_asset GROUP BY icu_id, prtcpnt_id, plan_id) bal
  ON t.icu_id = bal.icu_id AND t.plan_id = bal.plan_id AND t.prtcpnt_id = bal.prtcpnt_id
LEFT JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY icu_id, plan_id, prtcpnt_id
           ORDER BY {ENROLLMENT_TIEBREAK}) AS ranking
           FROM src_enrollment WHERE {active_trim()}) z WHERE ranking = 1) e
  ON t.icu_id = e.icu_id AND t.plan_id = e.plan_id AND t.prtcpnt_id = e.prtcpnt_id
LEFT JOIN (SELECT * FROM src_employee WHERE {active_trim()}) m
  ON t.icu_id = m.icu_id AND t.afflt_cmpny_id = m.afflt_cmpny_id AND t.spnsr_cmpny_id = m.spnsr_cmpny_id
  AND t.emply_tax_id = m.emply_tax_id
LEFT JOIN (SELECT DISTINCT icu_id, plan_id, prtcpnt_id FROM src_asset WHERE src_cd IN (128, 129, 155, 112, 182)) roll
  ON t.icu_id = roll.icu_id AND t.plan_id = roll.plan_id AND t.prtcpnt_id = roll.prtcpnt_id
LEFT JOIN {tr(emp_status)} sd ON sd.k = {norm('t.emply_stts_cd')}) a"""
    cols = {c: f"a.{c}" for c in ["dim_account_natural_key_hash_uuid", *ACCOUNT_ATTRS,
                                   "begin_dt", "begin_dtm", "end_dt", "end_dtm"]}
    cols["check_sum"] = hk(*[f"a.{c}" for c in ACCOUNT_ATTRS])
    return [SqlSpec(T.ACCOUNT, ("dim_account_natural_key_hash_uuid",), t1, cols,
                    restart_as_of=as_of,
                    fixtures=["src_xref", "src_participant", "src_plan", "src_asset", "src_enrollment",
                              "src_employee", "src_translation"])]


# -- registry ----------------------------------------------------------------------

def load_party() -> str:
    return load_query(party_specs())


def load_address_all() -> str:
    return load_query(address_specs())


def load_party_xref_all() -> str:
    return load_query(xref_specs())


def load_party_address_all() -> str:
    return load_query(party_address_specs())


def load_customer_party_address() -> str:
    return load_query(customer_party_address_specs())


def load_party_email() -> str:
    return load_query(party_email_specs())


def load_party_phone_all() -> str:
    return load_query(party_phone_specs())


def load_phone_by_number() -> str:
    return load_query([replace(s, flag_keys=s.keys[:2]) for s in party_phone_specs()])


def load_agreement_sponsor() -> str:
    return load_query(agreement_specs()[:1])


def load_agreement_plan() -> str:
    return load_query(agreement_specs()[1:2])


def load_agreement_participant() -> str:
    return load_query(agreement_specs()[2:3])


def load_agreement_all() -> str:
    return load_query(agreement_specs())


def load_customer_agreement() -> str:
    return load_query(customer_agreement_specs())


def load_party_agreement_all() -> str:
    return load_query(party_agreement_specs())


def load_account() -> str:
    return load_query(account_specs())


# -- three batches -----------------------------------------------------------------

def load_party_incremental() -> str:
    return incremental_query(party_specs(), {
        "src_sponsor": "SELECT * REPLACE (CASE WHEN spnsr_cmpny_key % 3 = 0 THEN concat(spnsr_cmpny_nm, 'II') "
                       "ELSE spnsr_cmpny_nm END AS spnsr_cmpny_nm) FROM src_sponsor"})


def load_agreement_incremental() -> str:
    return incremental_query(customer_agreement_specs(), {
        "src_agreement_hist": "SELECT * REPLACE (concat(hldg_stus, '2') AS hldg_stus) FROM src_agreement_hist"})


def load_address_incremental() -> str:
    return incremental_query(address_specs(), {
        "src_participant": "SELECT * REPLACE (concat(addrss_ln_2, ' II') AS addrss_ln_2) FROM src_participant"})


def load_account_incremental() -> str:
    return incremental_query(account_specs(), {
        "src_employee": "SELECT * REPLACE (hire_dt + 1 AS hire_dt) FROM src_employee"})
