"""Target schemas (attribute columns; every target also has the control
columns).  Column lists follow the target tables' INSERT column lists; types
are deduced from the casts and values the loads write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

# The targets' INSERT column lists.
S, D, B, I = "string", "date", "boolean", "int"
AMT, RT, TS = "decimal(18,2)", "decimal(9,4)", "timestamp_ntz"

CONTROL = [
    ("begin_dt", D), ("begin_dtm", TS), ("row_process_dtm", TS), ("audit_id", I),
    ("logical_delete_ind", B), ("check_sum", S), ("current_row_ind", B), ("end_dt", D),
    ("end_dtm", TS), ("source_system_id", S), ("restricted_row_ind", B),
]

PARTY = [
    ("dim_party_natural_key_hash_uuid", S), ("party_id", S), ("first_nm", S), ("middle_nm", S),
    ("last_nm", S), ("full_nm", S), ("birth_dt", D), ("death_dt", D), ("deceased_ind", B),
    ("gender_cde", S), ("sensitive_party_ind", B), ("mm_employee_ind", B),
    ("individual_income_amt", AMT), ("household_income_amt", AMT), ("net_worth_range_txt", S),
    ("smoker_ind", B), ("mindset_segment_desc", S), ("three_a_segment_desc", S),
    ("permanently_disabled_dt", D), ("primary_occupation_cde", S), ("advisor_ind", B),
    ("party_type_cde", S), ("party_sub_type_cde", S), ("home_agency_cde", S),
]

ACCOUNT = [
    ("dim_account_natural_key_hash_uuid", S), ("master_contract_group_id", S), ("plan_id", S),
    ("subscriber_id", S), ("participant_id", S), ("icu_id", S),
    ("total_balance_share_amt", AMT), ("total_balance_cash_amt", AMT), ("rollover_ind", B),
    ("suspension_start_dt", D), ("suspension_end_dt", D), ("auto_deferral_ind", B),
    ("pre_tax_auto_increase_election_ind", B),
    ("deferral_enrollment_pre_tax_amt", AMT), ("deferral_enrollment_pre_tax_rt", RT),
    ("deferral_enrollment_post_tax_amt", AMT), ("deferral_enrollment_post_tax_rt", RT),
    ("deferral_enrollment_roth_amt", AMT), ("deferral_enrollment_roth_rt", RT),
    ("deferral_enrollment_total_rt", RT), ("deferral_enrollment_total_amt", AMT),
    ("deferral_enrollment_status_cde", S), ("eaca_participation_ind", B),
    ("eaca_opt_out_dt", D), ("eaca_start_dt", D), ("qaca_participation_ind", B),
    ("qaca_opt_out_dt", D), ("qaca_next_deferral_increase_dt", D), ("hire_dt", D),
    ("compensation_415_amt", AMT), ("highly_compensated_employee_ind", B),
    ("key_employee_ind", B), ("employee_status_cde", S),
]

ADDRESS = [
    ("dim_address_natural_key_hash_uuid", S), ("attention_line_txt", S),
    ("address_street_1_txt", S), ("address_street_2_txt", S), ("address_street_3_txt", S),
    ("address_street_4_txt", S), ("city_nm", S), ("state_cde", S), ("zip_cde", S),
    ("zip_6_9_cde", S), ("zip_10_13_cde", S), ("country_cde", S), ("address_validation_cde", S),
]

AGREEMENT = [
    ("dim_agreement_natural_key_hash_uuid", S), ("agreement_nr_pfx", S), ("agreement_nr", S),
    ("agreement_nr_sfx", S), ("agreement_source_cde", S), ("agreement_type_cde", S),
    ("master_contract_group_id", S), ("sponsor_id", S), ("plan_id", S), ("subscriber_id", S),
    ("participant_id", S), ("icu_id", S), ("master_contract_group_nm_national_desc", S),
    ("plan_nm_1_txt", S), ("plan_nm_2_txt", S), ("plan_nm_3_txt", S), ("subscriber_nr", S),
    ("agreement_status_cde", S), ("agreement_status_reason_cde", S), ("allow_rollover_ind", B),
    ("application_submit_dt", D), ("beneficiaries_recorded_ind", B), ("conversion_expired_ind", B),
    ("conversion_eligibility_start_dt", D), ("conversion_eligibility_end_dt", D),
    ("default_voluntary_deferral_rt", RT), ("enrollment_dt", D), ("enrollment_eligibility_dt", D),
    ("enrollment_start_dt", D), ("enrollment_end_dt", D), ("enrollment_status_cde", S),
    ("enrollment_type_cde", S), ("face_amt", AMT), ("internal_plan_id", S), ("issue_dt", D),
    ("participation_dt", D), ("solicitation_dt", D), ("solicitation_ind", B),
    ("taft_hartly_ind", B), ("electronic_contribution_change_ind", B),
    ("pre_tax_auto_increase_contribution_rt", RT),
]

XREF = [
    ("dim_party_natural_key_hash_uuid", S), ("dim_prior_party_natural_key_hash_uuid", S),
    ("party_id", S), ("party_prior_id", S), ("sor_party_id", S), ("party_id_type_cde", S),
]

PARTY_ADDRESS = [
    ("dim_address_natural_key_hash_uuid", S), ("ref_address_type_natural_key_hash_uuid", S),
    ("ref_party_contact_source_natural_key_hash_uuid", S), ("dim_party_natural_key_hash_uuid", S),
    ("primary_address_ind", B),
]

PARTY_PHONE = [
    ("dim_phone_natural_key_hash_uuid", S), ("ref_phone_type_natural_key_hash_uuid", S),
    ("ref_party_contact_source_natural_key_hash_uuid", S), ("dim_party_natural_key_hash_uuid", S),
    ("phone_invalid_ind", B), ("primary_phone_ind", B),
]

PARTY_EMAIL = [
    ("ref_electronic_address_type_natural_key_hash_uuid", S),
    ("dim_electronic_address_natural_key_hash_uuid", S),
    ("ref_party_contact_source_natural_key_hash_uuid", S), ("dim_party_natural_key_hash_uuid", S),
    ("electronic_address_invalid_ind", B), ("primary_electronic_address_ind", B),
]

PARTY_AGREEMENT = [
    ("dim_agreement_natural_key_hash_uuid", S), ("dim_party_natural_key_hash_uuid", S),
    ("ref_party_role_natural_key_hash_uuid", S), ("ref_party_sub_role_natural_key_hash_uuid", S),
    ("dim_product_natural_key_hash_uuid", S), ("dim_account_natural_key_hash_uuid", S),
]


def names(cols: list[tuple[str, str]]) -> list[str]:
    return [c for c, _ in cols]


def struct_type(cols: list[tuple[str, str]]) -> StructType:
    return _parse_datatype_string(", ".join(f"{c}: {t}" for c, t in cols))


def conform(df: DataFrame, cols: list[tuple[str, str]]) -> DataFrame:
    """Project ``df`` onto a target layout by name: present columns are cast to
    the target type, missing ones become typed NULLs; extra columns drop."""
    have = set(df.columns)
    return df.select(*[
        (F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in cols
    ])
