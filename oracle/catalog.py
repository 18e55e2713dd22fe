"""Oracle SQL by query name (callables, rendered on demand)."""

from __future__ import annotations

from . import loads, ops, stored

ORACLES = {
    name: getattr(loads, name) for name in (
        "load_party", "load_account", "load_address_all", "load_agreement_sponsor",
        "load_agreement_plan", "load_agreement_participant", "load_agreement_all",
        "load_customer_agreement", "load_customer_party_address", "load_party_address_all",
        "load_party_email", "load_party_phone_all", "load_party_agreement_all", "load_phone_by_number",
        "load_party_xref_all", "load_party_incremental", "load_agreement_incremental",
        "load_address_incremental", "load_account_incremental",
    )
}
ORACLES.update(ops.OPS)
ORACLES.update(stored.STORED)
