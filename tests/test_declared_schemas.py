"""Every column a binding produces has the declared type of its warehouse table (the data side of
the reference's column-type spec); columns outside the declaration are listed in schemas.EXTRA."""

import pytest
from pyspark.sql.types import _parse_datatype_string

from conftest import SMALL_SF

from switchboard.plans import bindings as B
from switchboard.plans import schemas as S
from switchboard.plans import warehouse as W

PRODUCERS = {
    "fact_agent_activity": B.fact_agent_activity, "dim_agent": B.dim_agent,
    "fact_queue_interval": B.fact_queue_interval, "fact_interaction": B.fact_interaction,
    "dim_program": B.dim_program, "fact_csat_survey": B.fact_csat_survey, "fact_billing_line": B.fact_billing_line,
    "fact_adherence_daily": B.fact_adherence_daily, "fact_ticket": B.fact_ticket, "stg_tel_call": B.stg_tel_call,
    "ods_call": B.ods_call, "ods_queue": B.ods_queue, "ods_agent_scd2": W.ods_agent_scd2,
    "ods_client_acid": W.ods_client_acid, "ods_agent_acid": W.ods_agent_acid,
    "ods_ticket_acid": W.ods_ticket_acid, "ods_invoice_acid": W.ods_invoice_acid,
}


@pytest.mark.parametrize("name", sorted(PRODUCERS))
def test_binding_types_match_declaration(spark, name):
    declared = {f.name: f.dataType for f in _parse_datatype_string(S.DECLARED[name]).fields}
    order = [f.name for f in _parse_datatype_string(S.DECLARED[name]).fields]
    df = PRODUCERS[name](spark, SMALL_SF)
    extra = S.EXTRA.get(name, set())
    got = [c for c in df.columns if c not in extra]
    assert set(got) <= set(declared), set(got) - set(declared)
    for f in df.schema.fields:
        if f.name in declared:
            assert f.dataType == declared[f.name], (name, f.name, f.dataType, declared[f.name])
    # declared columns keep their declared relative order
    assert got == [c for c in order if c in got]
