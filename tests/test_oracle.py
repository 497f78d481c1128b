"""Every registered query against its DuckDB oracle on the small test tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import check
from vaultspark.plans import contents as C
from vaultspark.plans import queries as Q


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["billing_year", "legal_type", "district", "registration_year",
                          "billing_mode", "is_vip", "tot_sum"]


def core():
    return [*Q.QUERIES, *C.QUERIES]


def test_every_query_has_an_oracle():
    assert set(core()) == {*Q.ORACLE_SQL, *C.ORACLE_SQL}
    assert set(core()) <= set(E.queries()) and len(set(core())) == len(core())


@pytest.mark.parametrize("sf", [SF_SMALL])
def test_queries_match_oracle(spark, sf):
    res = check(spark, sf, core())
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad


#: Queries whose tables never get a row in these feeds, and why: a rerun of unchanged feeds inserts nothing there, the MDM
#: snapshot does not change, no later year brings new users or document types, nothing is wrong in the fact.  Each has a
#: partner on the feeds with quirks that returns rows.
EMPTY = {"hub_user_second_year": "quirk_hub_user_second_year", "hub_pay_doc_type_second_year": "quirk_hub_pay_doc_type_second_year",
         "sat_payment_rerun": "sat_payment_late_rerun", "sat_mdm_second_year": "sat_mdm_changed_second_year",
         "sat_mdm_rerun": "sat_mdm_corrected_rerun", "fact_fk_violations": "fact_fk_planted"}


def test_only_known_queries_are_empty(spark):
    for name in [*C.QUERIES]:
        assert not C.QUERIES[name](spark, SF_SMALL).isEmpty(), name
    assert set(EMPTY) <= set(Q.QUERIES) and set(EMPTY.values()) <= set(C.QUERIES)
