import pytest

from sectorlens.operators import registry as R
from sectorlens.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_validation_errors(spark):
    c = fx.v_companies(spark, SF_SMALL)
    cat = R.default_catalog(c, owned=["name", "url"])
    cat["org_nr"] = R.Variable("org_nr", ("equals",), owned=True)
    q = R.RegistryQuery(c, cat)
    with pytest.raises(R.UnknownVariable):
        q.equals({"nope": "1"})
    with pytest.raises(R.VariableNotOwned):
        q.equals({"legal_form": "49"})
    with pytest.raises(R.OperatorNotAllowed):
        q.prefix({"org_nr": "0"})
    assert q.equals({"org_nr": "0000000001"}).fetch().count() <= 1


def test_builder_is_immutable(spark):
    c = fx.v_companies(spark, SF_SMALL)
    q = R.RegistryQuery(c, R.default_catalog(c))
    q2 = q.contains({"name": "Aktie"})
    assert q.clauses == () and len(q2.clauses) == 1
    assert q2.reset().clauses == ()


def test_variable_catalog(spark):
    allv = spark.createDataFrame([("a", ["Finns", "Mellan"]), ("b", ["ArLikaMed"])], "variable string, operators array<string>")
    owned = spark.createDataFrame([("a",)], "variable string")
    rows = {r["variable"]: (r["methods"], r["owned"]) for r in R.variable_catalog(allv, owned).collect()}
    assert rows == {"a": (["exists", "between"], True), "b": (["equals"], False)}


def test_register_row_rule():
    assert R.is_branch_field("Bransch_1, kod")
    assert not R.is_branch_field("Bransch_1P, kod")
    assert not R.is_branch_field("Bransch_1HAE, kod")
    assert not R.is_branch_field("Bransch_1")


def test_argument_checks(spark):
    from sectorlens.operators.dataset import split_assignment
    c = fx.v_companies(spark, SF_SMALL)
    q = R.RegistryQuery(c, R.default_catalog(c))
    with pytest.raises(ValueError):
        q.sni(["10111"], level=4)
    with pytest.raises(ValueError):
        q.sni(["10111"], exclusion=True)          # needs the table of all codes
    with pytest.raises(ValueError):
        split_assignment(c, c.select("company_id"), pct=(70, 20, 20))
