"""The SQL surface gives the same rows as the DataFrame plans."""
import pytest

from conftest import SF_SMALL
from pricewell.plans import sql as S
from pricewell.plans import views as V
from pricewell.plans.catalog import rounded
from pricewell.plans.scenario import full_load


@pytest.fixture(scope="module")
def wh(spark):
    w = full_load(spark, SF_SMALL).read()
    S.register(spark, w)
    return w


PAIRS = {"sector_year_return": V.sector_year_return, "golden_crosses": V.golden_cross, "reject_drilldown": V.reject_drilldown}


@pytest.mark.parametrize("name", PAIRS)
def test_examples(spark, wh, name):
    want = rounded(PAIRS[name](wh))
    assert sorted(map(str, rounded(S.example(spark, name).select(*want.columns)).collect())) == sorted(map(str, want.collect()))


def test_examples_with_parameters(spark, wh):
    want = rounded(V.most_volatile(wh, 1996, 3)).collect()
    assert rounded(S.example(spark, "most_volatile", year=1996, quarter=3)).collect() == want and want
    one = V.trace_run(wh).orderBy("date_key").first()
    got = S.example(spark, "trace_run", ticker=one.ticker, date_key=one.date_key).collect()
    assert sorted(got) == sorted(V.trace_files(wh, one.ticker, one.date_key).collect()) and got


def test_views(spark, wh):
    for name, plan in S.VIEWS.items():
        want = rounded(plan(wh))
        assert sorted(map(str, rounded(spark.table(name)).collect())) == sorted(map(str, want.collect()))
