import datetime as dt

from dockplan import config
from dockplan.operators.minimums import vendor_minimums
from dockplan.sources.schemas import VENDOR_LOCATION, VENDOR_OVERRIDE

AS_OF = dt.date(2000, 1, 1)


def _vl(spark, rows):
    full = []
    for i, (delivery, mins) in enumerate(rows):
        case, cube, dollar, pallet, units, weight = mins
        full.append((AS_OF, "L1", f"V{i}", f"N{i}", delivery, "B0", "COLLECT", "DIRECT", "Enabled", 3,
                     case, cube, dollar, pallet, units, weight))
    return spark.createDataFrame(full, VENDOR_LOCATION)


def _get(df):
    return {r["vendor_number"]: r for r in df.collect()}


def test_planning_minimum_type_and_amount(spark):
    vl = _vl(spark, [("Prepaid", (None, 50.0, 20.0, None, None, None)),
                     ("Prepaid", (None, None, None, None, None, None))])
    q1 = _get(vendor_minimums(vl, config.snapshot_report(AS_OF, None)))
    assert (q1["V0"]["raw_min_type"], q1["V0"]["min_planning_amount"]) == ("cube", 50.0)
    assert (q1["V1"]["raw_min_type"], q1["V1"]["min_planning_amount"]) == ("undefined", 1.0)
    ov = spark.createDataFrame([], VENDOR_OVERRIDE)
    q3 = _get(vendor_minimums(vl, config.weekly_plan(AS_OF), ov))
    assert q3["V1"]["min_planning_amount"] == 123456789.0


def test_override_amount_and_delivery(spark):
    vl = _vl(spark, [("Prepaid", (None,) * 6), ("Prepaid", (None, None, None, None, 2.0, None))])
    ov = spark.createDataFrame([("V0", None, 25.0), ("V1", "Shipping Container", None)], VENDOR_OVERRIDE)
    got = _get(vendor_minimums(vl, config.weekly_plan(AS_OF), ov))
    assert (got["V0"]["raw_min_type"], got["V0"]["min_planning_amount"]) == ("undefined", 25.0)
    assert got["V1"]["vendor_delivery_type"] == "Shipping Container"
    assert got["V1"]["vendor_min_type"] == "cube" and got["V1"]["moq"] == 4150000.0


def test_container_rule_and_moq_floor(spark):
    ship = "Shipping Container"
    ftl = "FTL (Full Truck Load)"
    vl = _vl(spark, [
        (ship, (None, None, 20000.0, None, None, None)),
        (ship, (None, 3999999.0, None, None, None, None)),
        (ship, (None, 4000000.0, None, None, None, None)),
        (ftl, (None, None, None, None, None, 37999.0)),
        (ftl, (None, None, None, None, None, 38000.0)),
        (ftl, (None, 10.0, None, None, None, None)),
    ])
    got = _get(vendor_minimums(vl, config.snapshot_report(AS_OF, None)))
    assert (got["V0"]["vendor_min_type"], got["V0"]["min_planning_amount"]) == ("cube", 20000.0)
    assert [got[f"V{i}"]["moq"] for i in range(6)] == [4150000.0, 4150000.0, 4000000.0, 42000.0, 38000.0, 10.0]


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["Shipping Container", "FTL (Full Truck Load)", "Prepaid"]),
                          st.floats(0, 1e7), st.sampled_from([0, 1, 5])), min_size=1, max_size=30))
def test_moq_floor_property(rows):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    slots = [(None,) * 6 for _ in rows]
    data = []
    for (delivery, amount, slot), empty in zip(rows, slots):
        mins = list(empty)
        mins[slot] = amount
        data.append((delivery, tuple(mins)))
    got = vendor_minimums(_vl(spark, data), config.snapshot_report(AS_OF, None)).collect()
    for r in got:
        if r["vendor_delivery_type"] == "Shipping Container" or (
                r["vendor_delivery_type"] == "FTL (Full Truck Load)" and r["vendor_min_type"] == "weight"):
            assert r["moq"] >= r["min_planning_amount"]
        else:
            assert r["moq"] == r["min_planning_amount"]


def test_config_rejects_unknown_choice():
    import pytest

    with pytest.raises(ValueError):
        config.weekly_plan(AS_OF).with_(truckloads="by_typ")


def test_duplicate_overrides_do_not_multiply(spark):
    """A vendor on several lists keeps the first list's row."""
    vl = _vl(spark, [("Prepaid", (None,) * 6), ("Prepaid", (None,) * 6)])
    ov = spark.createDataFrame([("V0", "Small Parcel", 9.0, 2), ("V0", "Shipping Container", 25.0, 1), ("V0", "Small Parcel", 9.0, None)],
                               "vendor_number string, delivery_type string, min_amount double, priority int")
    rows = vendor_minimums(vl, config.weekly_plan(AS_OF), ov).collect()
    got = {r["vendor_number"]: r for r in rows}
    assert len(rows) == 2 and got["V0"]["vendor_delivery_type"] == "Shipping Container" and got["V0"]["min_planning_amount"] == 25.0


def test_upt_over_several_sites_needs_the_site(spark):
    import pytest

    with pytest.raises(ValueError):
        config.snapshot_report(AS_OF, None).with_(upt_join_on_location=False)
    assert config.snapshot_report(AS_OF, "L1").with_upt
