"""Day states: any split of the history gives the UPT of the whole, late and repeated days included."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dockplan import config
from dockplan.operators import receipts
from dockplan.operators.receipt_states import ReceiptStates, day_states, merged, upt_from_states
from dockplan.sources.schemas import PROCUREMENT_DOCS, RECEIPT_LOG, VENDORS

CFG = config.snapshot_report(dt.date(2000, 1, 1), None)
DAYS = [dt.date(2019, 1, d) for d in range(1, 10)] + [None]


@pytest.fixture(scope="module")
def history(spark):
    r = random.Random(4)
    rows = [(r.choice(["W1", "W2", None]), r.choice(["D1", "D2", "D3", "D4", None]), r.choice("abcde"), r.choice([151, 151, 151, 951]),
             float(r.randint(-3, 5)), r.choice(DAYS)) for _ in range(400)]
    docs = spark.createDataFrame([("D1", 1, "Purchase"), ("D1", 1, "Purchase"), ("D2", 1, "Purchase"), ("D3", 2, "Purchase"), ("D4", 2, "Transfer")],
                                 PROCUREMENT_DOCS)
    return spark.createDataFrame(rows, RECEIPT_LOG), docs, spark.createDataFrame([(1, "V1", "One"), (2, "V2", "Two")], VENDORS)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("since", [None, dt.date(2019, 1, 4)])
@pytest.mark.parametrize("seed", [0, 1])
def test_any_split_gives_the_whole(spark, history, tmp_path, seed, since):
    log, docs, vendors = history
    cfg = CFG.with_(upt_since=since)
    states = ReceiptStates(spark, str(tmp_path))
    order = DAYS[:]
    random.Random(seed).shuffle(order)
    states.fold(log, order[:4])
    assert states.fold(log) == set(order[4:])  # what is missing, and only that
    states.fold(log, [order[0], order[5]])  # a repeated day is not counted twice
    assert rows_of(upt_from_states(states.read(), docs, vendors, cfg)) == rows_of(receipts.vendor_upt(log, docs, vendors, cfg))
    states.compact()
    assert rows_of(upt_from_states(states.read(), docs, vendors, cfg)) == rows_of(receipts.vendor_upt(log, docs, vendors, cfg))


def test_late_receipts_of_a_folded_day(spark, history, tmp_path):
    log, docs, vendors = history
    day = DAYS[2]
    late = (F.col("tran_date") == F.lit(day)) & (F.col("item_number") == "b")
    states = ReceiptStates(spark, str(tmp_path))
    states.fold(log.where(~F.coalesce(late, F.lit(False))))
    assert states.missing(log) == set()
    states.fold(log, [day])
    assert rows_of(upt_from_states(states.read(), docs, vendors, CFG)) == rows_of(receipts.vendor_upt(log, docs, vendors, CFG))


def test_merging_is_exact_in_any_grouping(spark, history):
    log, docs, vendors = history
    states = day_states(log)
    some = F.coalesce(F.dayofmonth("tran_date") % 2 == 0, F.lit(True))
    parts = merged(merged(states.where(some)).unionByName(merged(states.where(~some))))
    assert rows_of(parts) == rows_of(merged(states))
    assert rows_of(upt_from_states(parts, docs, vendors, CFG)) == rows_of(receipts.vendor_upt(log, docs, vendors, CFG))


def test_folded_days_are_not_read_again(spark, history, tmp_path):
    log, _, _ = history
    states = ReceiptStates(spark, str(tmp_path))
    states.fold(log, DAYS[:9])
    seen = spark.sparkContext.accumulator(0)

    def count(q):
        seen.add(1)
        return q

    watched = log.withColumn("tran_qty", F.udf(count, "double")("tran_qty"))
    states.fold(watched)
    rest = log.where("tran_date IS NULL").count()
    assert 0 < seen.value <= 2 * rest  # the filter on the quantity and its sum may each take it


def test_a_fold_that_died_does_not_exist(spark, history, tmp_path):
    log, _, _ = history
    states = ReceiptStates(spark, str(tmp_path))
    broken = log.withColumn("tran_qty", F.when(F.col("item_number") == "e", F.raise_error(F.lit("lost")).cast("double")).otherwise(1.0))
    with pytest.raises(Exception, match="lost"):
        states.fold(broken, DAYS[:3])
    assert states.days() == set() and states.read().count() == 0
    assert states.fold(log.limit(0)) == set()
