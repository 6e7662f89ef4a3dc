import datetime as dt

from dockplan import config
from dockplan.operators import receipts
from dockplan.sources.schemas import PROCUREMENT_DOCS, RECEIPT_LOG, VENDORS

CFG = config.snapshot_report(dt.date(2000, 1, 1), "W1")
D0, D1 = dt.date(2019, 1, 5), dt.date(2019, 3, 5)


def _inputs(spark, docs):
    r = spark.createDataFrame(
        [("W1", "D1", "a", 151, 10.0, D0), ("W1", "D1", "b", 151, 10.0, D0), ("W1", "D1", "c", 151, 10.0, D0),
         ("W1", "D2", "a", 151, 10.0, D1), ("W1", "D2", "a", 951, 99.0, D1), ("W1", "D2", "z", 151, 0.0, D1),
         ("W2", "D1", "q", 151, 7.0, D0)], RECEIPT_LOG)
    d = spark.createDataFrame(docs, PROCUREMENT_DOCS)
    v = spark.createDataFrame([(1, "V1", "One")], VENDORS)
    return r, d, v


def test_upt_mean_of_documents(spark):
    r, d, v = _inputs(spark, [("D1", 1, "Purchase"), ("D2", 1, "Purchase"), ("D3", 1, "Transfer")])
    per_doc = {x["control_number"]: x for x in receipts.receipt_upt_by_document(r, d, v, CFG).collect()}
    assert per_doc["D1"]["upt"] == 10.0 and per_doc["D1"]["num_unique_skus"] == 3
    assert per_doc["D2"]["upt"] == 10.0 and per_doc["D2"]["num_units"] == 10.0
    upt = receipts.vendor_upt(r, d, v, CFG).collect()
    assert len(upt) == 1 and upt[0]["avg_upt"] == 10.0


def test_document_fanout_kept(spark):
    r, d, v = _inputs(spark, [("D1", 1, "Purchase"), ("D1", 1, "Purchase")])
    x = receipts.receipt_upt_by_document(r, d, v, CFG).collect()
    assert len(x) == 1 and x[0]["num_units"] == 60.0 and x[0]["num_unique_skus"] == 3 and x[0]["upt"] == 20.0


def test_transfer_documents_dropped(spark):
    r, d, v = _inputs(spark, [("D1", 1, "Transfer")])
    assert receipts.vendor_upt(r, d, v, CFG).count() == 0


def test_since_keeps_recent_receipts(spark):
    r, d, v = _inputs(spark, [("D1", 1, "Purchase"), ("D2", 1, "Purchase")])
    recent = receipts.receipt_upt_by_document(r, d, v, CFG.with_(upt_since=dt.date(2019, 2, 1))).collect()
    assert [x["control_number"] for x in recent] == ["D2"]
