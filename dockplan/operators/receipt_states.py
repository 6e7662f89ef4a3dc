"""Receipt history as mergeable day states.

The source reads all receipts in every run. Here a day of receipts is folded once into its state: for every document the items it
received that day, with their units. States merge exactly, because a document's items are a set and its units a sum: any split of
the history into days, in any order, gives the units per transaction of the whole. So a run reads the days that are not folded yet,
and the states, which have at most one row for a day, site, document and item.

``ReceiptStates`` keeps them in a folder. A fold writes the states of its days, sorted by day, to a folder of its own, and then a
marker that names that folder, its number and its days. Of the folds that list a day the last one counts, so a day that is folded
again, because receipts came late or a run was repeated, replaces its state and is never added to it; a fold that died has no marker
and does not exist. ``compact`` writes all states that count as one fold.

Receipts of all sites are kept, of the one transaction type and with a quantity. Days may be null: those receipts are a day too.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockplan.config import PlanConfig
from dockplan.operators.receipts import countable_receipts, document_upt, mean_upt, received_since
from dockplan.sources.tables import at_location

KEYS = ("wh_id", "control_number", "item_number")
MARKER = "number long, folder string, days array<date>"


def day_states(receipts: DataFrame) -> DataFrame:
    """(wh_id, control_number, item_number, tran_date, tran_qty): the units of an item in a document on a day."""
    return countable_receipts(receipts).groupBy(*KEYS, "tran_date").agg(F.sum("tran_qty").alias("tran_qty"))


def merged(states: DataFrame) -> DataFrame:
    """States of any days as one row for a site, document and item; merging merged ones again gives the same."""
    return states.groupBy(*KEYS).agg(F.sum("tran_qty").alias("tran_qty"))


def upt_from_states(states: DataFrame, docs: DataFrame, vendors: DataFrame, cfg: PlanConfig) -> DataFrame:
    """``receipts.vendor_upt`` of the receipts that the states were folded from."""
    counted = received_since(at_location(states, "wh_id", cfg.locations), cfg)
    return mean_upt(document_upt(counted, docs, vendors))


def _listed(days: set) -> str:
    return ", ".join(f"DATE'{d.isoformat()}'" for d in sorted(days - {None}))


def on_days(days: Iterable) -> Column:
    """Rows of these days, as a predicate that the scan takes."""
    days = set(days)
    either = [f"tran_date IN ({_listed(days)})"] if days - {None} else []
    either += ["tran_date IS NULL"] if None in days else []
    return F.expr(" OR ".join(either) or "false")


def off_days(days: Iterable) -> Column:
    """Rows of all other days; a null day is a day."""
    days = set(days)
    known = f"tran_date NOT IN ({_listed(days)})" if days - {None} else "true"
    return F.expr(f"tran_date IS NOT NULL AND {known}" if None in days else f"tran_date IS NULL OR {known}")


class ReceiptStates:
    """The folded days in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _folds(self) -> list:
        try:
            return sorted(self.spark.read.schema(MARKER).json(f"{self.folder}/folds").collect(), key=lambda r: (r["number"], r["folder"]))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _owners(self) -> dict:
        """Day -> folder of the last fold that lists it. One entry a day of history."""
        return {day: fold["folder"] for fold in self._folds() for day in fold["days"]}

    def days(self) -> set:
        return set(self._owners())

    def missing(self, receipts: DataFrame) -> set:
        """Days of the receipts that are not folded; where the table is partitioned by day no receipt is read for it."""
        return self._days_of(receipts) - self.days()

    def _days_of(self, receipts: DataFrame) -> set:
        return {r[0] for r in receipts.select("tran_date").distinct().collect()}

    def _commit(self, states: DataFrame, days: set) -> None:
        folds = self._folds()
        folder = f"fold-{uuid.uuid4().hex}"
        states.sortWithinPartitions("tran_date").write.parquet(f"{self.folder}/{folder}")
        row = (max((f["number"] for f in folds), default=0) + 1, folder, sorted(days, key=lambda d: (d is not None, d)))
        self.spark.createDataFrame([row], MARKER).coalesce(1).write.mode("append").json(f"{self.folder}/folds")

    def fold(self, receipts: DataFrame, days: Iterable | None = None) -> set:
        """Fold the days of the receipts that are not folded yet, or all of ``days`` anew; the days that were folded.

        Only these days' receipts are read, and they must be complete: a day's state is replaced, not added to.
        """
        if days is None:
            there = self._days_of(receipts)
            days = there - self.days()
            others = there - days
            # The shorter list: a first fold has none.
            receipts = receipts.where(on_days(days) if len(days) <= len(others) else off_days(others)) if others else receipts
        else:
            days = set(days)
            receipts = receipts.where(on_days(days))
        if days:
            self._commit(day_states(receipts), days)
        return days

    def read(self) -> DataFrame:
        """The states of all folded days."""
        owners = self._owners()
        schema = "wh_id string, control_number string, item_number string, tran_date date, tran_qty double"
        out = self.spark.createDataFrame([], schema)
        for fold in self._folds():
            replaced = {d for d in fold["days"] if owners[d] != fold["folder"]}
            if len(replaced) == len(fold["days"]):
                continue
            states = self.spark.read.schema(schema).parquet(f"{self.folder}/{fold['folder']}")
            out = out.unionByName(states.where(off_days(replaced)) if replaced else states)
        return out

    def compact(self) -> None:
        """All states that count as one fold, so that reading opens one folder."""
        days = self.days()
        if days:
            self._commit(self.read(), days)
