"""Vendor ordering and receiving plans on Spark DataFrames."""

from dockplan.config import PlanConfig, horizon_report, snapshot_report, weekly_plan

__all__ = ["PlanConfig", "horizon_report", "snapshot_report", "weekly_plan"]
