"""Incremental movement of changed rows between tables and logs, as Spark jobs."""

from tideline.specs import ApplySpec, Progress, PullSettings, TableSpec, TopicRoute

__all__ = ["ApplySpec", "Progress", "PullSettings", "TableSpec", "TopicRoute"]
