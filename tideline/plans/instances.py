"""One pull over several instances that hold tables of the same form."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import replace
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tideline.operators.incremental import processing_order, progress_columns, pull
from tideline.operators.messages import to_messages
from tideline.plans.pull import PullResult
from tideline.sources.progress import ProgressStore
from tideline.specs import Progress, PullSettings, TableSpec

INSTANCE = "instance"


def instance_spec(spec: TableSpec) -> TableSpec:
    """``spec`` with keys that tell equal identifiers of two instances apart."""
    fields = spec.key_fields if spec.key_mode == "field_based" else (spec.id_col,)
    if spec.key_mode == "round_robin":
        return spec
    return replace(spec, key_mode="field_based", key_fields=(INSTANCE, *fields))


def progress_name(instance: str, spec: TableSpec) -> str:
    return f"{instance}.{spec.name}"


def pull_instances(
    tables: Mapping[str, DataFrame],
    spec: TableSpec,
    store: ProgressStore,
    sink: Any,
    *,
    now: datetime,
    settings: PullSettings = PullSettings(),
) -> dict[str, PullResult]:
    """Publish what is due in every instance as one job, then move the position of each.

    Rows get a column ``instance``, which is part of the message and of its key.  Each instance has a position of its own, so a
    slow clock or an empty table in one holds up no other.  ``batch_size`` counts for each instance.  If the
    publisher is lost between two positions, the instances not yet moved are published again.
    """
    if not tables:
        return {}
    if settings.placement != "as_read":
        raise ValueError("a pull of several instances publishes rows as they are read")
    held = [name for name, df in tables.items() if INSTANCE in df.columns]
    if held:
        raise ValueError(f"tables with a column {INSTANCE!r} of their own: {held}")
    before = {name: store.get(progress_name(name, spec)) for name in tables}
    parts = [
        pull(
            df,
            spec,
            before[name],
            now=now,
            delay_seconds=settings.delay_seconds,
            initial_hours=settings.initial_hours,
            limit=settings.batch_size,
        ).withColumn(INSTANCE, F.lit(name))
        for name, df in tables.items()
    ]
    rows = reduce(DataFrame.unionByName, parts)
    start = "|".join(f"{name}|{p.ts}|{p.last_identifier}" for name, p in sorted(before.items()))
    batch = hashlib.md5(f"{spec.name}|{start}".encode()).hexdigest()
    seen = Observation(f"{spec.name}-{batch}")
    order = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(processing_order(rows.schema, spec))])
    observed = []
    for i, name in enumerate(tables):
        mine = F.col(INSTANCE) == name
        ts, ident = progress_columns(rows.schema, spec, settings.progress_mode, F.when(mine, order))
        observed += [ts.alias(f"ts{i}"), ident.alias(f"id{i}"), F.count(F.when(mine, 1)).alias(f"rows{i}")]
    keyed = instance_spec(spec)
    place = processing_order(rows.schema, spec) if getattr(sink, "takes_order", False) else ()
    sink.publish(to_messages(rows.observe(seen, *observed), keyed, settings.topic_prefix, settings.header, place), batch)
    last, out = seen.get, {}
    for i, name in enumerate(tables):
        found, was = last.get(f"rows{i}", 0), before[name]
        if found:
            ident = last.get(f"id{i}")
            was = Progress(last.get(f"ts{i}") or was.ts, was.last_identifier if ident is None else ident)
            store.set(progress_name(name, spec), was)
            store.flush(progress_name(name, spec))
        out[name] = PullResult(spec.name, found, was)
    return out
