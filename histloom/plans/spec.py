"""Declarative history loads.

A ``LoadSpec`` says how one source shapes rows for a target (``derive``) and
which columns form the natural key.  ``run_load`` applies the shared
template, ``run_loads`` folds several specs into one work table::

    derive -> control columns -> DISTINCT -> classify against target (I/U/D)
           -> keep I/U -> current-row flag -> (update restarts begin) -> stamp

Catalyst pushes filters into the
source scans and prunes columns.  Derived rows are stored.  If no key occurs twice, they are
distinct and an open row is current; else DISTINCT and the current-row
flag move digests and dates only, and whole rows just where these leave a doubt.
The target join (skipped for an empty target) moves whole rows once.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.validity import is_open
from ..operators.history import (WIDE, audit_id_for, classify_changes, classify_stored, control_columns,
                                 distinct_stored, effective_target, keep_changes, keys_occur_once,
                                 mark_current, mark_current_stored, restart_begin_on_update)
from ..sources.fixtures import Sources
from ..sources.history_table import HistoryTable
from ..sources.io import cut_lineage, cuts_made, release_cuts
from . import targets as T


def _today(as_of) -> _dt.date | str:
    return _dt.date.today() if as_of is None else as_of


def _pinned(process_ts: Column | None) -> Column:
    """The process time as one literal: every row of a run has the same, however
    often its plan is evaluated."""
    return process_ts if process_ts is not None else F.lit(_dt.datetime.now().isoformat(sep=" "))


@dataclass(frozen=True)
class LoadSpec:
    name: str
    layout: list                        # target attribute columns [(name, type)]
    keys: tuple[str, ...]               # natural key (classification + current flag)
    derive: Callable[..., DataFrame]    # (Sources, as_of) -> attributes, check_sum, bounds
    batch_name: str = "Trac_to_CIP"
    source_system_id: str = "203"
    target_filter: Callable[[], Column] | None = None
    restart_begin_on_update: bool = False
    tags: tuple[str, ...] = field(default=())
    partition_keys: tuple[str, ...] | None = None   # of the current flag, if not the whole key


def target_columns(layout: list) -> list[tuple[str, str]]:
    return [*layout, *T.CONTROL]


def derived(spec: LoadSpec, src: Sources, as_of) -> DataFrame:
    """Derived rows with control columns, typed to the target."""
    d = spec.derive(src, as_of)
    d = control_columns(d, spec.source_system_id, audit_id_for(src.audit, spec.batch_name))
    cols = [c for c in target_columns(spec.layout)
            if c[0] not in ("row_process_dtm", "current_row_ind")]
    return T.conform(d, cols)


def prepared(spec: LoadSpec, src: Sources, as_of) -> DataFrame:
    """Derived rows, de-duplicated."""
    return derived(spec, src, as_of).distinct()


def _load(specs: Sequence[LoadSpec], src: Sources, target: DataFrame | HistoryTable | None, as_of,
          process_ts: Column | None, materialize: bool) -> DataFrame:
    """The new rows of specs that share no key.  With ``materialize`` derived rows are stored;
    what is stored on the way goes as soon as nothing reads it."""
    lead = specs[0]
    if not materialize:
        rows = reduce(DataFrame.unionByName, [prepared(s, src, as_of) for s in specs])
        return finish(lead, rows, target, as_of, process_ts, False)
    made = cuts_made()
    stored = cut_lineage(reduce(DataFrame.unionByName, [derived(s, src, as_of) for s in specs]))
    single = keys_occur_once(stored, lead.partition_keys or lead.keys)
    rows = stored if single else distinct_stored(stored)
    if rows is not stored and (target is None or len(rows.columns) >= WIDE):
        rows = cut_lineage(rows)
        release_cuts(rows.sparkSession, made, rows)
    new = finish(lead, rows, target, as_of, process_ts, True, single)
    release_cuts(new.sparkSession, made, new)
    return new


def finish(spec: LoadSpec, rows: DataFrame, target: DataFrame | HistoryTable | None, as_of,
           process_ts: Column | None, materialize: bool = True, single: bool = False) -> DataFrame:
    """``single``: no key has two rows."""
    tf = spec.target_filter() if spec.target_filter else None
    joined = target is not None
    if isinstance(target, HistoryTable):
        c = target.classify(rows, tf)
    elif joined and materialize and len(rows.columns) >= WIDE:
        c, joined = classify_stored(rows, target, spec.keys, tf)
    else:
        c = classify_changes(rows, target, spec.keys, tf)
    c = keep_changes(c)
    if materialize and joined:
        # The current-row flag reads the rows several times; store them, so that
        # change capture runs a single time.  (``rows`` are stored already.)
        c = cut_lineage(c)
    if single:
        c = c.withColumn("current_row_ind", is_open("end_dt"))
    else:
        c = (mark_current_stored if materialize else mark_current)(c, spec.partition_keys or spec.keys)
    if spec.restart_begin_on_update:
        c = restart_begin_on_update(c, as_of)
    c = c.withColumn("row_process_dtm", _pinned(process_ts).cast("timestamp_ntz"))
    return T.conform(c, target_columns(spec.layout))


def run_load(spec: LoadSpec, src: Sources, target: DataFrame | HistoryTable | None = None,
             as_of=None, process_ts: Column | None = None,
             materialize: bool = True) -> DataFrame:
    """One INSERT...SELECT of the template: the new I/U rows for ``target`` (rows, or
    a stored history).  ``as_of`` is the current date by default."""
    return _load([spec], src, target, _today(as_of), process_ts, materialize)


def run_loads(specs: Sequence[LoadSpec], src: Sources, history: DataFrame | None = None,
              as_of=None, process_ts: Column | None = None,
              independent: bool = False, materialize: bool = True) -> DataFrame:
    """Several specs into one work table.

    Sequential (default): each spec is classified against the rows the earlier
    specs produced (and, when ``history`` is given, the conformed history per
    ``effective_target``).  With ``materialize`` each spec's rows are stored
    as parquet in the shared checkpoint folder, so later specs read them
    instead of recomputing earlier ones.

    ``independent=True`` when the specs' keys cannot overlap (a type or role
    code is part of the key): all derived rows go through one classify and
    one current-flag pass -- one set of shuffles instead of one per spec."""
    rounds = [specs] if independent else [[s] for s in specs]
    return run_rounds(rounds, src, history, as_of, process_ts, materialize)


def run_rounds(rounds: Sequence[Sequence[LoadSpec]], src: Sources, history: DataFrame | None = None,
               as_of=None, process_ts: Column | None = None, materialize: bool = True) -> DataFrame:
    """Rounds of specs into one work table.  The specs of a round cannot share a
    key and go through one classify and one current-flag pass; each round is
    compared with the rows of the earlier ones."""
    as_of, process_ts = _today(as_of), _pinned(process_ts)
    if any(s.partition_keys != specs[0].partition_keys for specs in rounds for s in specs):
        raise ValueError("the specs of a round share one current-row flag: their partition_keys must agree")
    work: DataFrame | None = None
    for specs in rounds:
        lead = specs[0]
        target = work if history is None else effective_target(history, work, lead.keys, distinct=False)
        new = _load(specs, src, target, as_of, process_ts, materialize)
        work = new if work is None else work.unionByName(new)
    return work


def run_stored(specs: Sequence[LoadSpec], src: Sources, history: HistoryTable, as_of=None,
               process_ts: Column | None = None) -> list[DataFrame]:
    """Each spec's new versions, compared with the stored history and appended to it
    before the next spec; returns them by spec."""
    as_of, process_ts = _today(as_of), _pinned(process_ts)
    out = []
    for spec in specs:
        new = cut_lineage(run_load(spec, src, history, as_of, process_ts))
        history.append(new)
        out.append(new)
    return out


def checked_output(df: DataFrame) -> DataFrame:
    """Deterministic, driver-comparable view of a load result: drops the
    process timestamp and renders ``*_dtm`` timestamps as text (sentinel
    years 0001/9999 do not fit Python/pandas timestamps)."""
    cols = []
    for c, t in df.dtypes:
        if c == "row_process_dtm":
            continue
        cols.append(F.col(c).cast("string").alias(c) if t.startswith("timestamp") else F.col(c))
    return df.select(*cols)
