"""DuckDB SQL text for the correctness oracle.

The oracle is written the way the original warehouse SQL is: DISTINCT, a LEFT
JOIN to the current target rows, a CASE for I/U/D and ``ROW_NUMBER()`` for the
current-row flag -- deliberately *not* the aggregate+join plan the Spark
library uses, so the two cross-check each other.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from .layouts import CONTROL, STORED_ORDER, VERSION_ORDER

OPEN = "DATE '9999-12-31'"
NULL_S = "CAST(NULL AS VARCHAR)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def cs(x: str) -> str:
    """clean_string"""
    return f"nullif(trim(CAST({x} AS VARCHAR)), '')"


def ph(*xs: str) -> str:
    """prehash_value"""
    return "concat_ws('|', " + ", ".join(f"coalesce({cs(x)}, '~')" for x in xs) + ")"


def hu(t: str) -> str:
    """hash_uuid"""
    m = f"md5({t})"
    return (f"(substr({m},1,8)||'-'||substr({m},9,4)||'-'||substr({m},13,4)||'-'||"
            f"substr({m},17,4)||'-'||substr({m},21,12))")


def hk(*xs: str) -> str:
    return hu(ph(*xs))


def norm(x: str) -> str:
    return f"upper(trim(CAST({x} AS VARCHAR)))"


def flag(x: str, value: str = "Y") -> str:
    return f"coalesce({norm(x)} = {q(value)}, false)"


def itxt(x: str) -> str:
    return f"CAST(CAST({x} AS INTEGER) AS VARCHAR)"


def tobool(x: str) -> str:
    n = norm(x)
    return (f"(CASE WHEN {n} IN ('T','TRUE','Y','YES','1') THEN true "
            f"WHEN {n} IN ('F','FALSE','N','NO','0') THEN false ELSE CAST(NULL AS BOOLEAN) END)")


def yn_bool(x: str) -> str:
    n = norm(x)
    return f"(CASE WHEN {n} = 'Y' THEN true WHEN {n} = 'N' THEN false ELSE CAST(NULL AS BOOLEAN) END)"


def audit(batch: str) -> str:
    return (f"(SELECT audit_id FROM src_audit WHERE record_aligner = 1 "
            f"AND batch_name = {q(batch)})")


def duck_type(t: str) -> str:
    t = t.lower()
    if t == "string":
        return "VARCHAR"
    if t == "int":
        return "INTEGER"
    if t.startswith("timestamp"):
        return "TIMESTAMP"
    return t.upper()


def bounds(begin: str | None, end: str | None, default_begin: str | None = None,
           default_end: str | None = "9999-12-31") -> dict[str, str]:
    def d(c, default):
        if c is None:
            return f"DATE {q(default)}" if default else "CAST(NULL AS DATE)"
        e = f"CAST({c} AS DATE)"
        return f"coalesce({e}, DATE {q(default)})" if default else e
    b, e = d(begin, default_begin), d(end, default_end)
    return {"begin_dt": b, "begin_dtm": f"CAST({b} AS TIMESTAMP)",
            "end_dt": e, "end_dtm": f"CAST({e} AS TIMESTAMP)"}


@dataclass
class SqlSpec:
    """One load's derived rows: ``FROM`` clause, optional ``WHERE`` and the
    column expressions (attributes, ``check_sum`` and bounds)."""
    layout: list
    keys: tuple
    from_sql: str
    cols: dict
    where: str | None = None
    batch: str = "Trac_to_CIP"
    source_system_id: str = "203"
    target_filter: str | None = None
    restart_as_of: str | None = None
    fixtures: list = field(default_factory=list)
    flag_keys: tuple | None = None


def control() -> list[tuple[str, str]]:
    return CONTROL


def prepared_cols(layout) -> list[tuple[str, str]]:
    return [c for c in [*layout, *control()] if c[0] not in ("row_process_dtm", "current_row_ind")]


def rank_cols(layout, keys) -> list[str]:
    cols = [c for c, _ in prepared_cols(layout)]
    order = [c for c in VERSION_ORDER if c in cols]
    return order + [c for c in cols if c not in keys and c not in order]


def _prepared_select(s: SqlSpec, rename=lambda sql: sql) -> str:
    exprs = dict(s.cols)
    exprs.setdefault("audit_id", audit(s.batch))
    exprs.setdefault("source_system_id", q(s.source_system_id))
    exprs.setdefault("restricted_row_ind", "false")
    exprs.setdefault("logical_delete_ind", "false")
    sel = []
    for c, t in prepared_cols(s.layout):
        e = exprs.get(c, "NULL")
        sel.append(f"CAST({e} AS {duck_type(t)}) AS {c}")
    where = f"\nWHERE {s.where}" if s.where else ""
    return rename(f"SELECT DISTINCT {', '.join(sel)}\nFROM {s.from_sql}{where}")


def _not_superseded(history: str, work: str, keys: list[str]) -> str:
    """History rows without a current open work row of the key and another checksum."""
    same = " AND ".join(f"w.{k} = h.{k}" for k in keys)
    return (f"SELECT h.* FROM {history} h WHERE NOT EXISTS (SELECT 1 FROM {work} w WHERE {same} "
            f"AND coalesce(w.current_row_ind, false) AND w.end_dt = {OPEN} AND w.check_sum <> h.check_sum)")


def load_ctes(specs: list[SqlSpec], prefix: str, independent: bool = False, history: str | None = None,
              load_no: int = 1, rename=lambda sql: sql) -> tuple[list[str], str]:
    """CTEs computing the work table of ``specs`` (folded in order, compared with
    ``history`` too if given); returns (cte list, name of the final work CTE).
    Each row carries the number of its load."""
    ctes: list[str] = []
    lead = specs[0]
    keys = list(lead.keys)
    flag_keys = list(lead.flag_keys or keys)
    out_cols = [c for c, _ in [*lead.layout, *control()] if c != "row_process_dtm"]
    ranked = rank_cols(lead.layout, flag_keys)
    order_by = ", ".join(f"{c} DESC NULLS LAST" for c in ranked)
    torder = ", ".join(f"{x} DESC NULLS LAST" for x in STORED_ORDER)
    groups = [specs] if independent else [[s] for s in specs]
    work = None
    for i, group in enumerate(groups):
        p, c, n = f"{prefix}_p{i}", f"{prefix}_c{i}", f"{prefix}_n{i}"
        ctes.append(f"{p} AS ({' UNION ALL '.join('(' + _prepared_select(s, rename) + ')' for s in group)})")
        spec = group[0]
        if history and work:
            target = f"({_not_superseded(history, work, keys)} UNION ALL BY NAME SELECT * FROM {work})"
        else:
            target = work or history
        if target is None:
            ctes.append(f"{c} AS (SELECT {p}.*, 'I' AS change_type FROM {p})")
        else:
            t = f"{prefix}_t{i}"
            tf = f" AND ({spec.target_filter})" if spec.target_filter else ""
            ctes.append(
                f"{t} AS (SELECT {', '.join(keys)}, check_sum FROM (SELECT *, ROW_NUMBER() OVER "
                f"(PARTITION BY {', '.join(keys)} ORDER BY {torder}) AS rn FROM {target} tgt "
                f"WHERE coalesce(current_row_ind, false) AND end_dt = {OPEN}{tf}) x WHERE rn = 1)")
            on = " AND ".join(f"{p}.{k} = {t}.{k}" for k in keys)
            ctes.append(
                f"{c} AS (SELECT {p}.*, CASE WHEN {t}.{keys[0]} IS NULL THEN 'I' "
                f"WHEN {t}.check_sum <> {p}.check_sum THEN 'U' ELSE 'D' END AS change_type "
                f"FROM {p} LEFT JOIN {t} ON {on})")
        cur = (f"coalesce(ROW_NUMBER() OVER (PARTITION BY {', '.join(flag_keys)} ORDER BY {order_by}) = 1 "
               f"AND end_dt = {OPEN}, false)")
        sel = []
        for col in out_cols:
            if col == "current_row_ind":
                sel.append(f"{cur} AS current_row_ind")
            elif spec.restart_as_of and col in ("begin_dt", "begin_dtm"):
                typ = "DATE" if col == "begin_dt" else "TIMESTAMP"
                sel.append(f"CASE WHEN change_type = 'U' THEN CAST(DATE {q(spec.restart_as_of)} AS {typ}) "
                           f"ELSE {col} END AS {col}")
            else:
                sel.append(col)
        ctes.append(f"{n} AS (SELECT {', '.join(sel)}, {load_no} AS load_no FROM {c} WHERE change_type IN ('I','U'))")
        if work is None:
            work = n
        else:
            w = f"{prefix}_w{i}"
            ctes.append(f"{w} AS (SELECT * FROM {work} UNION ALL BY NAME SELECT * FROM {n})")
            work = w
    return ctes, work


def incremental_query(specs: list[SqlSpec], changes: dict[str, str], independent: bool = False) -> str:
    """Three batches: base, changed sources, the same again.  ``changes`` maps a
    source to the SQL of its changed form."""
    fixtures = ["src_audit", *changes]
    for s in specs:
        fixtures += s.fixtures
    changed = [f"{name}_changed AS ({sql})" for name, sql in changes.items()]

    def rename(sql: str) -> str:
        for name in changes:
            sql = re.sub(rf"\b{name}\b", f"{name}_changed", sql)
        return sql
    c1, w1 = load_ctes(specs, "A", independent)
    c2, w2 = load_ctes(specs, "B", independent, w1, 2, rename)
    both = f"H2 AS (SELECT * FROM {w1} UNION ALL BY NAME SELECT * FROM {w2})"
    c3, w3 = load_ctes(specs, "C", independent, "H2", 3, rename)
    cols = checked_select(specs[0].layout, "x").removesuffix(" FROM x")
    final = " UNION ALL ".join(f"{cols}, load_no AS batch_no FROM {w}" for w in (w1, w2, w3))
    return with_fixtures(fixtures, [*changed, *c1, *c2, both, *c3], final)


def checked_select(layout, source: str) -> str:
    """Output view matching ``checked_output``: no process time, *_dtm as text."""
    cols = []
    for c, t in [*layout, *control()]:
        if c == "row_process_dtm":
            continue
        cols.append(f"CAST({c} AS VARCHAR) AS {c}" if t.startswith("timestamp") else c)
    return f"SELECT {', '.join(cols)} FROM {source}"


def with_fixtures(fixtures: list[str], ctes: list[str], final: str) -> str:
    from histloom.sources.fixtures import sql_ctes
    head = sql_ctes(fixtures)
    body = ",\n".join(ctes)
    return f"{head},\n{body}\n{final}" if ctes else f"{head}\n{final}"


def load_query(specs: list[SqlSpec], independent: bool = False) -> str:
    fixtures = ["src_audit"]
    for s in specs:
        fixtures += s.fixtures
    ctes, work = load_ctes(specs, "L", independent)
    return with_fixtures(fixtures, ctes, checked_select(specs[0].layout, work))
