"""Spec-driven group-by: plain, conditional, fused over many specs, two-level.

A spec is ``{header, groupby, num: {column: [functions]}, cat: [functions],
count, subset: {column_name, conditions}}``. All specs with the same key
become ONE group-by: a conditional spec aggregates ``when(condition, value)``,
and the inner alignment of its result is a filter on the counted rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from featherloom.functions import aggregates as agg
from featherloom.naming import aggregate_name, count_name, quoted
from featherloom.operators.joins import rollup_child
from featherloom.operators.rank import exact_quantiles
from featherloom.operators.schema import check_columns
from featherloom.report import Report, ensure


@dataclass
class _Part:
    """One spec, resolved against the table: its condition and output columns."""

    condition: Column | None
    outputs: list[tuple[str, str, str]]  # (name, function, column)


def _outputs(df: DataFrame, spec: Mapping, keys: Sequence[str],
             cat_cols: Sequence[str], report: Report) -> list[tuple[str, str, str]]:
    header = spec["header"]
    num, cat = spec.get("num", {}), list(spec.get("cat", []))
    wanted = {c: list(fs) for c, fs in num.items() if fs}
    if cat:
        # category functions replace the numeric ones of the same column
        wanted.update({c: cat for c in cat_cols})
    present, absent = check_columns(df, wanted)
    for c in absent:
        report.skip("aggregate", c, f"absent column of {header}")
    out = [(aggregate_name(header, c, f), f, c) for c in present for f in wanted[c]]
    for _, f, _ in out:
        if f not in agg.KNOWN:
            raise ValueError(f"unknown aggregate function: {f}")
    if spec.get("count", False):
        out.append((count_name(header, list(keys)), agg.ROW_COUNT, keys[0]))
    return out


def _present_keys(df: DataFrame, keys: Iterable[str], report: Report) -> tuple[str, ...]:
    present, absent = check_columns(df, keys)
    for k in absent:
        report.skip("aggregate", k, "absent key")
    return tuple(present)


def _grouped(df: DataFrame, keys: Sequence[str], parts: Sequence[_Part],
             align: str) -> DataFrame:
    names = [name for p in parts for name, _, _ in p.outputs]
    if len(names) != len(set(names)):
        raise ValueError(f"two specs produce the same column on {list(keys)}")
    types = {f.name: f.dataType for f in df.schema}
    key_cols = [quoted(k) for k in keys]
    for k in key_cols:
        df = df.filter(k.isNotNull())
    conditional = all(p.condition is not None for p in parts)
    if conditional and len(parts) == 1:
        df, parts = df.filter(parts[0].condition), [_Part(None, parts[0].outputs)]
        conditional = False
    rows = {i: f"__rows{i}" for i, p in enumerate(parts) if p.condition is not None}
    exprs = [F.count(F.when(parts[i].condition, 1)).alias(r) for i, r in rows.items()]
    ordered = []
    for p in parts:
        for name, function, column in p.outputs:
            if function == agg.ORDERED:
                ordered.append((p, name, column))
            else:
                exprs.append(agg.expression(function, quoted(column), types[column],
                                            p.condition).alias(name))
    out = df.groupBy(*key_cols).agg(*exprs) if exprs else df.select(*key_cols).distinct()
    for p, name, column in ordered:
        chosen = df if p.condition is None else df.filter(p.condition)
        out = out.join(exact_quantiles(chosen, column, [0.5], keys, [name]),
                       list(keys), "left")
    if align == "inner":
        for r in rows.values():
            out = out.filter(quoted(r) > 0)
    else:
        if align == "left" and 0 in rows:
            out = out.filter(quoted(rows[0]) > 0)
        elif align == "outer" and conditional:
            some = quoted(rows[0]) > 0
            for r in rows.values():
                some = some | (quoted(r) > 0)
            out = out.filter(some)
        # a key without rows under the condition has no value, not a zero
        zero = {name: F.when(quoted(rows[i]) > 0, quoted(name))
                for i, p in enumerate(parts) if i in rows
                for name, function, _ in p.outputs if function in agg.ZERO_WHEN_EMPTY}
        if zero:
            out = out.withColumns(zero)
    return out.select(*key_cols, *[quoted(n) for n in names])


def aggregate(df: DataFrame, by: str | Sequence[str],
              num: Mapping[str, Sequence[str]] | None = None,
              cat_cols: Sequence[str] = (), cat: Sequence[str] = (),
              header: str = "ALL", count: bool = False,
              report: Report | None = None) -> DataFrame:
    """One group-by with generated names; rows with a missing key are left out."""
    report = ensure(report)
    keys = _present_keys(df, [by] if isinstance(by, str) else by, report)
    if not keys:
        raise ValueError("no group-by column is present")
    spec = {"header": header, "num": num or {}, "cat": cat, "count": count}
    return _grouped(df, keys, [_Part(None, _outputs(df, spec, keys, cat_cols, report))],
                    "inner")


def group_count(df: DataFrame, by: str | Sequence[str], header: str) -> DataFrame:
    return aggregate(df, by, header=header, count=True)


def conditional_aggregate(df: DataFrame, spec: Mapping,
                          report: Report | None = None) -> DataFrame:
    """One aggregate over the rows its ``subset`` selects; dummies are left out."""
    report = ensure(report)
    keys = _present_keys(df, spec["groupby"], report)
    rule = spec["subset"]
    condition = quoted(rule["column_name"]).isin(list(rule["conditions"]))
    return _grouped(df, keys, [_Part(condition, _outputs(df, spec, keys, [], report))],
                    "inner")


def aggregate_specs(df: DataFrame, specs: Sequence[Mapping],
                    cat_cols: Sequence[str] = (), align: str = "inner",
                    occurring: Iterable[str] = (), drop_empty: bool = True,
                    report: Report | None = None) -> dict[tuple[str, ...], DataFrame]:
    """All specs over one table, one fused group-by per distinct key.

    ``align`` says which keys stay when specs differ: ``inner`` keeps a key
    only if every spec has rows for it. A spec whose subset selects no row of
    the whole table is skipped rather than emptying the result; that needs one
    small job unless the column is in ``occurring`` (dummies found in the data,
    tested for 1). ``drop_empty=False`` leaves the check out.
    """
    if align not in ("inner", "left", "outer"):
        raise ValueError(f"unknown alignment: {align}")
    report = ensure(report)
    occurring = set(occurring)
    groups: dict[tuple[str, ...], list[_Part]] = {}
    to_check: list[tuple[tuple[str, ...], _Part, str]] = []
    for spec in specs:
        header = spec["header"]
        keys = _present_keys(df, spec.get("groupby", []), report)
        if not keys:
            report.skip("aggregate", header, "no group-by column")
            continue
        rule = spec.get("subset") or {}
        if not rule:
            part = _Part(None, _outputs(df, spec, keys, cat_cols, report))
        else:
            column, values = rule.get("column_name"), list(rule.get("conditions", []))
            if column not in df.columns or not values:
                report.skip("aggregate", header, f"subset column {column} absent or no values")
                continue
            condition = F.coalesce(quoted(column).isin(values), F.lit(False))
            part = _Part(condition, _outputs(df, spec, keys, [], report))
            if drop_empty and not (column in occurring and 1 in values):
                to_check.append((keys, part, header))
        groups.setdefault(keys, []).append(part)
    if to_check:
        found = df.agg(*[F.max(p.condition & _has_key(keys)).alias(f"c{i}")
                         for i, (keys, p, _) in enumerate(to_check)]).first()
        for i, (keys, part, header) in enumerate(to_check):
            if not found[f"c{i}"]:
                report.skip("aggregate", header, "subset selects no rows")
                groups[keys] = [p for p in groups[keys] if p is not part]
    return {keys: _grouped(df, keys, parts, align)
            for keys, parts in sorted(groups.items()) if parts}


def _has_key(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & quoted(k).isNotNull()
    return out


def carried_categories(child_agg: DataFrame, child_dummies: Sequence[str]) -> list[str]:
    """Columns of a child aggregate that stem from its category columns, by whole name parts."""
    return [c for c in child_agg.columns if any(f"_{d}_" in f"_{c}_" for d in child_dummies)]


def two_level(child: DataFrame, parent: DataFrame, child_specs: Sequence[Mapping],
              parent_specs: Sequence[Mapping], link: str | Sequence[str],
              entity: str | Sequence[str], child_dummies: Sequence[str] = (),
              parent_dummies: Sequence[str] = (), align: str = "inner",
              occurring: Iterable[str] = (),
              report: Report | None = None) -> DataFrame:
    """Rolls a child up to its parent by ``link``, then the parent up to ``entity``."""
    link = (link,) if isinstance(link, str) else tuple(link)
    entity = (entity,) if isinstance(entity, str) else tuple(entity)
    rolled = aggregate_specs(child, child_specs, child_dummies, align, report=report)[link]
    joined = rollup_child(parent, rolled, link)
    categories = [*parent_dummies, *carried_categories(rolled, child_dummies)]
    return aggregate_specs(joined, parent_specs, categories, align, occurring,
                           report=report)[entity]
