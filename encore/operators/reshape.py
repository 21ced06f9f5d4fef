"""Long <-> wide reshapes with fixed output schemas.

Every cast takes its cell list up front (season/set values from the spec), so
the output schema is known without a distinct-values job, and the cast is a
single ``groupBy(key).agg(...)`` of conditional aggregates: partial aggregation
runs map-side and one shuffle on the key does the rest, however hot a key is.
"""

from __future__ import annotations

from typing import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str],
         variable: str = "variable", value: str = "value", cast: str | None = None) -> DataFrame:
    """Wide -> long (``unpivot``); value columns are cast to one type first."""
    cols = [F.col(f"`{c}`").cast(cast).alias(c) if cast else F.col(f"`{c}`") for c in values]
    return df.select(*[F.col(i) for i in ids], *cols).unpivot(list(ids), list(values), variable, value)


def has_duplicates(df: DataFrame, keys: Sequence[str]) -> bool:
    """True when some key combination occurs more than once (one small aggregate job)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count() > 0


def quoted(v: str) -> str:
    """``v`` as a SQL text literal."""
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def cell(conds: Mapping[str, str]) -> str:
    """SQL condition of a cell."""
    return " AND ".join(f"`{k}` = {quoted(v)}" for k, v in conds.items())


def cast_cells(df: DataFrame, key: str, cells: Sequence[tuple[str, str | Column | Mapping[str, str], str]], extra_aggs: Sequence[Column] = (),
               on_duplicate: str = "count", duplicates: bool | None = None, check: str = "subquery",
               keys_for_check: Sequence[str] | None = None, by_cell: Sequence[Column] | None = None,
               widened: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One ``groupBy(key).agg`` of conditional cells plus ``extra_aggs`` under the duplicate rule.

    With ``by_cell`` the rows are first reduced to one for each ``keys_for_check`` (which then hold every
    column that a cell's condition reads): the value columns' maxima, the row count ``__rows`` and the
    aggregates of ``by_cell``; ``extra_aggs`` then read those, and what ``widened`` joins to them. Flag and cells come from that one shuffle.

    ``cells`` lists ``(output name, condition, value column)``; conditions are SQL text, columns or the texts that columns equal
    (``{column: value, ...}``). Where reduced rows are one for each such set of texts, a key's rows become one map and each cell
    is looked up there: hundreds of conditional aggregates, text among them, would be sorted and run uncompiled. How an unknown
    duplicate status is found (``check``):

    * ``"subquery"`` (default, fully lazy): the single aggregation keeps both the
      value and the row count of every cell; the flag is a scalar subquery bound to
      one column (over the reduced rows, or without ``by_cell`` over a key-only
      aggregate), and each cell picks count or value from it. If a query never reads the family, Catalyst
      prunes the family and its check together.
    * ``"prepass"``: an eager key-only aggregate decides before planning.
    * ``"checkpoint"``: values and counts are written once to the shared
      checkpoint folder and the flag is read back from that per-key table.
    """
    if on_duplicate not in ("count", "first", "error"):
        raise ValueError(on_duplicate)
    cells = list(cells)
    types = dict(df.dtypes)
    reduced = by_cell is not None
    by = list(cells[0][1]) if cells and isinstance(cells[0][1], Mapping) else []
    mapped = (reduced and by and all(isinstance(m, Mapping) and list(m) == by for _, m, _ in cells) and {key, *by} == set(keys_for_check or ())
              and all(types[c] == "string" for c in by))
    if not mapped:
        cells = [(n, cell(m) if isinstance(m, Mapping) else m, v) for n, m, v in cells]
    if reduced:
        if not keys_for_check:
            raise ValueError("by_cell needs keys_for_check")
        maxima = [F.max(v).alias(v) for v in dict.fromkeys(v for _, _, v in cells) if v not in keys_for_check]
        df = df.groupBy(*keys_for_check).agg(F.count(F.lit(1)).alias("__rows"), *maxima, *by_cell)
    rows_of = widened or (lambda d: d)
    if mapped:
        return _mapped_cells(df, key, cells, by, types, extra_aggs, on_duplicate, duplicates, check, rows_of)

    # conditions as text are put into SQL text: a cast has hundreds of cells, and each would cost a dozen calls as a Column
    def rows(cond: str | Column) -> Column:
        if isinstance(cond, str):
            return F.expr(f"coalesce(sum(CASE WHEN {cond} THEN `__rows` END), 0)" if reduced else f"count(CASE WHEN {cond} THEN 1 END)")
        return F.coalesce(F.sum(F.when(cond, F.col("__rows"))), F.lit(0)) if reduced else F.count(F.when(cond, F.lit(1)))

    def values() -> list[Column]:
        return [F.expr(f"max(CASE WHEN {cond} THEN `{v}` END) AS `{n}`") if isinstance(cond, str) else F.max(F.when(cond, F.col(v))).alias(n)
                for n, cond, v in cells]

    def as_value_type(c: str, v: str) -> str:
        return f"CAST({c} AS STRING)" if types.get(v) == "string" else c

    def counts(suffix: str = "", typed: bool = False) -> list[Column]:
        number = [(n, rows(cond).cast("double"), v) for n, cond, v in cells]
        return [(c.cast("string") if typed and types.get(v) == "string" else c).alias(n + suffix) for n, c, v in number]

    if on_duplicate == "first":
        return rows_of(df).groupBy(key).agg(*values(), *extra_aggs)
    if duplicates is None and (check == "prepass" or on_duplicate == "error"):
        if not keys_for_check:
            raise ValueError("the duplicate check needs keys_for_check")
        duplicates = (not df.where(F.col("__rows") > 1).isEmpty()) if reduced else has_duplicates(df, keys_for_check)
    if duplicates is not None:
        if duplicates and on_duplicate == "error":
            raise ValueError("duplicate cell keys")
        if duplicates:
            return rows_of(df).groupBy(key).agg(*counts(typed=True), *extra_aggs)
        return rows_of(df).groupBy(key).agg(*values(), *extra_aggs)
    names = {n for n, _, _ in cells}
    if check == "checkpoint":
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        most = F.greatest(*[rows(cond) for _, cond, _ in cells]) if len(cells) > 1 else rows(cells[0][1])
        both = rows_of(df).groupBy(key).agg(*values(), *counts("__n"), *extra_aggs, most.alias("__most")).checkpoint(eager=True)
        dup = (both.agg(F.max("__most")).first()[0] or 0) > 1
        extra = [c for c in both.columns if c not in names and c != key and c != "__most" and not c.endswith("__n")]
        chosen = [f"{as_value_type(f'`{n}__n`', v)} AS `{n}`" if dup else f"`{n}`" for n, _, v in cells]
        return both.selectExpr(f"`{key}`", *chosen, *[f"`{c}`" for c in extra])
    if check != "subquery":
        raise ValueError(check)
    if not keys_for_check:
        raise ValueError("the duplicate check needs keys_for_check")
    if reduced:
        flag = _repeated(df)
    else:
        flag = (df.groupBy(*keys_for_check).agg(F.count(F.lit(1)).alias("_c"))
                .select(F.coalesce(F.max("_c"), F.lit(0)) > 1).scalar())
    both = rows_of(df).groupBy(key).agg(*values(), *counts("__n"), *extra_aggs).withColumn("__dup", flag)
    extra = [c for c in both.columns if c not in names and c != key and c != "__dup" and not c.endswith("__n")]
    chosen = [f"CASE WHEN `__dup` THEN {as_value_type(f'`{n}__n`', v)} ELSE `{n}` END AS `{n}`" for n, _, v in cells]
    return both.selectExpr(f"`{key}`", *chosen, *[f"`{c}`" for c in extra])


def _repeated(df: DataFrame) -> Column:
    """Whether any cell key of the reduced rows ``df`` had two rows, as a scalar subquery."""
    # the maximum of whole rows keeps their columns, so that the shuffle below is the cells' own one
    most = F.max(F.struct("__rows", *[F.col(f"`{c}`") for c in df.columns if c != "__rows"]))["__rows"]
    return df.select(F.coalesce(most, F.lit(0)) > 1).scalar()


def _mapped_cells(df: DataFrame, key: str, cells: Sequence[tuple[str, Mapping[str, str], str]], by: Sequence[str], types: Mapping[str, str],
                  extra_aggs: Sequence[Column], on_duplicate: str, duplicates: bool | None, check: str, rows_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """:func:`cast_cells` of reduced rows ``df``, one for each ``key`` and texts of the columns ``by``: cells looked up in a map by key."""
    if on_duplicate != "first" and duplicates is None and (check != "subquery" or on_duplicate == "error"):
        duplicates = not df.where(F.col("__rows") > 1).isEmpty()
    if on_duplicate == "error" and duplicates:
        raise ValueError("duplicate cell keys")
    flag = F.lit(False) if on_duplicate == "first" else F.lit(duplicates) if duplicates is not None else _repeated(df)
    sep = "\u0001"
    known = list(dict.fromkeys(sep.join(m[c] for c in by) for _, m, _ in cells))
    values = list(dict.fromkeys(v for _, _, v in cells))
    # texts without a cell stay out, and so does any text that holds the separator
    at = F.concat(*[x for c in by for x in (F.lit(sep), F.col(f"`{c}`"))][1:])
    entry = F.struct(at.alias("k"), F.struct(F.col("__rows").alias("n"), *[F.col(f"`{v}`").alias(f"v{i}") for i, v in enumerate(values)]).alias("v"))
    extra = [c for c in rows_of(df).groupBy(key).agg(*extra_aggs).columns if c != key] if extra_aggs else []
    both = (rows_of(df).groupBy(key).agg(F.map_from_entries(F.collect_list(F.when(at.isin(known), entry))).alias("__m"), *extra_aggs)
            .withColumn("__dup", flag))

    def one(n: str, m: Mapping[str, str], v: str) -> str:
        found = f"try_element_at(`__m`, {quoted(sep.join(m[c] for c in by))})"
        count = f"CAST(coalesce({found}.n, 0L) AS DOUBLE)"
        count = f"CAST({count} AS STRING)" if types.get(v) == "string" else count
        return f"CASE WHEN `__dup` THEN {count} ELSE {found}.v{values.index(v)} END AS `{n}`"

    return both.selectExpr(f"`{key}`", *[one(*c) for c in cells], *[f"`{c}`" for c in extra])


def cast_wide(df: DataFrame, key: str, cells: Iterable[tuple[str, Mapping[str, str], str]],
              on_duplicate: str = "count", keys_for_check: Sequence[str] | None = None,
              duplicates: bool | None = None, check: str = "subquery") -> DataFrame:
    """Long -> wide without an aggregate function (``dcast`` with one value per cell).

    ``cells`` lists ``(output name, {column: value, ...}, value column)``.
    ``on_duplicate``:

    * ``"count"`` – if *any* cell key occurs twice, every cell becomes the count
      of its rows (absent -> 0); otherwise cells hold their single value.
    * ``"first"`` – always the (deterministic: largest) value of the cell.
    * ``"error"`` – raise on duplicates.
    """
    cells = list(cells)
    cs = [(n, m, v) for n, m, v in cells]
    read = {key, *(c for _, m, _ in cells for c in m)}
    ks = list(keys_for_check) if keys_for_check else sorted(read)
    return cast_cells(df, key, cs, (), on_duplicate, duplicates, check, ks, () if read <= set(ks) else None)


def pivot_agg(df: DataFrame, key: str, pivot_col: str, values: Sequence[str], agg: str,
              value_col: str | None = None, names: Sequence[str] | None = None,
              fill: float | None = 0.0) -> DataFrame:
    """``groupBy(key).pivot(col, values)`` with count/sum; absent cells -> ``fill``."""
    g = df.groupBy(key).pivot(pivot_col, list(values))
    if agg == "count":
        w = g.agg(F.count(F.lit(1)))
    elif agg == "sum":
        w = g.agg(F.sum(value_col))
    else:
        raise ValueError(agg)
    names = list(names) if names else list(values)
    out = [F.col(key)]
    for v, n in zip(values, names):
        c = F.col(f"`{v}`").cast("double")
        out.append((F.coalesce(c, F.lit(fill)) if fill is not None else c).alias(n))
    return w.select(*out)


def rename_first_hyphen(df: DataFrame) -> DataFrame:
    """Replace only the first '-' of every column name by '_'."""
    return df.toDF(*[c.replace("-", "_", 1) for c in df.columns])


def prefix_columns(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    ren = set(cols)
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) if c in ren else F.col(f"`{c}`") for c in df.columns])
