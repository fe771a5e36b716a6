"""Null-safe column helpers (P1, F12-F16) and exact money sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Money is double in the tables; sums run in DECIMAL so totals do not depend on the order
# in which partitions are combined (retries and re-partitioning give the same bits).
MONEY_SUM_TYPE = "decimal(38,6)"


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as a column that is computed once for each row, whatever reads it. The
    optimizer copies the expressions of a projection into their readers (a JSON parse once for
    each field that is read); it cannot do so through a generator, here over an array of one."""
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*kept, F.explode_outer(F.array(value)).alias(name))


def column_type(df: DataFrame, name: str) -> T.DataType | None:
    dtype: T.DataType = df.schema
    for part in name.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            return None
        dtype = dtype[part].dataType
    return dtype


def conform(c: Column, actual: T.DataType, target: T.DataType) -> Column:
    """``c`` (of type ``actual``) reshaped to ``target``: struct fields matched by name
    (missing ones become typed nulls, extra ones are dropped), arrays element-wise, scalars
    with ``try_cast`` (bad values become null). Incompatible shapes give null."""
    if actual == target:
        return c
    if isinstance(target, T.StructType) and isinstance(actual, T.StructType):
        have = {f.name: f.dataType for f in actual.fields}
        fields = [
            (conform(c[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(target, T.ArrayType) and isinstance(actual, T.ArrayType):
        return F.transform(c, lambda x: conform(x, actual.elementType, target.elementType))
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(actual, nested) or isinstance(target, nested):
        return F.lit(None).cast(target)
    return c.try_cast(target)


def safe_col(df: DataFrame, name: str, dtype: T.DataType = T.StringType()) -> Column:
    """The column as ``dtype`` when present (conformed: bad values become null, nested
    values are matched field by field), a typed null when absent. Works for nested paths."""
    current = column_type(df, name)
    if current is None:
        return F.lit(None).cast(dtype)
    return conform(F.col(name), current, dtype)


def all_not_null(columns: list[str]) -> Column:
    """True when every one of ``columns`` is non-null (a row's business key is complete)."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return cond


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` when the denominator is > 0, else null."""
    return F.when(denominator > 0, F.try_divide(numerator, denominator))


def percentage(part: Column, whole: Column) -> Column:
    """part / whole * 100 as double (null when whole is 0)."""
    return (F.try_divide(part, whole) * F.lit(100)).cast("double")


def count_where(condition: Column) -> Column:
    """F16: number of rows where ``condition`` is true (null counts as false)."""
    return F.count(F.when(condition, F.lit(1)))


def money_sum(c: Column | str) -> Column:
    """Exact sum of a money column, returned as DECIMAL(38,6)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(MONEY_SUM_TYPE))



def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """replace nulls by 0 in the given columns."""
    return df.fillna(0, subset=columns)
