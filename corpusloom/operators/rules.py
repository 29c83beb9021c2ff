"""Declarative filter rules: every rule is judged on every row, failures are named in the order of the rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.core.rows import dotted, kind_of

_NUMBERS = (T.NumericType,)


def _reasons(df: DataFrame) -> Column:
    return F.col("removal_reasons") if "removal_reasons" in df.columns else F.lit(None).cast("array<string>")


def _number(df: DataFrame, key: str) -> Column | None:
    kind = kind_of(df, key)
    if isinstance(kind, T.BooleanType):
        return dotted(df, key).cast("int")
    return dotted(df, key) if isinstance(kind, _NUMBERS) else None


def _no_removal_reasons(df: DataFrame) -> Column:
    return F.coalesce(F.size(_reasons(df)), F.lit(0)) <= 0


def _reject_if_reason(df: DataFrame, reason: str) -> Column:
    return ~F.coalesce(F.array_contains(_reasons(df), reason), F.lit(False))


def _min_metric(df: DataFrame, key: str, value: float) -> Column:
    """A missing value fails; not-a-number is never at least anything."""
    v = _number(df, key)
    return F.lit(False) if v is None else F.coalesce((v >= F.lit(value)) & ~F.isnan(v.cast("double")), F.lit(False))


def _max_metric(df: DataFrame, key: str, value: float) -> Column:
    """A missing value passes; not-a-number is never at most anything."""
    v = _number(df, key)
    return F.lit(True) if v is None else F.coalesce((v <= F.lit(value)) & ~F.isnan(v.cast("double")), F.lit(True))


def _require_true(df: DataFrame, key: str) -> Column:
    """Truth as in Python: of numbers, strings and collections too; a missing value fails."""
    v, kind = dotted(df, key), kind_of(df, key)
    if v is None:
        return F.lit(False)
    if isinstance(kind, T.BooleanType):
        truth = v
    elif isinstance(kind, _NUMBERS):
        truth = v != 0
    elif isinstance(kind, T.StringType):
        truth = F.length(v) > 0
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        truth = F.size(v) > 0
    else:
        truth = v.isNotNull()
    return F.coalesce(truth, F.lit(False))


def _not_contains(df: DataFrame, key: str, substring: str) -> Column:
    """Values that are missing or no strings pass."""
    v = dotted(df, key)
    if v is None or not isinstance(kind_of(df, key), T.StringType):
        return F.lit(True)
    return F.coalesce(~F.contains(v, F.lit(substring)), F.lit(True))


LIBRARY: dict[str, Callable[..., Column]] = {
    "no_removal_reasons": _no_removal_reasons,
    "reject_if_reason": _reject_if_reason,
    "min_metric": _min_metric,
    "max_metric": _max_metric,
    "require_true": _require_true,
    "not_contains": _not_contains,
}


def check_rules(rules: list[dict]) -> None:
    seen = set()
    for rule in rules:
        name = rule.get("name")
        if not name:
            raise ValueError(f"a rule needs a name: {rule}")
        if name in seen:
            raise ValueError(f"two rules are named {name!r}")
        if rule.get("type") not in LIBRARY:
            raise ValueError(f"rule {name!r} has an unknown type {rule.get('type')!r}. Available: {sorted(LIBRARY)}")
        seen.add(name)


def judge(df: DataFrame, rules: list[dict], column: str = "filtered_by") -> DataFrame:
    """df with the names of the rules that each row fails."""
    check_rules(rules)
    failed = [F.when(~LIBRARY[r["type"]](df, **{k: v for k, v in r.items() if k not in ("name", "type")}), F.lit(r["name"])) for r in rules]
    return df.withColumn(column, F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>"))


def split(judged: DataFrame, column: str = "filtered_by") -> tuple[DataFrame, DataFrame]:
    """(survivors without the column, rejects with it): together all rows."""
    # a column that is not deterministic keeps the filter above the rules, so that none of them is evaluated twice (streams have no such column)
    held = judged if judged.isStreaming else judged.withColumn(column, F.when(F.monotonically_increasing_id() >= 0, F.col(column)))
    return held.where(F.size(column) == 0).drop(column), held.where(F.size(column) > 0)


def statistics(judged: DataFrame, rules: list[dict], column: str = "filtered_by") -> dict:
    """Counts per rule, and the funnel, where a row is charged to the first rule that it fails."""
    names = [r["name"] for r in rules]
    aggs = [F.count("*").alias("n"), F.count_if(F.size(column) == 0).alias("kept")]
    for i, n in enumerate(names):
        aggs += [F.count_if(F.array_contains(column, n)).alias(f"f{i}"), F.count_if(F.try_element_at(F.col(column), F.lit(1)) == n).alias(f"d{i}")]
    row = judged.agg(*aggs).first()
    left, funnel = row.n, []
    for i, n in enumerate(names):
        left -= row[f"d{i}"]
        funnel.append({"rule": n, "dropped": row[f"d{i}"], "remaining_after": left})
    return {
        "rows_total": row.n,
        "rows_survived": row.kept,
        "rows_rejected": row.n - row.kept,
        "survival_rate": row.kept / row.n if row.n else 0.0,
        "per_rule_failures": {n: row[f"f{i}"] for i, n in enumerate(names)},
        "funnel": funnel,
    }
