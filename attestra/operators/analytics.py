"""Coverage, totals, contradictions, valuations: the relational operators behind the views, for any column names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Names = Sequence[str]

#: Rows up to which a dimension is broadcast; its size is counted first.
BROADCAST_ROWS = 50_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has few rows; the count stops one row beyond the bound."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def count_if(condition: Column) -> Column:
    """How many rows meet a condition, 0 for none."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def role_coverage(nodes: DataFrame, labels: DataFrame, gaps: DataFrame, key: Names, role: str, roles: dict[str, str], gap_count: str) -> DataFrame:
    """All nodes with the number of labels of each role (roles: value -> column) and of gaps; 0 where there is none.

    labels and gaps are those that count; both are aggregated by key before they meet the nodes.
    """
    per_role = labels.groupBy(*key).agg(*(count_if(F.col(role) == value).alias(name) for value, name in roles.items()))
    per_gap = gaps.groupBy(*key).agg(F.count("*").alias(gap_count))
    out = nodes.join(per_role, list(key), "left").join(per_gap, list(key), "left")
    return out.fillna(0, [*roles.values(), gap_count])


def state_counts(df: DataFrame, key: Names, conditions: dict[str, Column]) -> DataFrame:
    """By key the number of rows that meet each condition."""
    return df.groupBy(*key).agg(*(count_if(c).alias(n) for n, c in conditions.items()))


def totals_by(df: DataFrame, key: Names, measure: str, total: str = "total", n: str = "n") -> DataFrame:
    return df.groupBy(*key).agg(F.sum(measure).alias(total), F.count("*").alias(n))


def totals_vs_bounds(bounds: DataFrame, facts: DataFrame, key: str, measure: str, total: str = "total", n: str = "n") -> DataFrame:
    """Every row of bounds with the sum and number of facts of its key, 0 where there are none. bounds is a short list."""
    sums = facts.groupBy(key).agg(F.sum(measure).alias(total), F.count("*").alias(n))
    return F.broadcast(bounds).join(sums, key, "left").fillna(0, [total, n]) if bounds.isLocal() else bounds.join(sums, key, "left").fillna(0, [total, n])


def contradictions(df: DataFrame, key: Names, order: str, value: str, tolerance: float, carry: Names = ()) -> DataFrame:
    """Pairs of rows of one key, the lower order first, whose values differ by more than the tolerance.

    Keys whose values all lie within the tolerance are dropped before the join, so only contradictory keys make pairs.
    """
    spread = df.groupBy(*key).agg(F.max(value).alias("__hi"), F.min(value).alias("__lo")).where(F.col("__hi") - F.col("__lo") > tolerance).select(*key)
    kept = df.join(spread, list(key), "left_semi")
    cols = [order, value, *carry]
    a = kept.select(*key, *(F.col(c).alias(f"{c}_a") for c in cols))
    b = kept.select(*key, *(F.col(c).alias(f"{c}_b") for c in cols))
    return a.join(b, list(key)).where((F.col(f"{order}_a") < F.col(f"{order}_b")) & (F.abs(F.col(f"{value}_a") - F.col(f"{value}_b")) > tolerance))


def plan_status(planned: Column, actual: Column, present: Column, missing: str, differs: str, fine: str) -> Column:
    """Three states; an unknown actual value is fine, as nothing shows a difference."""
    return F.when(~present, missing).when(actual != planned, differs).otherwise(fine)


def unnest(df: DataFrame, list_col: str, name: str, keep: Names) -> DataFrame:
    """One row for each element; rows with a null or empty list go."""
    return df.select(*keep, F.explode(list_col).alias(name))


def band(score: Column) -> Column:
    """The bands of a valuation."""
    return F.when(score >= 4.5, "Se cumple plenamente").when(score >= 3.7, "Se cumple en alto grado").when(score.isNull(), "sin valoración").otherwise("por debajo de 3,7")


def over_rating_risk(score: Column, high_signals: Column) -> Column:
    """The risk that a high score hides known gaps."""
    return F.when((score >= 4.5) & (high_signals >= 2), "alto").when((score >= 4.0) & (high_signals >= 1), "medio").otherwise("bajo")


def first_value_by(df: DataFrame, key: Names, value: str, order: str, name: str) -> DataFrame:
    """By key the value of the row with the lowest order: what a scalar look-up takes."""
    return df.groupBy(*key).agg(F.min_by(value, order).alias(name))


def signals(edges: DataFrame, gaps: DataFrame, source: Names, target: Names, gap_target: Names, gap_id: str, severity: Column, kinds: dict[str, str]) -> DataFrame:
    """By source the number of distinct gaps of each severity on targets that its edges reach."""
    reached = edges.join(gaps, [F.col(a) == F.col(b) for a, b in zip(target, gap_target, strict=True)])
    return reached.groupBy(*source).agg(*(F.count_distinct(F.when(severity == k, F.col(gap_id))).alias(n) for k, n in kinds.items()))


def self_and_children(nodes: DataFrame, key: Names, parent: Names) -> DataFrame:
    """(top key, member key) pairs of every top node: itself and its children. Members are named m_<key>."""
    top = nodes.where(" AND ".join(f"{p} IS NULL" for p in parent))
    own = top.select(*key, *(F.col(k).alias(f"m_{k}") for k in key))
    down = nodes.where(" AND ".join(f"{p} IS NOT NULL" for p in parent)).select(*(F.col(p).alias(k) for p, k in zip(parent, key, strict=True)), *(F.col(k).alias(f"m_{k}") for k in key))
    return own.unionByName(down.join(top.select(*key), list(key), "left_semi"))


def pivot_scores(df: DataFrame, key: Names, kind: str, value: str, kinds: Names, order: str) -> DataFrame:
    """One column for each kind with the value of its first row."""
    return df.groupBy(*key).pivot(kind, list(kinds)).agg(F.min_by(value, order))


def ordered_list(value: Column, order: Names, separator: str = ", ") -> Column:
    """Aggregate: values joined in a total order; nulls are left out."""
    pairs = F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct(*[F.col(c) for c in order], value.alias("__v")))))
    return F.array_join(F.transform(pairs, lambda p: p["__v"]), separator)


def nested(order: Names, fields: Names) -> Column:
    """Aggregate: rows as an array of structs in a total order."""
    return F.transform(F.sort_array(F.collect_list(F.struct(*[F.col(c).alias(f"__{k}") for k, c in enumerate(order)], F.struct(*fields).alias("row")))), lambda x: x["row"])
