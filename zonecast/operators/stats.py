"""Distribution summaries (box-plot inputs) with exact quantiles, lazily.

Spark's exact ``percentile`` merges every distinct value of a group in one
task; ``percentile_approx`` is bounded but approximate. Here the approximate
one brackets each quartile (its rank error is known), and one more pass counts
the values by their place: each value inside a bracket, the gaps in sum.
The counts are partial in every task, so a hot value costs a row a task; what
is sorted is only what lies inside the brackets, at most about
4 / ACCURACY of the values and less where values repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.functions.numeric import round_half_even

ACCURACY = 10_000           # rank error of the brackets: 1 / ACCURACY of the values
QUARTILES = {"Q1": 0.25, "MEDIAN": 0.5, "Q3": 0.75}
DIGITS = 6                  # quartiles are reported to 1e-6


def exact_quantiles(rows: DataFrame, group_col: str, value_col: str, probs: dict[str, float]) -> DataFrame:
    """One row a group (null is one): the named quantiles, linear between order statistics.

    For a small number of groups, such as one a column: a row a group is broadcast.
    """
    base = rows.select(F.col(group_col).alias("_g"), F.col(value_col).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v"))
    slack = 2 / ACCURACY
    asked = F.array(*[F.lit(min(1.0, max(0.0, p + e))) for p in probs.values() for e in (-slack, slack)])
    near = base.groupBy("_g").agg(F.percentile_approx("_v", asked, F.lit(ACCURACY)).alias("_a"),
                                  F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(p).alias("p"),
                              (F.col("_lo") if p - slack <= 0 else F.col("_a")[2 * i]).alias("lo"),
                              (F.col("_hi") if p + slack >= 1 else F.col("_a")[2 * i + 1]).alias("hi"))
                     for i, (k, p) in enumerate(probs.items())])
    near = near.select(F.col("_g").alias("_k"), "_n", each.alias("_each"))       # a row a group, of which there are few
    put = base.join(F.broadcast(near), F.col("_g").eqNullSafe(F.col("_k"))).select("_g", "_n", "_v", F.explode("_each").alias("q"))
    inside = F.when(F.col("_v") < F.col("q.lo"), F.lit(-1)).when(F.col("_v") > F.col("q.hi"), F.lit(1)).otherwise(F.lit(0))
    counted = put.groupBy("_g", "_n", "q.k", "q.p", inside.alias("_side"),
                          F.when(inside == 0, F.col("_v")).alias("_x")).agg(
        F.count("*").alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    order = Window.partitionBy("_g", "k").orderBy("_side", "_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counted.withColumn("_upto", F.sum("_c").over(order))
    place = F.col("p") * (F.col("_n") - 1)
    # a rank just outside the bracket is the neighbour on that side
    value = F.when(F.col("_side") == -1, F.col("_most")).otherwise(F.col("_least")).alias("x")
    found = upto.groupBy("_g", "k", place.alias("_place")).agg(*[
        F.min(F.when(F.col("_upto") > f(place), F.struct(F.col("_upto"), value)))["x"].alias(name)
        for name, f in (("_x0", F.floor), ("_x1", F.ceil))])
    value = F.col("_x0") + (F.col("_place") - F.floor("_place")) * (F.col("_x1") - F.col("_x0"))
    value = F.when(F.col("_x0") == F.col("_x1"), F.col("_x0")).otherwise(value)
    return found.groupBy(F.col("_g").alias(group_col)).agg(*[
        F.max(F.when(F.col("k") == k, value)).alias(k) for k in probs])


def _brackets(df: DataFrame, columns) -> DataFrame:
    """One row, a struct a column: where its quartiles (1 to 3) and fences (4, 5) can lie, from ``lo`` to ``hi``."""
    slack = 2 / ACCURACY
    asked = ", ".join(f"{p + e}D" for p in QUARTILES.values() for e in (-slack, slack))
    row = df.agg(*[F.expr(f"percentile_approx(`{c}`, array({asked}), {ACCURACY})").alias(c) for c in columns])
    ends = [(f"a[{2 * i}]", f"a[{2 * i + 1}]") for i in range(3)]
    for low, high in (("2.5D * a[0] - 1.5D * a[5]", "2.5D * a[1] - 1.5D * a[4]"), ("2.5D * a[4] - 1.5D * a[1]", "2.5D * a[5] - 1.5D * a[0]")):
        # a little wider, for the rounding of the fences; infinite quartiles give no bound
        ends.append((f"nanvl({low} - (abs({low}) + 1) * 1e-9D, double('-inf'))", f"nanvl({high} + (abs({high}) + 1) * 1e-9D, double('inf'))"))
    each = [", ".join(f"'lo{i}', {low}, 'hi{i}', {high}" for i, (low, high) in enumerate(ends, 1)).replace("a[", f"`{c}`[") for c in columns]
    return row.select(F.expr("named_struct(" + ", ".join(f"'{c}', named_struct({e})" for c, e in zip(columns, each, strict=True)) + ")"))


def box_stats(df: DataFrame, columns, group_name: str = "VARIABLE") -> DataFrame:
    """Per column: N, Q1, MEDIAN, Q3 (exact, linear), whiskers at the most
    extreme values inside 1.5 IQR of the quartiles, and the outlier count.

    Two reads of ``df``: a sketch of all columns at once brackets quartiles
    and fences; one count then tells the values inside any bracket apart and
    sums up the gaps between them, from which everything is read off. The
    counts are partial in every task; their windows run over what lies inside
    the brackets only.
    """
    df = df.selectExpr(*[f"CAST(CASE WHEN NOT isnan(`{c}`) THEN `{c}` END AS DOUBLE) AS `{c}`" for c in columns])
    df = df.select("*", _brackets(df, columns).scalar().alias("_b"))     # named once: a subquery is planned where it is named
    entries = []
    for c in columns:
        b = f"_b.`{c}`"
        inside = " OR ".join(f"`{c}` BETWEEN {b}.lo{i} AND {b}.hi{i}" for i in range(1, 6))
        gap = " + ".join(f"int(`{c}` > {b}.hi{i})" for i in range(1, 6))
        entries.append(f"named_struct('{group_name}', '{c}', '_v', `{c}`, '_gap', CASE WHEN {inside} THEN -1 ELSE {gap} END)")
    rows = df.selectExpr(f"explode(array({', '.join(entries)})) AS _e").select("_e.*").where("_v IS NOT NULL")
    counted = rows.groupBy(group_name, "_gap", F.expr("CASE WHEN _gap < 0 THEN _v END AS _x")).agg(
        F.count("*").alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    g = f"`{group_name}`"
    counted = counted.selectExpr(
        "*", f"sum(_c) OVER (PARTITION BY {g}) AS N",
        f"sum(_c) OVER (PARTITION BY {g} ORDER BY _least ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _upto")
    ranks = {f"_{q}{end}": f"{end}({p}D * (N - 1))" for q, p in QUARTILES.items() for end in ("floor", "ceil")}
    counted = counted.selectExpr("*", *[f"{rank} - (_upto - _c) AS {r}" for r, rank in ranks.items()])     # its place in this entry
    counted = counted.selectExpr(*[c for c in counted.columns if c not in ranks], *[
        f"max(CASE WHEN {r} = 0 THEN _least WHEN {r} = _c - 1 THEN _most WHEN {r} BETWEEN 0 AND _c - 1 THEN "
        f"CASE WHEN _gap < 0 THEN _x ELSE raise_error('an order statistic lies outside its bracket') END END) "
        f"OVER (PARTITION BY {g}) AS {r}" for r in ranks])
    counted = counted.selectExpr("*", *[
        f"CASE WHEN _{q}floor = _{q}ceil THEN _{q}floor ELSE _{q}floor + ({p}D * (N - 1) - floor({p}D * (N - 1))) * (_{q}ceil - _{q}floor) END AS {q}"
        for q, p in QUARTILES.items()])
    # a gap lies on one side of a fence whole
    counted = counted.selectExpr("*", "_least >= Q1 - 1.5D * (Q3 - Q1) AS _above", "_most <= Q3 + 1.5D * (Q3 - Q1) AS _below")
    out = counted.groupBy(group_name, *QUARTILES).agg(
        F.expr("max(N) AS N"), F.expr("min(CASE WHEN _above THEN _least END) AS LOWER_WHISKER"),
        F.expr("max(CASE WHEN _below THEN _most END) AS UPPER_WHISKER"),
        F.expr("coalesce(sum(CASE WHEN NOT (_above AND _below) THEN _c END), 0L) AS N_OUTLIERS"))
    return out.withColumns({q: round_half_even(q, DIGITS) for q in QUARTILES})
