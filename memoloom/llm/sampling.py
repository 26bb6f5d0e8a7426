"""A sample that follows target shares of categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, cut, is_at_most

#: A unit's hash is a whole number below 2**BITS, and its acceptance compares it with probability * 2**BITS.
BITS, CELLS = 48, 4096


def sample_to_targets(
    df: DataFrame,
    targets: DataFrame,
    group_cols: list[str],
    unit_col: str,
    text_col: str,
    order_col: str,
    share_col: str = "target_share",
    min_col: str = "min_rows",
    size_col: str = "sample_rows",
    seed: int = 20260420,
    oversample: float = 0.05,
    broadcast_rows: int = 10_000,
    count_observed: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Draws distinct units so that each group gets its target count; returns (sample, report).

    A group needs the larger of ``min_col`` and ``share_col * size_col`` rounded half up. Its units are accepted
    where they are read, each by its own hash, with the ratio of that number to an estimate of the group's units,
    larger by ``oversample`` and three deviations of a draw; so only about as many units as are needed are shuffled.
    Counts are then corrected exactly: groups that were accepted in part and came out short are refilled from the
    hashes beyond, and the largest hashes of a surplus go. A sample so has the smallest hashes of each group, however
    good the estimate was, and another ``oversample`` changes what is accepted but never what is drawn. The place of
    the last cut is found in a histogram of hashes, so that only one cell's units of a group are ever ranked.

    Units are the distinct non-null ``unit_col`` of a group over rows whose text is neither null nor only
    spaces; ``order_col`` (smallest of the unit's rows) is carried along. Nulls in group columns match nulls.
    A null or NaN share, minimum or size counts as 0. Groups without a target give nothing; targets without
    data are reported with 0 observed. Repeated targets of a group are reported one by one and sampled by
    the largest. Empty tables give empty results. Other columns, whatever their names, are ignored.

    sample: group columns, ``unit_col``, ``order_col``. report: group columns, needed, observed (exact; only with
    ``count_observed``), accepted, drawn, acceptance (the probability), deficit; one row for each target row.
    """
    number = lambda c: F.coalesce(F.nanvl(col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    keys = [f"_g{i}" for i in range(len(group_cols))]
    tid = F.xxhash64(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))])
    goal = targets.select(
        *[col(g).alias(k) for g, k in zip(group_cols, keys)],
        F.greatest(number(min_col), F.round(number(share_col) * number(size_col)), F.lit(0.0)).cast("long").alias("needed"),
    ).withColumn("tid", tid)
    goals = goal.groupBy("tid", *keys).agg(F.max("needed").alias("needed"))

    rows = df.where(col(text_col).isNotNull() & (F.length(F.trim(col(text_col))) > 0) & col(unit_col).isNotNull()).select(
        *[col(g).alias(k) for g, k in zip(group_cols, keys)], col(unit_col).alias("unit"), col(order_col).alias("ord")
    )
    rows = rows.withColumn("tid", tid)
    small = is_at_most(targets, broadcast_rows)
    side = lambda x: F.broadcast(x) if small else x

    def of_groups(frame: DataFrame) -> DataFrame:
        """Rows of the groups of ``frame`` (tid, group columns, more), with what it has more."""
        there = frame.select("tid", *[F.col(k).alias("t" + k) for k in keys], *[c for c in frame.columns if c not in ("tid", *keys)])
        on = rows["tid"] == there["tid"]
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col("t" + k))
        return rows.join(side(there), on).drop(there["tid"], *keys)

    # How many units a group has, about: sketches meet, not units
    guess = of_groups(goals).groupBy("tid").agg(F.approx_count_distinct("unit", 0.02).alias("about"))
    want = F.col("needed") * (1 + oversample) + 3 * F.sqrt("needed")
    plan = cut(goals.join(guess, "tid", "left").withColumn("acceptance", F.when(F.coalesce("about", F.lit(0)) == 0, 0.0).otherwise(F.least(F.lit(1.0), want / F.col("about")))))

    text = F.concat_ws("||", F.lit(str(seed)), *[F.coalesce(F.col("t" + k).cast("string"), F.lit("")) for k in keys], F.col("unit").cast("string"))

    def hashed(frame: DataFrame) -> DataFrame:
        edged = of_groups(frame.select("tid", *keys, F.floor(F.col("acceptance") * 2.0**BITS).alias("edge")))
        return edged.withColumn("h", F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long"))

    def distinct(frame: DataFrame) -> DataFrame:
        return frame.groupBy("tid", "unit").agg(F.min("ord").alias("ord"), F.first("h").alias("h"))

    accepted = cut(distinct(hashed(plan).where(F.col("h") < F.col("edge"))))
    counts = accepted.groupBy("tid").agg(F.count(F.lit(1)).alias("accepted"))
    plan = plan.join(side(counts), "tid", "left").withColumn("accepted", F.coalesce("accepted", F.lit(0)))
    short = plan.where((F.col("accepted") < F.col("needed")) & (F.col("acceptance") < 1))
    units = accepted
    if not short.isEmpty():
        more = cut(distinct(hashed(short).where(F.col("h") >= F.col("edge"))))
        units = units.unionByName(more)
        of = more.groupBy("tid").agg(F.count(F.lit(1)).alias("more"))
        plan = plan.join(side(of), "tid", "left").withColumn("have", F.col("accepted") + F.coalesce("more", F.lit(0))).drop("more")
    else:
        plan = plan.withColumn("have", F.col("accepted"))
    plan = plan.withColumn("take", F.least("needed", "have"))

    # The surplus goes by its hashes: cells as fine as the accepted part of the range
    cell = F.floor(F.col("h") / F.greatest(F.col("acceptance") * 2.0**BITS / CELLS, F.lit(1.0))).cast("long")
    placed = units.join(side(plan.select("tid", "acceptance", "take")), "tid").withColumn("cell", cell)
    cells = placed.groupBy("tid", "cell", "take").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("upto", F.sum("n").over(Window.partitionBy("tid").orderBy("cell")))
    cuts = cells.groupBy("tid").agg(F.min(F.when(F.col("upto") >= F.col("take"), F.col("cell"))).alias("edge"), F.max(F.when(F.col("upto") < F.col("take"), F.col("upto")).otherwise(0)).alias("before"))
    kept = placed.join(side(cuts), "tid").where((F.col("cell") <= F.col("edge")) & (F.col("take") > 0))
    last = kept.where(F.col("cell") == F.col("edge")).withColumn("rn", F.row_number().over(Window.partitionBy("tid").orderBy("h", "unit")))
    drawn = kept.where(F.col("cell") < F.col("edge")).select("tid", "unit", "ord").unionByName(last.where(F.col("rn") <= F.col("take") - F.col("before")).select("tid", "unit", "ord"))

    sample = drawn.join(side(goals.select("tid", *keys)), "tid").select(*[F.col(k).alias(g) for g, k in zip(group_cols, keys)], F.col("unit").alias(unit_col), F.col("ord").alias(order_col))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    known = plan.select("tid", "accepted", "take", "acceptance")
    report = goal.join(known, "tid", "left")
    seen = []
    if count_observed:
        report = report.join(of_groups(goals.select("tid", *keys)).groupBy("tid").agg(F.count_distinct("unit").alias("observed")), "tid", "left")
        seen = [zero("observed").alias("observed")]
    taken = F.least(zero("take"), F.col("needed"))
    return sample, report.select(
        *[F.col(k).alias(g) for g, k in zip(group_cols, keys)], "needed", *seen, zero("accepted").alias("accepted"), taken.alias("drawn"), F.coalesce("acceptance", F.lit(0.0)).alias("acceptance"), (F.col("needed") - taken).alias("deficit")
    )
