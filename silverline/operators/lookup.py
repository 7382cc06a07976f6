"""Repair quarantined records from a lookup (dimension) table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def repair_by_lookup(bad: DataFrame, dim: DataFrame, on: tuple[str, str],
                     replace: dict[str, str], how: str = "inner") -> DataFrame:
    """Join records to a dimension on ``bad[on[0]] == dim[on[1]]`` and take the
    dimension's value for every column in ``replace`` (column -> dimension column).

    The dimension is projected to the key and the replacement columns and
    reduced to one row per key before the join (partial aggregation first), so a
    record is never multiplied; a key with two different values fails the job.
    NULL keys match nothing. No broadcast
    hint: adaptive execution broadcasts it only when its measured size is
    below ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and otherwise
    keeps a sort-merge join, so a large dimension is safe.
    """
    left_key, right_key = on
    renamed = {d: f"_dim_{d}" for d in set(replace.values()) | {right_key}}
    key, values = renamed[right_key], [a for c, a in renamed.items() if c != right_key]
    d = dim.select(*[F.col(c).alias(a) for c, a in renamed.items()]).where(F.col(key).isNotNull())
    # a value is single when its least and greatest agree and it is NULL nowhere or everywhere
    stats = [x for a in values for x in (F.min(a).alias(f"{a}_lo"), F.max(a).alias(f"{a}_hi"), F.count(a).alias(f"{a}_n"))]
    d = d.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *stats)
    single = F.lit(True)
    for a in values:
        single = single & (F.col(f"{a}_n").isin(0) | ((F.col(f"{a}_n") == F.col("_rows")) & (F.col(f"{a}_lo") == F.col(f"{a}_hi"))))
    fail = F.raise_error(F.concat(F.lit("conflicting dimension rows for key "), F.col(key).cast("string")))
    d = d.select(key, *[F.when(single, F.col(f"{a}_lo")).otherwise(fail).alias(a) for a in values])
    joined = bad.join(d, bad[left_key] == d[renamed[right_key]], how)
    cols = []
    for c in bad.columns:
        if c in replace:
            src = F.col(renamed[replace[c]])
            if how != "inner":
                src = F.coalesce(src, bad[c])
            cols.append(src.cast(bad.schema[c].dataType).alias(c))
        else:
            cols.append(bad[c])
    return joined.select(*cols)
