"""History counters: maxima over all of an engine's events strictly before
a flight."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import common_time_type, epoch_seconds
from .ranges import left_join

# Default bucket for the two-level running maximum (30 days).
HISTORY_BUCKET_SECONDS = 30 * 24 * 3600


def prior_events_max(legs: DataFrame, events: DataFrame, *, key: str, at: str,
                     event_key: str, event_ts: str, cols: Mapping[str, str],
                     require: str | None = None,
                     bucket_seconds: int = HISTORY_BUCKET_SECONDS) -> DataFrame:
    """Adds, per ``out: src`` in ``cols``, the maximum of ``events[src]``
    over events with ``event_key == legs[key]`` and ``event_ts < legs[at]``
    (strict). Each maximum is taken independently. NULL when the key or time
    is NULL, when ``require`` (a leg column) is NULL, or when there is no
    earlier event. Events with a NULL time are ignored.

    Plan: no range join. Maxima are decomposable, so the result is
    max(prefix maximum of whole earlier time buckets, running maximum inside
    the leg's own bucket). The running window is partitioned by (key, bucket)
    -- one busy engine is spread over its buckets -- and ordered by (time,
    points before events), so an event at the very instant of a flight is
    not counted. The prefix runs over a per-(key, bucket) summary. Distinct
    (key, time) points are resolved once and joined back.
    """
    ts_type = common_time_type(events.schema[event_ts].dataType, legs.schema[at].dataType)
    ev = (events.select(F.col(event_key).alias("_k"), F.col(event_ts).cast(ts_type).alias("_t"),
                        *[F.col(src).alias(f"_v{n}") for n, src in enumerate(cols.values())])
          .where(F.col("_k").isNotNull() & F.col("_t").isNotNull())
          .withColumn("_b", F.floor(epoch_seconds("_t") / F.lit(bucket_seconds)).cast("long")))
    pts = (legs.select(F.col(key).alias("_k"), F.col(at).alias("_at"))
           .where(F.col("_k").isNotNull() & F.col("_at").isNotNull()).distinct()
           .withColumn("_t", F.col("_at").cast(ts_type))
           .withColumn("_b", F.floor(epoch_seconds("_t") / F.lit(bucket_seconds)).cast("long")))
    n_vals = len(cols)
    vals = [f"_v{n}" for n in range(n_vals)]
    at_type = pts.schema["_at"].dataType
    u = (pts.select("_k", "_b", "_t", F.lit(0).alias("_kind"), "_at",
                    *[F.lit(None).cast(ev.schema[v].dataType).alias(v) for v in vals])
         .unionByName(ev.select("_k", "_b", "_t", F.lit(1).alias("_kind"),
                                F.lit(None).cast(at_type).alias("_at"), *vals)))
    w_in = (Window.partitionBy("_k", "_b").orderBy("_t", "_kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = (u.withColumns({f"_i{n}": F.max(v).over(w_in) for n, v in enumerate(vals)})
             .where(F.col("_kind") == 0)
             .select("_k", "_b", "_at", *[f"_i{n}" for n in range(n_vals)]))
    # maximum over all whole earlier buckets
    summary = ev.groupBy("_k", "_b").agg(*[F.max(v).alias(v) for v in vals])
    wanted = pts.select("_k", "_b").distinct()
    grid = (wanted.select("_k", "_b", *[F.lit(None).cast(summary.schema[v].dataType).alias(v)
                                         for v in vals])
            .unionByName(summary))
    w_pre = (Window.partitionBy("_k").orderBy("_b")
             .rangeBetween(Window.unboundedPreceding, -1))
    prefix = (grid.groupBy("_k", "_b").agg(*[F.max(v).alias(v) for v in vals])
              .withColumns({f"_p{n}": F.max(v).over(w_pre) for n, v in enumerate(vals)})
              .select("_k", "_b", *[f"_p{n}" for n in range(n_vals)]))
    res = (inner.join(prefix, on=["_k", "_b"], how="left")
           .select(F.col("_k").alias("_rk"), F.col("_at").alias("_rat"),
                   *[F.greatest(f"_i{n}", f"_p{n}").alias(out)
                     for n, out in enumerate(cols)]))
    extra = [F.col(require).isNotNull()] if require is not None else []
    return left_join(legs, res, [(key, "_rk"), (at, "_rat")], extra).drop("_rk", "_rat")
