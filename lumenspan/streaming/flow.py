"""Counts of time buckets over a stream of spans.

Figures of whole traces (rejection, dialogs, breaks) need every span of a trace and stay batch work; this gives the figures
of a bucket that single spans decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenspan.functions.stats import rate, total
from lumenspan.operators import flags
from lumenspan.plans.spec import MANDATORY, SPEC


def span_flow(spans: DataFrame, width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """By time bucket: spans, rejected spans, validity of mandatory rules, rate of all violations and of errors.

    ``spans`` has the columns of the specification; as a stream, spans later than ``lateness`` are left out and buckets are
    final once the watermark passes them.
    """
    stamped = spans.withColumn("ts", F.timestamp_micros((F.col("start_time_ns") / 1000).cast("long"))).withWatermark("ts", lateness)
    return (
        stamped.groupBy(F.window("ts", width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("spans"),
            total(flags.blocking()).alias("rejected_spans"),
            (1 - F.avg(flags.share(flags.violation, MANDATORY))).alias("validity"),
            F.avg(flags.share(flags.violation, SPEC)).alias("defect"),
            rate(flags.is_error()).alias("error_rate"),
        )
        .select(F.col("w.start").alias("ts"), "spans", "rejected_spans", "validity", "defect", "error_rate")
    )
