"""H1-H8: run metrics from logged step records.

A log is ``(run, ts, step_key, loss, tokens)``. Per-step running values use
the skew-safe partitioned offsets (D1 over the total order minus each run's
start), so one run holding most of the rows is still spread over tasks.
Windows partitioned by run are used only on per-epoch tables, which hold a
handful of rows per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import partitioned_offsets


def seconds(ts) -> Column:
    """Timestamp without time zone (read as UTC) to epoch seconds (double).

    The difference to 1970 is taken in the type without time zone, so the
    session's zone and its clock changes do not enter."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    since = ts.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), since) * F.lit(86400.0) + F.extract(F.lit("HOUR"), since) * F.lit(3600.0) \
        + F.extract(F.lit("MINUTE"), since) * F.lit(60.0) + F.extract(F.lit("SECOND"), since).cast("double")


def steps(log: DataFrame, run: str = "run", ts: str = "ts", tie: str = "step_key",
          tokens: str = "tokens", start: int = 0) -> DataFrame:
    """H2: ``step`` (counted from ``start``) and cumulative ``tokens_seen`` per run."""
    d = partitioned_offsets(log, run, [ts, tie], tokens, ordinal_col="step", offset_col="_before")
    return d.withColumn("step", F.col("step") + start) \
        .withColumn("tokens_seen", (F.col("_before") + F.col(tokens)).cast("long")).drop("_before")


def epoch_rollup(st: DataFrame, run: str = "run", epoch: str = "epoch",
                 measures: str | list[str] = "loss") -> DataFrame:
    """H1: last, min and mean of every measure (train loss, validation loss,
    learning rate) and max tokens seen per run and epoch.

    A measure that is logged at some steps only is null at the others: its last
    value is that of the last step that has one."""
    measures = [measures] if isinstance(measures, str) else list(measures)
    aggs = [a for m in measures for a in (
        F.max_by(m, F.when(F.col(m).isNotNull(), F.col("step"))).alias(f"last_{m}"),
        F.min(m).alias(f"min_{m}"), F.avg(m).alias(f"mean_{m}"))]
    return st.groupBy(run, epoch).agg(
        *aggs, F.max("tokens_seen").alias("tokens_seen"), F.count(F.lit(1)).cast("long").alias("n_steps"))


def eval_points(st: DataFrame, eval_freq: int) -> DataFrame:
    """H3: the steps at which evaluation runs (``step % eval_freq == 0``)."""
    return st.where(F.pmod(F.col("step"), F.lit(eval_freq)) == 0)


def eta(log: DataFrame, run: str = "run", unit: str = "epoch", ts: str = "ts",
        n_units: int | None = None) -> DataFrame:
    """H4: per finished unit: its elapsed seconds, the total so far, and the
    estimate for the rest (mean per unit x units left) split into h/m/s."""
    u = log.groupBy(run, unit).agg(F.max(seconds(ts)).alias("_end"), F.min(seconds(ts)).alias("_beg"))
    w = Window.partitionBy(run).orderBy(unit)
    run_start = F.min("_beg").over(Window.partitionBy(run))
    total_units = F.count(F.lit(1)).over(Window.partitionBy(run)) if n_units is None else F.lit(n_units)
    d = u.select(run, unit, "_end", run_start.alias("_start"), F.row_number().over(w).alias("done"),
                 F.lag("_end").over(w).alias("_prev"), total_units.alias("_n"))
    elapsed = F.col("_end") - F.coalesce(F.col("_prev"), F.col("_start"))
    total = F.col("_end") - F.col("_start")
    remaining = F.floor(total / F.col("done") * (F.col("_n") - F.col("done")))
    return d.select(run, unit, F.col("done").cast("long"), elapsed.alias("unit_seconds"),
                    total.alias("elapsed_seconds"), remaining.cast("long").alias("eta_seconds"),
                    F.floor(remaining / 3600).cast("long").alias("eta_h"),
                    F.floor(F.pmod(remaining, F.lit(3600)) / 60).cast("long").alias("eta_m"),
                    F.pmod(remaining, F.lit(60)).cast("long").alias("eta_s"))


def timing_summary(samples: DataFrame, name: str = "name", value: str = "seconds") -> DataFrame:
    """H5: mean, sample and population std, min, max, total and calls by name."""
    v = F.col(value)
    return samples.groupBy(name).agg(
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std_sample"),
        F.stddev_pop(v).alias("std_pop"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.sum(v).alias("total"), F.count(F.lit(1)).cast("long").alias("calls"))


def throughput(log: DataFrame, run: str = "run", ts: str = "ts", tokens: str = "tokens") -> DataFrame:
    """H6: tokens per second of wall clock per run."""
    s = seconds(ts)
    return log.groupBy(run).agg(F.sum(tokens).cast("long").alias("tokens"),
                                (F.max(s) - F.min(s)).alias("seconds")) \
        .withColumn("tokens_per_second", F.col("tokens") / F.col("seconds"))


def plateau_stop(evals: DataFrame, patience: int, run: str = "run", step: str = "epoch",
                 metric: str = "val_loss") -> DataFrame:
    """H7: the first evaluation after ``patience`` evaluations without a new
    best (strictly lower) value; one row per run that stops."""
    w = Window.partitionBy(run).orderBy(step)
    before = F.min(metric).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = evals.select(run, step, metric, F.row_number().over(w).alias("_i"),
                     (before.isNull() | (F.col(metric) < before)).alias("_imp"))
    d = d.withColumn("_last", F.max(F.when(F.col("_imp"), F.col("_i"))).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.where(F.col("_i") - F.col("_last") >= patience).groupBy(run) \
        .agg(F.min(step).alias("stop_at"))


def smooth_loss(st: DataFrame, w: int, run: str = "run", loss: str = "loss", block: int | None = None) -> DataFrame:
    """H8: mean of the loss over the last ``w`` steps, only where the window
    is full. Steps are cut into blocks of ``block`` (16 windows if not given); a step is
    copied to the next block only where that block's first windows reach back to it, and
    the window runs inside (run, block), so no run is gathered in a task."""
    block = max(block or 16 * w, w)
    own = F.floor(F.col("step") / block)
    to = F.array_distinct(F.array(own, F.floor((F.col("step") + w - 1) / block)))
    ex = st.select(run, "step", loss, own.alias("_own"), F.explode(to).alias("_blk"))
    last = Window.partitionBy(run, "_blk").orderBy("step").rangeBetween(1 - w, 0)
    d = ex.select(run, "step", "_own", "_blk", F.avg(loss).over(last).alias("smooth_loss"),
                  F.count(F.lit(1)).over(last).alias("_n"))
    return d.where((F.col("_own") == F.col("_blk")) & (F.col("_n") == w)).select(run, "step", "smooth_loss").distinct()
