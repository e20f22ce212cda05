"""The same scans over Structured Streaming.

A scan happens inside the row, so `operators.scan.scan` and `operators.hits.hits` take a
streaming DataFrame as it is. Here is what needs state or a sink. A match is always within
one record.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.binding import one_row_each
from ..operators.hits import HITS, as_list, hits, with_hits
from ..operators.scan import combination_matches, rule_ids
from ..plans.compiled import CompiledRules
from ..sources.sinks import work_folder


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """`ts` as TIMESTAMP: watermarks refuse TIMESTAMP_NTZ."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_hits(docs: DataFrame, compiled: CompiledRules, key, text: str = "text", keep=()) -> DataFrame:
    """Append-mode hits; no state."""
    return hits(docs, compiled, key, text, keep)


def single_alerts(docs: DataFrame, compiled: CompiledRules, key, ts: str, delay: str, text: str = "text",
                  with_ruleset: bool = False) -> DataFrame:
    """One alert per key and rule for as long as the watermark `delay` remembers it.

    State is one entry per live (key, rule), spread by both, so a hot key does not gather
    in one task.
    """
    found = hits(event_time(docs, ts).withWatermark(ts, delay), compiled, key, text, keep=[ts], with_ruleset=True)
    alerts = found.dropDuplicatesWithinWatermark([*as_list(key), "ruleset", "rule_id"])
    return alerts if with_ruleset else alerts.drop("ruleset")


def windowed_counts(docs: DataFrame, compiled: CompiledRules, key, ts: str, delay: str, width: str,
                    text: str = "text", with_ruleset: bool = False) -> DataFrame:
    """Matched records per rule and time window.

    A stream delivers a window once the watermark has passed it. Of an input that ends, a batch table gives all.
    """
    found = hits(event_time(docs, ts).withWatermark(ts, delay), compiled, key, text, keep=[ts], with_ruleset=True)
    counts = (found.groupBy(F.window(ts, width).alias("w"), "ruleset", "rule_id").count()
              .select(F.col("w.start").alias("window_start"), "ruleset", "rule_id", F.col("count").alias("n_hits")))
    return counts if with_ruleset else counts.drop("ruleset")


def session_combinations(docs: DataFrame, compiled: CompiledRules, key, ts: str, delay: str, gap: str,
                         text: str = "text") -> DataFrame:
    """Combinations over all records of a session; a session is one key without a `gap`.

    State per session is at most one entry per rule. Sessions are merged before the shuffle too, so
    a busy key is reduced where its records are read. Of an input that ends, a batch table gives all sessions.
    """
    docs.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    keys = as_list(key)
    timed = event_time(docs, ts).withWatermark(ts, delay)
    records = with_hits(timed, compiled, text, [*keys, ts]).select(*keys, ts, F.explode_outer(rule_ids(F.col(HITS))).alias("_id"))
    sessions = records.groupBy(F.session_window(ts, gap).alias("session"), *keys).agg(
        F.collect_set("_id").alias("_ids"))
    kept = [*keys, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end")]
    return one_row_each(sessions, kept, F.transform(combination_matches(compiled), lambda m: m["rule_id"]), "rule_id")


def deliver(matches: DataFrame, handler, checkpoint: str, available_now: bool = True):
    """Call ``handler(batch_df, batch_id)`` per micro-batch."""
    writer = matches.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def deliver_results(docs: DataFrame, operator, path: str, checkpoint: str, fmt: str = "parquet", available_now: bool = True):
    """The rows of ``operator(batch)`` for each micro-batch of `docs`, in a folder of `path` per batch.

    The operator sees a batch as a table, so it may be any operator of this library with a ruleset of any size, joins
    included. A batch that runs again after a failure overwrites its own folder: no row is delivered twice or lost.
    """
    def write(batch: DataFrame, number: int) -> None:
        operator(batch).write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/batch={number}")

    return deliver(docs, write, checkpoint, available_now)


def deliver_once(docs: DataFrame, operator, path: str, checkpoint: str, keys, order: str | None = None, fmt: str = "parquet",
                 available_now: bool = True):
    """Like :func:`deliver_results`, but of all rows with the same `keys` only one is ever delivered, whenever they come.

    A batch is compared with all that earlier batches delivered, so no watermark makes a key new again and nothing is
    repeated after a restart. `order` names the column whose least value stays within a batch. The table of what was delivered is
    the state: it has one row per key, is read by its keys only and grows with their number.
    """
    keys = as_list(keys)

    def write(batch: DataFrame, number: int) -> None:
        found = operator(batch)
        row = F.struct(*(F.col(f"`{c}`") for c in found.columns))
        least = F.xxhash64(*(F.col(f"`{c}`") for c in found.columns))
        first = found.groupBy(*keys).agg(F.min_by(row, F.struct(F.col(order) if order else F.lit(0), least)).alias("_row")).select("_row.*")
        earlier = delivered(batch.sparkSession, path, "batch bigint, " + ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name in keys), fmt, None).where(F.col("batch") < number)
        known = earlier.select(*(F.col(k).alias(f"_known_{k}") for k in keys))
        new = first.join(known, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]), "left_anti")
        new.write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/batch={number}")

    return deliver(docs, write, checkpoint, available_now)


def delivered(spark: SparkSession, path: str, schema, fmt: str = "parquet", number: str | None = "batch") -> DataFrame:
    """What :func:`deliver_results` and :func:`deliver_once` have written so far, as a table without the batch `number`."""
    try:
        found = spark.read.schema(schema).format(fmt).load(path)
        return found.drop(number) if number else found
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_available(matches: DataFrame, name: str = "stream", fmt: str = "parquet") -> DataFrame:
    """Process what the source has now into files, and read those back as a batch table."""
    spark = matches.sparkSession
    out = work_folder(spark, name)
    query = (matches.writeStream.format(fmt).outputMode("append")
             .option("checkpointLocation", out + "-checkpoint")
             .trigger(availableNow=True).start(out))
    query.awaitTermination()
    return spark.read.schema(matches.schema).format(fmt).load(out)
