import datetime as dt

from sieveflow import compile_rules, hits, rule, rules_table, scan, work_folder
from sieveflow.streaming.streams import (
    deliver, deliver_once, deliver_results, delivered, read_stream, run_available, session_combinations, single_alerts, stream_hits, windowed_counts,
)

RULES = [rule("error", (), 0), rule("warn", (), 1), rule("0 & !1", "COMBINATION", 9)]
START = dt.datetime(2024, 1, 1)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


folders = {}


def stream_folder(spark, stream):
    return folders[id(stream)]


def source(spark, *batches):
    """A stream of files, one per batch, and the same as a table."""
    path = work_folder(spark, "events")
    for rows in batches:
        spark.createDataFrame(rows, "user int, ts timestamp_ntz, text string").coalesce(1).write.mode("append").parquet(path)
    table = spark.read.parquet(path)
    stream = read_stream(spark, path, table.schema, maxFilesPerTrigger=1)
    folders[id(stream)] = path
    return stream, table


EVENTS = [(1, at(0), "error"), (1, at(5), "error warn"), (2, at(7), "warn"), (1, at(70), "error"), (3, at(71), "ok")]
LATE = [(9, at(600), "end")]


def test_stream_equals_batch(spark):
    compiled = compile_rules(rules_table(spark, RULES))
    stream, table = source(spark, EVENTS[:3], EVENTS[3:])
    keys = ["user", "ts"]
    assert sorted(run_available(stream_hits(stream, compiled, keys)).collect()) == sorted(
        hits(table, compiled, keys).collect())
    assert sorted(run_available(scan(stream, compiled, keys)).collect(), key=str) == sorted(
        scan(table, compiled, keys).collect(), key=str)


def test_single_alerts(spark):
    compiled = compile_rules(rules_table(spark, RULES[:2]))
    stream, _ = source(spark, EVENTS[:2], EVENTS[2:])
    rows = run_available(single_alerts(stream, compiled, "user", "ts", "1 day")).collect()
    assert sorted((r.user, r.rule_id) for r in rows) == [(1, 0), (1, 1), (2, 1)]


def test_windowed_counts(spark):
    compiled = compile_rules(rules_table(spark, RULES[:2]))
    stream, _ = source(spark, EVENTS, LATE, [(9, at(1200), "end")])
    rows = run_available(windowed_counts(stream, compiled, "user", "ts", "10 minutes", "1 hour")).collect()
    got = sorted((r.window_start.hour, r.rule_id, r.n_hits) for r in rows)
    assert got == [(0, 0, 2), (0, 1, 2), (1, 0, 1)]


def test_sessions(spark):
    compiled = compile_rules(rules_table(spark, RULES))
    stream, _ = source(spark, EVENTS, LATE, [(9, at(1200), "end")])
    rows = run_available(session_combinations(stream, compiled, "user", "ts", "10 minutes", "30 minutes")).collect()
    assert sorted((r.user, r.session_start.hour, r.rule_id) for r in rows) == [(1, 1, 9)]


def test_deliver(spark):
    compiled = compile_rules(rules_table(spark, RULES[:2]))
    stream, _ = source(spark, EVENTS[:2], EVENTS[2:])
    seen = []
    deliver(stream_hits(stream, compiled, "user"), lambda df, n: seen.append(df.count()),
            work_folder(spark, "checkpoint")).awaitTermination()
    assert sum(seen) == 5


def test_results_of_a_large_ruleset_are_delivered_once(spark):
    compiled = compile_rules(rules_table(spark, RULES), max_rules=0)
    stream, table = source(spark, EVENTS[:2], EVENTS[2:])
    path = work_folder(spark, "results")
    schema = "user int, rule_id int"
    assert delivered(spark, path, schema).count() == 0

    def once(number):
        deliver_results(stream, lambda batch: hits(batch, compiled, "user"), path, path + f"-checkpoint{number}").awaitTermination()
        return sorted(tuple(r) for r in delivered(spark, path, schema).collect())

    want = sorted(tuple(r) for r in hits(table, compiled, "user").collect())
    # a second checkpoint runs all batches again, under the same numbers
    assert once(1) == want == once(2) and len(want) == 5


def test_alerts_are_delivered_once_for_good(spark):
    """Neither the same key much later nor a restart repeats an alert."""
    compiled = compile_rules(rules_table(spark, RULES[:2]))
    events = [(1, at(0), "error"), (None, at(1), "warn"), (1, at(2), "error")], [(1, at(90_000), "error"), (2, at(90_001), "warn"), (None, at(3), "warn")]
    stream, _ = source(spark, *events)
    path = work_folder(spark, "once")

    def run(source):
        deliver_once(source, lambda b: hits(b, compiled, "user", keep=["ts"]), path, path + "-checkpoint", ["user", "rule_id"], "ts").awaitTermination()
        return sorted(((r.user, r.rule_id, r.ts) for r in delivered(spark, path, "user int, ts timestamp_ntz, rule_id int").collect()), key=str)

    want = sorted([(1, 0, at(0)), (None, 1, at(1)), (2, 1, at(90_001))], key=str)
    assert run(stream) == want
    # a restart with more input under the same checkpoint
    table = stream_folder(spark, stream)
    spark.createDataFrame([(2, at(99_000), "warn"), (3, at(99_001), "error")], "user int, ts timestamp_ntz, text string").coalesce(1).write.mode("append").parquet(table)
    assert run(read_stream(spark, table, stream.schema, maxFilesPerTrigger=1)) == sorted([*want, (3, 0, at(99_001))], key=str)
