"""Structured Streaming: equality with batch on closed windows, late rows,
dedup state eviction, idempotent foreachBatch."""

from pyspark.sql import functions as F

from feed_help import SF001, feed_rows
from marketlens.plans.trade_volume import trade_volume_onepass
from marketlens.session import scratch_path
from marketlens.sources.fixtures import feed_table
from marketlens.streaming import event_time as E
from marketlens.streaming.microbatch import idempotent_append, parity_transform
from marketlens.streaming.source import read_feed_stream, write_time_slices


def _closed(df, end, delay_s):
    return df.where(F.col("current_time") + F.expr("INTERVAL 1 DAY")
                    <= F.lit(end) - F.expr(f"INTERVAL {delay_s} SECONDS"))


def test_stream_equals_batch_and_drops_late_rows(spark):
    feed = feed_table(spark, SF001)
    src = scratch_path(spark, "t_stream_in")
    write_time_slices(feed, src)
    # a late row: an old instant arriving after the watermark moved on
    late = feed_rows(spark, [(10**9, "2024-01-01 00:00:01", "ETHBTC", "SELL", 1e6, 1e6)])
    late.coalesce(1).write.mode("append").parquet(src)
    s = read_feed_stream(spark, src, files_per_trigger=2)
    out, ckpt = scratch_path(spark, "t_out"), scratch_path(spark, "t_ckpt")
    q = E.run_to_files(E.stream_trade_volume(s, "1 day", "1 hour", decimals=8), out, ckpt)
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    assert dropped >= 1
    got = spark.read.parquet(out)
    end = feed.agg(F.max(F.col("ts").cast("timestamp_ntz"))).first()[0]
    want = _closed(trade_volume_onepass(feed, decimals=8), end, 3600)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_dedup_state_is_evicted(spark):
    feed = feed_table(spark, SF001)
    src = scratch_path(spark, "t_dedup_in")
    write_time_slices(feed, src)
    s = read_feed_stream(spark, src, files_per_trigger=1)
    q = E.run_to_files(E.stream_dedup(s, "1 day", "1 hour"), scratch_path(spark, "t_d"),
                       scratch_path(spark, "t_dc"))
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(totals) > 0 and totals[-1] < max(totals)


def test_foreach_batch_replay_is_idempotent(spark):
    path, log = scratch_path(spark, "t_parity"), scratch_path(spark, "t_log")
    fn = idempotent_append(spark, path=path, log=log, transform=parity_transform("event"))
    batch = feed_table(spark, SF001)
    fn(batch, 0)
    fn(batch, 0)            # replay of the same batch id
    fn(batch.limit(0), 1)   # empty batch writes nothing
    n = spark.read.orc(path).count()
    assert n == spark.read.orc(path).select("currency").distinct().count()


def test_latest_by_key_as_update_mode_stream(spark):
    from marketlens.operators.feeds import latest_by_key
    feed = feed_table(spark, SF001)
    src = scratch_path(spark, "t_latest_in")
    write_time_slices(feed, src)
    s = read_feed_stream(spark, src, files_per_trigger=7)
    out = scratch_path(spark, "t_latest_out")

    def keep(batch, batch_id):      # upserts arrive per batch; keep them all
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    q = latest_by_key(s).writeStream.outputMode("update").foreachBatch(keep) \
        .option("checkpointLocation", scratch_path(spark, "t_latest_ckpt")) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    from pyspark.sql import Window
    w = Window.partitionBy("currency", "feed").orderBy(F.col("batch_id").desc())
    final = spark.read.parquet(out).withColumn("r", F.row_number().over(w)).where("r = 1") \
        .select("currency", "feed", "cost", "seq")
    want = latest_by_key(feed).select("currency", "feed", "cost", "seq")
    assert final.count() == want.count() > 0
    assert final.exceptAll(want).count() == 0


def test_rocksdb_state_store_of_the_cluster_profile(spark):
    from marketlens.session import CLUSTER_SETTINGS
    keys = ["spark.sql.streaming.stateStore.providerClass",
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, CLUSTER_SETTINGS[k])
    try:
        feed = feed_table(spark, SF001)
        src = scratch_path(spark, "t_rocks_in")
        write_time_slices(feed, src)
        s = read_feed_stream(spark, src, files_per_trigger=5)
        out = scratch_path(spark, "t_rocks_out")
        E.run_to_files(E.stream_trade_volume(s, "1 day", "1 hour", decimals=8), out,
                       scratch_path(spark, "t_rocks_ckpt"))
        got = spark.read.parquet(out)
        end = feed.agg(F.max(F.col("ts").cast("timestamp_ntz"))).first()[0]
        want = _closed(trade_volume_onepass(feed, decimals=8), end, 3600)
        assert got.count() == want.count() > 0
        assert got.exceptAll(want.select(*got.columns)).count() == 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_slices_are_written_by_one_job_and_read_in_order(spark):
    feed = feed_table(spark, SF001)
    src = scratch_path(spark, "t_slices")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("slices", "one job for all slices")
    n = write_time_slices(feed, src)
    jobs = len(tracker.getJobIdsForGroup("slices"))
    spark.sparkContext.setJobGroup("none", "")
    assert n > 5 and jobs <= 2          # the scan's shuffle stage and the write, whatever the number of days
    seen = []
    q = read_feed_stream(spark, src, 1).writeStream.foreachBatch(
        lambda b, i: seen.append(b.agg(F.min("us"), F.max("us"), F.count("*")).first())) \
        .option("checkpointLocation", scratch_path(spark, "t_slices_ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert len(seen) == n and all(a[1] < b[0] for a, b in zip(seen, seen[1:]))
    assert sum(s[2] for s in seen) == feed.count()


def test_later_input_releases_the_open_window(spark):
    feed = feed_table(spark, SF001)
    src, out, ckpt = (scratch_path(spark, f"t_open_{x}") for x in ("in", "out", "ckpt"))
    run = lambda: E.run_to_files(E.stream_trade_volume(read_feed_stream(spark, src, 50), "1 day", "1 hour"), out, ckpt)
    write_time_slices(feed, src)
    run()
    everything = trade_volume_onepass(feed).count()
    assert spark.read.parquet(out).count() < everything
    later = feed_rows(spark, [(10**9, "2031-01-01 00:00:01", "ETHBTC", "PRICE", 1.0, None)])
    write_time_slices(later, src)
    run()
    assert spark.read.parquet(out).count() == everything


def test_snapshot_survives_a_broken_batch(spark):
    out = scratch_path(spark, "t_versions")
    frame = lambda *r: spark.createDataFrame(r, "k string, v int")
    frame(("a", 1), ("b", 1)).write.parquet(f"{out}/version-000000000001")
    frame(("a", 2)).write.parquet(f"{out}/change-000000000002")
    frame(("b", 3), ("c", 3)).write.parquet(f"{out}/change-000000000003")
    frame(("a", 0)).write.parquet(f"{out}/change-000000000000")          # older than the version
    read = lambda: {r.k: r.v for r in E.read_snapshot(spark, out, ["k"]).collect()}
    assert read() == {"a": 2, "b": 3, "c": 3}
    _, fs, p = E._complete(spark, out, "change")[-1]
    jvm = spark.sparkContext._jvm
    fs.delete(jvm.org.apache.hadoop.fs.Path(f"{p.toString()}/_SUCCESS"), False)     # the crash
    assert read() == {"a": 2, "b": 1}


def test_snapshot_writes_changed_keys_only(spark):
    from marketlens.operators.feeds import latest_by_key
    feed = feed_table(spark, SF001)
    src, out = scratch_path(spark, "t_changed_in"), scratch_path(spark, "t_changed")
    write_time_slices(feed, src)
    E.latest_snapshot(latest_by_key(read_feed_stream(spark, src, 4)), out, scratch_path(spark, "t_changed_ckpt"), fold_every=1000)
    touched = []
    q = read_feed_stream(spark, src, 4).writeStream.foreachBatch(
        lambda b, i: touched.append(b.select("currency", "feed").distinct().count())) \
        .option("checkpointLocation", scratch_path(spark, "t_touched_ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    written = [spark.read.parquet(p.toString()).count() for _, _, p in E._complete(spark, out, "change")]
    assert written == touched and len(touched) > 3
    want = latest_by_key(feed).select("currency", "feed", "cost", "seq")
    assert E.read_snapshot(spark, out, ["currency", "feed"]).select(*want.columns).exceptAll(want).count() == 0
    assert E.read_snapshot(spark, out, ["currency", "feed"]).count() == want.count()


def test_snapshot_folds_changes_into_versions(spark):
    from marketlens.operators.feeds import latest_by_key
    feed = feed_table(spark, SF001)
    src, out = scratch_path(spark, "t_fold_in"), scratch_path(spark, "t_fold")
    write_time_slices(feed, src)
    E.latest_snapshot(latest_by_key(read_feed_stream(spark, src, 3)), out, scratch_path(spark, "t_fold_ckpt"), fold_every=3)
    versions, changes = E._complete(spark, out, "version"), E._complete(spark, out, "change")
    assert 1 <= len(versions) <= 2 and len(changes) <= 6
    want = latest_by_key(feed).select("currency", "feed", "cost", "seq")
    got = E.read_snapshot(spark, out, ["currency", "feed"]).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
