from __future__ import annotations

from conftest import event, lines

from eventlake.plans.jobs import Lake, read_silver
from eventlake.sources.landing import decode_stream_value, existing_paths, hour_slots, read_landing, slot_paths
from eventlake.streaming.ingest import file_source, start_ingestion


def test_slot_addressed_landing_read(spark, tmp_root):
    root = f"{tmp_root}/landing"
    for hour, eid in ((10, "a"), (12, "b")):
        folder = f"{root}/year=2024/month=01/day=15/hour={hour:02d}/2024-01-15-{hour}.json.gz"
        lines(spark, [event(id=eid)]).coalesce(1).write.option("compression", "gzip").text(folder)
    slots = hour_slots(spark, "2024-01-15 10:00:00", "2024-01-15 12:00:00")
    paths = slot_paths(slots, root)
    assert len(paths) == 3
    present = existing_paths(spark, paths)
    assert len(present) == 2  # hour 11 has no file
    raw = read_landing(spark, present)
    rows = raw.collect()
    assert len(rows) == 2
    assert all("hour=" in r["source_file"] for r in rows)


def test_decode_stream_value(spark):
    df = spark.createDataFrame([(bytearray(b'{"id":"1"}'),)], "value binary")
    assert decode_stream_value(df).collect()[0]["value"] == '{"id":"1"}'


def test_processing_time_trigger(spark, tmp_root):
    src_dir = f"{tmp_root}/incoming"
    lines(spark, [event(id="p1"), event(id="p2")]).coalesce(1).write.text(src_dir)
    lake = Lake(f"{tmp_root}/lake")
    q = start_ingestion(spark, file_source(spark, src_dir, 1), lake, f"{tmp_root}/ckpt",
                        available_now=False, processing_time="1 second", query_name="pt_test")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(r["event_id"] for r in read_silver(spark, lake).collect())
    assert got == ["p1", "p2"]


def test_ingest_files_and_targets(spark, tmp_root):
    from eventlake.plans import jobs

    path = f"{tmp_root}/landing/2024-01-15-10.json.gz"
    recs = [event(id=str(i), actor={"id": i, "login": f"u{i}"}) for i in range(4)] + [event(id=None)]
    lines(spark, recs).coalesce(1).write.option("compression", "gzip").text(path)
    lake = Lake(f"{tmp_root}/lake")
    rep = jobs.ingest_files(spark, lake, [path], run_id="t")
    assert rep.metrics["bronze"]["inserted"] == 4 and rep.metrics["bronze"]["quarantined"] == 1
    top = jobs.select_enrichment_targets(spark, lake, batch_size=10).collect()
    assert [(r["repo_id"], r["actors"], r["activity"]) for r in top] == [(7, 4, 4)]


def test_cluster_conf_sizes_partitions():
    from eventlake.session import cluster_conf

    conf = cluster_conf(total_cores=4000, daily_bytes=300 * 1024**3)
    assert int(conf["spark.sql.shuffle.partitions"]) == 8000  # 2 x cores beats 300 GB / 128 MB
    conf = cluster_conf(total_cores=100, daily_bytes=300 * 1024**3)
    assert int(conf["spark.sql.shuffle.partitions"]) == 2400


def test_stream_source_options():
    """What the message source asks of the reader; the connector is not here."""
    from eventlake.streaming.ingest import kafka_source

    class Reader(dict):
        def format(self, name):
            self["format"] = name
            return self

        def option(self, key, value):
            self[key] = value
            return self

        def load(self):
            return dict(self)

    class Session:
        readStream = Reader()

    got = kafka_source(Session(), {"subscribe": "events"}, max_offsets=50)
    assert got == {"format": "kafka", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "50", "subscribe": "events"}


def test_enrichment_keeps_event_ids_and_reports_targets(spark, tmp_root):
    from eventlake.plans import jobs

    lake = Lake(f"{tmp_root}/lake")
    recs = [event(id=f"{r}-{i}", actor={"id": i, "login": f"u{i}"}, repo={"id": r, "name": f"lab/{r}"}) for r in (1, 2) for i in range(3)]
    jobs.batch_run(spark, lake, lines(spark, recs).selectExpr("value", "'f' AS source_file"))
    records = spark.createDataFrame([(900, "lab/1", "Go", 5, 1, 0, ["b", "a"], None, None, 3)], "id long, full_name string, language string, stargazers_count int, forks_count int, open_issues_count int, topics array<string>, description string, fork boolean, size int")
    report = jobs.enrich_dimension(spark, lake, records, "2024-01-16T00:00:00Z")
    assert (report["targets"], report["fetched"], report["current"]) == (2, 1, 1)
    (row,) = jobs.read_dimension(spark, lake).collect()
    assert (row["repo_id"], row["repo_name"], row["topics"], row["is_fork"]) == (1, "lab/1", "a,b", False)
