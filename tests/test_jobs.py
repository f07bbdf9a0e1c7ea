from __future__ import annotations

from unittest.mock import MagicMock

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from build import detailed, posts, profiles, values
from postlake import files
from postlake.functions.payload import message_json
from postlake.plans import cycle, export
from postlake.plans.extract import extract_segments, segment_counts
from postlake.schemas import DETAILED, POST
from postlake.sinks.extracted import read_extracted
from postlake.sinks.index import index_rows, send
from postlake.sources.cells import read_cells, readable, unreadable
from postlake.sources.exports import read_export, stream_export
from postlake.sources.segments import SegmentStore
from postlake.sinks import bulk
from postlake.sources.topics import FileTopics, KafkaTopics, finish
from postlake.streaming.index import publish_bulks, publish_index
from postlake.streaming.ingest import CONTINUOUS, _deliver, decode_stream, ingest, ingest_slice, without_replays
from postlake.streaming.watch import Watch
from postlake.streaming import publish
from postlake.streaming.publish import publish_streams, publish_topics
from test_operators import landing


def send_to(topics, topic, rows):
    topics.write(rows.select(message_json().alias("value")), topic)


# --- segments to topics -----------------------------------------------------------


@pytest.fixture
def store(spark, folder):
    """Segments s1, s3 and s5 with the same pages; s4 lacks a part."""
    parts = dict(zip(("fetch", "parse_data", "parse_text"), landing(spark)))
    parts["parse"] = parts["fetch"].where("1 = 0")
    for segment in ("s1", "s3", "s5", "s4"):
        for name, rows in parts.items():
            if (segment, name) != ("s4", "parse"):
                rows.drop("segment").write.parquet(f"{folder}/landing/{name}/segment={segment}")
    return SegmentStore(spark, f"{folder}/landing")


def test_segment_selection(store):
    assert store.segments() == ["s1", "s3", "s4", "s5"]
    assert store.complete() == ["s1", "s3", "s5"]
    assert store.select() == ["s1", "s3", "s5"]
    assert store.select("s2", "s4") == ["s3"]
    assert store.select(segment="s5") == ["s5"]
    assert store.select(segment="s4") == []


def test_segment_counts(store):
    counts = {r.segment: r.records for r in segment_counts(store).collect()}
    assert set(counts) == {"s1", "s3", "s5"} and len(set(counts.values())) == 1
    assert all("segment=s3" in path for path in store.part("fetch", ["s3"]).inputFiles())


def test_json_landing_tables(spark, folder):
    for name, rows in zip(("fetch", "parse_data", "parse_text"), landing(spark)):
        rows.drop("segment").write.json(f"{folder}/{name}/segment=20160801")
    files.touch(spark, f"{folder}/parse/segment=20160801/_SUCCESS")
    store = SegmentStore(spark, folder, fmt="json")
    assert extract_segments(store, f"{folder}/out", as_of="2016-06-01") == ["20160801"]
    assert values(read_extracted(spark, f"{folder}/out", "post", ["20160801"]), "url") == [("post1",), ("yes1",)]


def test_extracting_again_replaces_what_was_there_and_only_after_success(spark, folder):
    for name, rows in zip(("fetch", "parse_data", "parse_text"), landing(spark)):
        rows.drop("segment").write.json(f"{folder}/{name}/segment=20160801")
    files.touch(spark, f"{folder}/parse/segment=20160801/_SUCCESS")
    store = SegmentStore(spark, folder, fmt="json")

    def found(kind):
        return values(read_extracted(spark, f"{folder}/out", kind, ["20160801"]), "url")

    extract_segments(store, f"{folder}/out", as_of="2016-06-01")
    assert found("post") == [("post1",), ("yes1",)] and found("quarantine")
    with pytest.raises(Exception, match="no JSON array|lacks metadata|post date"):
        extract_segments(store, f"{folder}/out", as_of="2016-06-01", strict=True)
    assert found("post") == [("post1",), ("yes1",)]
    extract_segments(store, f"{folder}/out", as_of="2026-06-01")
    assert found("post") == [] and found("quarantine")


@pytest.mark.parametrize("batch_size", [1, 2])
def test_extract_and_publish(spark, store, folder, batch_size):
    out = f"{folder}/out"
    assert extract_segments(store, out, batch_size=batch_size, as_of="2016-06-01") == ["s1", "s3", "s5"]
    assert values(read_extracted(spark, out, "post", ["s3"]), "url") == [("post1",), ("yes1",)]
    assert read_extracted(spark, out, "profile", ["s1", "s3", "s5"]).count() == 6
    assert read_extracted(spark, out, "quarantine", ["s1"]).count() == 5
    assert read_extracted(spark, out, "post", ["s4"]).count() == 0

    # Extracting again replaces; a kind that no longer comes out leaves no rows.
    assert extract_segments(store, out, segment="s3", as_of="2016-12-01") == ["s3"]
    assert read_extracted(spark, out, "post", ["s3"]).count() == 0
    assert read_extracted(spark, out, "post", ["s1", "s5"]).count() == 4

    topics = FileTopics(spark, f"{folder}/topics")
    names = {"post": "posts", "profile": "profiles", "detailed": "merged"}
    for segments in (["s1"], ["s1", "s3"], ["s1", "s3", "s5"]):
        publish_topics(spark, out, segments, topics, names, f"{folder}/checkpoint")
    assert topics.read("posts").count() == 4
    assert topics.read("profiles").count() == 6
    assert topics.read("merged").count() == 2
    one = topics.read("merged").select(F.get_json_object("value", "$.profile_city")).first()[0]
    assert one == "c"
    running = publish_streams(spark, out, ["s1"], topics, names, f"{folder}/other", publish.CONTINUOUS)
    for query in running:
        query.processAllAvailable()
        query.stop()
    assert topics.read("posts").count() == 6


# --- topics to tables ---------------------------------------------------------------


def test_ingest_from_two_tenants_and_restart(spark, lake, folder):
    topics = FileTopics(spark, f"{folder}/topics")
    names = {"profile": ["a-profile", "b-profile"], "post": ["a-post"], "detailed": ["a-merged"]}
    send_to(topics, "a-profile", profiles(spark, {"url": "fb://1"}, {"url": "fb://1"}))
    send_to(topics, "b-profile", profiles(spark, {"url": "vk://id1"}))
    send_to(topics, "a-post", posts(spark, {"url": "fb://1/posts/1", "is_comment": True}))
    send_to(topics, "a-merged", detailed(spark, {"url": "fb://2/posts/1", "profile_city": "c"}))
    ingest_slice(lake, topics, names, f"{folder}/checkpoint")
    assert values(lake.profile_to_process.read(), "url") == [("fb://1",), ("vk://id1",)]
    assert values(lake.post_to_process.read(), "url", "is_comment") == [("fb://1/posts/1", True)]
    assert values(lake.post_to_es.read(), "url", "profile_city") == [("fb://2/posts/1", "c")]

    # A restart takes only what is new.
    rows = lake.profile_to_process.rows().count()
    ingest_slice(lake, topics, names, f"{folder}/checkpoint")
    assert lake.profile_to_process.rows().count() == rows
    send_to(topics, "b-profile", profiles(spark, {"url": "vk://id2"}))
    ingest_slice(lake, topics, names, f"{folder}/checkpoint")
    assert lake.profile_to_process.rows().count() == rows + 1

    # A lost checkpoint replays everything, and the keys absorb it.
    before = values(lake.profile_to_process.read())
    ingest_slice(lake, topics, names, f"{folder}/other-checkpoint")
    assert lake.profile_to_process.rows().count() > rows + 1
    assert values(lake.profile_to_process.read()) == before


def test_bad_messages_are_set_aside(spark, lake, folder):
    topics = FileTopics(spark, f"{folder}/topics")
    bad = ["{no", '{"name":"no url"}', '{"url":"u","crawl_date":"soon"}', None]
    made = [(m,) for m in [*bad, '{"url":"fb://1","crawl_date":5}']]
    topics.write(spark.createDataFrame(made, "value string"), "t")
    ingest_slice(lake, topics, {"profile": ["t"]}, f"{folder}/checkpoint")
    assert values(lake.profile_to_process.read(), "url", "crawl_date") == [("fb://1", 5)]
    assert values(lake.bad_messages.read(), "message") == sorted([(m,) for m in bad], key=repr)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        ingest_slice(lake, topics, {"profile": ["t"]}, f"{folder}/strict", strict=True)


def test_a_batch_is_written_to_both_queues_by_one_job_and_held_nowhere(spark, lake, folder, monkeypatch):
    monkeypatch.setattr(DataFrame, "persist", lambda *_: pytest.fail("the batch is held"))
    decoded = spark.sparkContext.accumulator(0)
    value = F.udf(lambda v: decoded.add(1) or v).asNondeterministic()
    made = [(m,) for m in ("{no", '{"url":"a","crawl_date":1}', '{"url":"b","crawl_date":2}')]
    batch = decode_stream(spark.createDataFrame(made, "value string").select(value("value").alias("value")), "profile")
    _deliver(batch, "t", lake.profile_to_process, lake.bad_messages)
    assert decoded.value == 3
    assert values(lake.profile_to_process.read(), "url", "crawl_date") == [("a", 1), ("b", 2)]
    assert lake.profile_to_process.rows_beside().where("ingest_ts IS NULL").isEmpty()
    assert values(lake.bad_messages.read(), "topic", "message", "reason") == [("t", "{no", "no record")]
    # A queue that is a subfolder of its writes, and rows of one sort only.
    merged = detailed(spark, {"url": "d"}).select(message_json().alias("value"))
    _deliver(decode_stream(merged, "detailed"), "t", lake.post_to_es, lake.bad_messages)
    assert values(lake.post_to_es.read(), "url") == [("d",)] and lake.bad_messages.rows().count() == 1
    assert files.matching(spark, f"{lake.root}/*/_staged-*") == []


def test_ingest_counts_rows(spark, lake, folder):
    topics = FileTopics(spark, f"{folder}/topics")
    send_to(topics, "t", profiles(spark, {"url": "a"}, {"url": "b"}))
    (running,) = ingest(lake, topics, {"profile": ["t"]}, f"{folder}/checkpoint")
    running.awaitTermination()
    seen = [p["observedMetrics"]["profile_rows"]["rows"] for p in running.recentProgress if p["observedMetrics"]]
    assert sum(seen) == 2


def test_ingest_at_an_interval_keeps_the_time(spark, lake, folder):
    topics = FileTopics(spark, f"{folder}/topics")
    send_to(topics, "t", profiles(spark, {"url": "a"}, {"url": "b"}))
    (running,) = ingest(lake, topics, {"profile": ["t"]}, f"{folder}/checkpoint", CONTINUOUS)
    running.processAllAvailable()
    running.stop()
    lake.profile_to_process.append(profiles(spark, {"url": "c"}))
    assert values(lake.profile_to_process.read(), "url") == [("a",), ("b",), ("c",)]
    assert values(lake.profile_to_process.rows_beside().where("ingest_ts IS NOT NULL"), "url") == [("a",), ("b",)]


def test_kafka_options():
    """What reaches Spark; no broker is needed to check it."""
    session, rows = MagicMock(), MagicMock()
    topics = KafkaTopics(session, {"kafka.bootstrap.servers": "a:1", "startingOffsets": "earliest"})
    topics.stream("t")
    reader = session.readStream.format
    reader.assert_called_with("kafka")
    reader().options.assert_called_with(**topics.options)
    reader().options().option.assert_called_with("subscribe", "t")
    topics.write(rows, "t")
    rows.write.format().options().option.assert_called_with("topic", "t")
    topics.sink(rows, "t")
    rows.writeStream.format().options().option.assert_called_with("topic", "t")


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        KafkaTopics(spark, {"kafka.bootstrap.servers": "none:1", "startingOffsets": "earliest"}).stream("t")


def test_a_failure_of_one_running_stream_stops_the_others(spark, lake, folder):
    """Both run on; the second one fails while the first has nothing to do."""
    topics = FileTopics(spark, f"{folder}/topics")
    names = {"profile": ["fine"], "post": ["broken"]}
    send_to(topics, "fine", profiles(spark, {"url": "a"}))
    running = ingest(lake, topics, names, f"{folder}/checkpoint", {"processingTime": "1 second"}, strict=True)
    for query in running:
        query.processAllAvailable()
    topics.write(spark.createDataFrame([("{no",)], "value string"), "broken")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        finish(running)
    assert not any(query.isActive for query in running)
    assert values(lake.profile_to_process.read(), "url") == [("a",)]
    finish([])


def test_watch_counts_rows_and_failures(spark, lake, folder):
    topics = FileTopics(spark, f"{folder}/topics")
    send_to(topics, "t", profiles(spark, {"url": "a"}, {"url": "b"}))
    topics.write(spark.createDataFrame([("{no",)], "value string"), "u")
    with Watch(spark) as watch:
        watch.settle(ingest_slice(lake, topics, {"profile": ["t", "u"]}, f"{folder}/checkpoint"))
        assert dict(watch.rows) == {"ingest t": 2, "ingest u": 1} and not watch.failures
        failing = ingest(lake, topics, {"post": ["u"]}, f"{folder}/strict", strict=True)
        with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
            finish(failing)
        watch.settle(failing)
        assert list(watch.failures) == ["ingest u"]


def test_replays_within_the_window_are_not_written(spark, lake, folder):
    topics = FileTopics(spark, f"{folder}/topics")
    names, rows = {"profile": ["t"]}, profiles(spark, {"url": "a"}, {"url": "a"}, {"url": "b"})
    for _ in range(3):
        send_to(topics, "t", rows)
        topics.write(spark.createDataFrame([("{no",), (None,)], "value string"), "t")
        ingest_slice(lake, topics, names, f"{folder}/checkpoint", replay_window="1 hour")
    assert values(lake.profile_to_process.rows(), "url") == [("a",), ("b",)]
    assert lake.bad_messages.rows().count() == 2
    # A later version of a record is no replay.
    send_to(topics, "t", profiles(spark, {"url": "a", "name": "new"}))
    (query,) = ingest_slice(lake, topics, names, f"{folder}/checkpoint", replay_window="1 hour")
    assert lake.profile_to_process.rows().count() == 3
    state = query.lastProgress["stateOperators"][0]
    assert state["operatorName"] == "dedupeWithinWatermark" and state["numRowsTotal"] <= 5


def test_state_of_replays_is_bounded(spark, folder):
    """Digests older than the window are forgotten, and what comes again after that is taken again."""
    states = []
    for k, message in enumerate(("a", "b", "c", "a")):
        made = spark.sql(f"SELECT concat('{message}', id) AS value, timestamp_seconds({k + 1} * 7200) AS ingest_ts FROM range(10)")
        made.coalesce(1).write.parquet(f"{folder}/in/{k}")
        rows = without_replays(spark.readStream.schema(made.schema).parquet(f"{folder}/in/*"), "1 hour")
        sink = rows.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
        running = sink.trigger(availableNow=True).start()
        finish([running])
        states += [p["stateOperators"][0]["numRowsTotal"] for p in running.recentProgress if p["stateOperators"]]
    assert max(states) <= 20
    assert spark.read.parquet(f"{folder}/out").count() == 40


# --- cells, exports and the index -----------------------------------------------------


def test_cells(spark, folder):
    rows = [("a", 1, '{"name":"n","reach":"5"}'), ("b", 2, "broken")]
    spark.createDataFrame(rows, "id string, crawl_date long, json string").write.parquet(folder)
    cells = read_cells(spark, folder, "profile")
    assert values(readable(cells), "url", "crawl_date", "name", "reach") == [("a", 1, "n", "5")]
    assert values(unreadable(cells)) == [("b", 2, "broken")]


def test_missing_export(spark, folder):
    assert read_export(spark, f"{folder}/none", POST, missing="skip").count() == 0
    assert stream_export(spark, f"{folder}/none", POST, missing="skip") is None
    for read in (read_export, stream_export):
        with pytest.raises(FileNotFoundError):
            read(spark, f"{folder}/none", POST)


def test_export_and_index(spark, lake, folder):
    lake.post_to_es.append(detailed(
        spark,
        {"url": "a"}, {"url": "empty", "body": ""}, {"url": "null", "body": None}, {"url": "blank", "body": " "},
        {"url": "old", "date": "2000-12-21T02:29:27+0000"}, {"url": "bad", "date": "bad"},
        {"url": "edge", "date": "2014-01-01T00:30:00+0300"},
    ))
    export.export_for_index(lake, f"{folder}/export")
    assert values(spark.read.parquet(f"{folder}/export"), "url") == [("a",), ("blank",), ("edge",), ("old",)]
    assert values(lake.undated.read(), "url") == [("bad",)]
    for checkpoint in ("one", "one", "two"):
        publish_index(spark, f"{folder}/export", lake.index.put, f"{folder}/{checkpoint}", "m-")
    assert values(lake.index.read(), "index_name", "_id") == [
        ("m-y2013-hy2-q4-m12", "edge"), ("m-y2016-hy1-q2-m4", "a"), ("m-y2016-hy1-q2-m4", "blank")]
    with pytest.raises(Exception, match="unreadable post date"):
        export.export_for_index(lake, f"{folder}/strict", strict=True)


def test_index_rows_can_go_to_any_writer(spark, folder):
    rows = index_rows(detailed(spark, {"url": "a"}), "m-")
    send(rows, "json", path=folder)
    assert values(spark.read.json(folder), "_id", "index_name") == [("a", "m-y2016-hy1-q2-m4")]


def test_bulks_are_cut_by_bytes():
    rows = [("m", f"id{k}", "x" * n) for k, n in enumerate([10, 60, 5, 500, 5, 5])]
    made = list(bulk.bulks(iter(rows), 120))
    assert b"".join(made).count(b"\n") == 12
    assert [(len(b) <= 120, b.count(b"\n")) for b in made] == [(True, 2), (True, 2), (True, 2), (False, 2), (True, 4)]
    assert list(bulk.bulks(iter([]), 120)) == []


def test_bulks_hold_what_was_written_and_a_repeated_batch_replaces(spark, folder):
    bulk.register(spark)
    rows = spark.createDataFrame([("m", f"ü\"{k}", f'{{"a":"line\\n{k}"}}') for k in range(100)], "index_name string, _id string, source string").repartition(3)
    rows.write.format("bulk_index").option("path", f"{folder}/batch").option("bulk_bytes", 500).mode("append").save()
    found = bulk.read_bulks(spark, f"{folder}/batch")
    assert values(found.drop("bulk")) == values(rows)
    assert found.select("bulk").distinct().count() > 10
    failing = rows.withColumn("source", F.when(F.col("_id") == 'ü"7', F.raise_error(F.lit("no"))).otherwise(F.col("source")))
    with pytest.raises(Exception, match="no"):
        failing.write.format("bulk_index").option("path", f"{folder}/failed").mode("append").save()
    assert files.matching(spark, f"{folder}/failed/job=*") == [] and files.matching(spark, f"{folder}/failed/_staged/*") == []

    # A batch whose commit was lost runs again.
    rows.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    sink = stream.writeStream.format("bulk_index").option("path", f"{folder}/stream").option("checkpointLocation", f"{folder}/checkpoint")
    for _ in range(2):
        finish([sink.trigger(availableNow=True).start()])
        assert values(bulk.read_bulks(spark, f"{folder}/stream").drop("bulk")) == values(rows)
        files.delete(spark, f"{folder}/checkpoint/commits/0")


def test_an_export_is_read_in_batches_and_archived(spark, lake, folder):
    detailed(spark, *[{"url": f"u{k}"} for k in range(6)]).withColumn("post_local_date", F.lit("2016-01-01").cast("date")).repartition(3).write.parquet(f"{folder}/export")
    parts = len(files.matching(spark, f"{folder}/export/part-*"))
    for _ in range(2):
        publish_bulks(spark, f"{folder}/export", f"{folder}/bulks", f"{folder}/checkpoint", "m-", max_files=1, archive=f"{folder}/archive")
    assert bulk.read_bulks(spark, f"{folder}/bulks").count() == 6
    assert len(files.matching(spark, f"{folder}/bulks/batch=*")) >= parts
    left = files.matching(spark, f"{folder}/export/part-*")
    assert len(left) <= 1  # the last batch's
    with pytest.raises(Exception, match="maxBytesPerTrigger"):
        stream_export(spark, f"{folder}/export", POST, max_files=1, max_bytes=1).writeStream.format("noop").option(
            "checkpointLocation", f"{folder}/none").trigger(availableNow=True).start().awaitTermination()


def test_segments_are_published_once_whatever_the_lists(spark, store, folder):
    out, topics = f"{folder}/out", FileTopics(spark, f"{folder}/topics")
    extract_segments(store, out, as_of="2016-06-01")
    sent = []
    for segments in (["s5"], ["s1", "s5"], ["s3"], ["s1", "s3", "s5"]):
        publish_topics(spark, out, segments, topics, {"post": "posts", "profile": "profiles"}, f"{folder}/checkpoint")
        sent.append((topics.read("posts").count(), topics.read("profiles").count()))
    assert sent == [(2, 2), (4, 4), (6, 6), (6, 6)]


# --- the cycle ----------------------------------------------------------------------


@pytest.fixture
def config(spark, folder):
    return cycle.CycleConfig(
        topics=FileTopics(spark, f"{folder}/topics"),
        names={"profile": ["profiles"], "post": ["posts"], "detailed": ["merged"]},
        checkpoint=f"{folder}/checkpoint",
        exports=f"{folder}/exports",
        prefix="m-",
    )


def queues(lake):
    names = ("profile_to_process", "post_to_process", "post", "post_to_es", "post_without_profile")
    return {name: getattr(lake, name).read().count() for name in names}


def test_author_arrives_a_cycle_later(spark, lake, config):
    send_to(config.topics, "posts", posts(
        spark, {"url": "p1", "profile_id": "a"}, {"url": "p2", "profile_id": "b"}, {"url": "p3"}))
    send_to(config.topics, "profiles", profiles(spark, {"url": "a", "name": "A"}))
    send_to(config.topics, "merged", detailed(spark, {"url": "d1"}))
    cycle.run_cycle(lake, config)
    assert values(lake.index.read(), "_id") == [("d1",), ("p1",)]
    assert values(lake.post_to_process.read(), "url") == [("p2",), ("p3",)]

    send_to(config.topics, "profiles", profiles(spark, {"url": "b", "name": "B"}))
    cycle.run_cycle(lake, config)
    assert values(lake.index.read(), "_id") == [("d1",), ("p1",), ("p2",)]
    assert queues(lake) == {
        "profile_to_process": 0, "post_to_process": 1, "post": 0, "post_to_es": 0, "post_without_profile": 0}
    assert values(lake.profile.read(), "url") == [("a",), ("b",)]
    assert files.matching(spark, f"{config.exports}/*") == []


def test_failed_step_empties_nothing(spark, lake, config):
    send_to(config.topics, "posts", posts(spark, {"url": "p1", "profile_id": "a"}, {"url": "p2"}))
    send_to(config.topics, "profiles", profiles(spark, {"url": "a"}))

    def refuse(batch):
        raise RuntimeError("index is down")

    config.deliver = refuse
    with pytest.raises(Exception, match="index is down"):
        cycle.run_cycle(lake, config)
    assert queues(lake) == {
        "profile_to_process": 1, "post_to_process": 2, "post": 2, "post_to_es": 1, "post_without_profile": 1}

    config.deliver = None
    cycle.run_cycle(lake, config)
    assert values(lake.index.read(), "_id") == [("p1",)]
    assert values(lake.post_to_process.read(), "url") == [("p2",)]


def test_detailed_columns(spark, lake):
    assert lake.post_to_es.read().columns == DETAILED.names
