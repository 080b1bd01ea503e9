from __future__ import annotations

import datetime as dt
import json
import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopmill import session
from shopmill.operators import combine, ingest
from shopmill.operators.ingest import HISTORIC, LATEST, Batch
from shopmill.plans import loads, tables
from shopmill.plans.staging import stage
from shopmill.registry import landing_schema, staged_schema
from shopmill.sources import database, files, raw, sinks
from shopmill.streaming import ingest as stream
from shopmill.streaming.ingest import read_streamed, stream_into_raw, stream_into_table

FIRST = Batch("b1", "2024-05-01 10:00:00")
SECOND = Batch("b2", "2024-05-02 10:00:00")


def events(spark, *data):
    """Landed interactions from (id, day, type) triples."""
    df = spark.createDataFrame(list(data), "event_id string, event_date string, event_type string")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in landing_schema("interactions").fields
        ]
    )


def kinds(df):
    return rows(df.select("event_id", "event_type"))


# --- files --------------------------------------------------------------------------------


def test_csv_keeps_quotes_commas_blanks_and_line_breaks(spark, path):
    data = [("1", 'say "hi", twice'), ("2", " padded "), ("3", "two\nlines"), ("4", None), ("5", "\\")]
    df = spark.createDataFrame(data, "CATEGORY_ID string, CATEGORY_NAME string")
    sinks.write_csv(df, f"{path}/csv", rows_per_file=2)
    back = files.read_csv(spark, f"{path}/csv", rows=df.schema, line_breaks=True)
    assert rows(back) == rows(df)
    assert len(list(Path(f"{path}/csv").glob("part-*"))) > 1


def test_csv_without_line_breaks_splits(spark, path):
    df = spark.range(100).select(F.col("id").cast("string").alias("category_id"))
    sinks.write_csv(df, f"{path}/csv")
    assert files.read_csv(spark, f"{path}/csv", rows=df.schema, line_breaks=False).count() == 100


def test_json_envelope(spark, path):
    document = {
        "metadata": {"table": "reviews", "recordCount": 2, "generatedAt": "x", "version": "1.0"},
        "data": [
            {"review_id": 7, "review_score": 5, "review_text": "good\nstuff"},
            {"review_id": None, "review_score": 1},
        ],
    }
    for part in ("a", "b"):
        Path(path, f"{part}.json").write_text(json.dumps(document, indent=1))
    found = files.read_envelopes(spark, path, "reviews")
    assert found.columns == [f.name for f in landing_schema("reviews").fields]
    assert rows(found.select("review_id", "review_score", "review_text")) == sorted(
        [("7", 5, "good\nstuff"), (None, 1, None)] * 2, key=repr
    )


def test_source_names():
    assert database.table_name("orders") == "orders"
    assert database.table_name("orders", "latest") == "latest_orders"
    assert files.json_path("/r/", "orders", "latest") == "/r/latest/json/orders.json"
    assert files.csv_path("/r", "orders") == "/r/historic/csv/orders.csv"


def test_database_options():
    options = database.read_options("jdbc:x", "orders", "latest", "order_id", (1, 900), 8)
    assert options["dbtable"] == "latest_orders"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"]) == (
        "order_id", "1", "900",
    )
    assert options["numPartitions"] == "8"
    assert "partitionColumn" not in database.read_options("jdbc:x", "orders")
    with pytest.raises(ValueError, match="bound"):
        database.read_options("jdbc:x", "orders", key="order_id")
    assert database.write_options("jdbc:x", "t")["truncate"] == "true"
    with pytest.raises(ValueError, match="single task"):
        database.read_table(None, "jdbc:x", "orders")


# --- raw layer ----------------------------------------------------------------------------


def test_append_is_repeatable_and_reads_newest(spark, path):
    old = ingest.transform(events(spark, ("1", "2024-01-01", "a"), ("2", "2024-01-01", "b")), "interactions", FIRST)
    new = ingest.transform(events(spark, ("2", "2024-01-01", "c")), "interactions", SECOND)
    for df, batch in ((new, SECOND), (old, FIRST), (new, SECOND)):
        sinks.append_batch(df, path, "interactions", batch.batch_id)
    assert raw.read_raw(spark, path, "interactions", newest=False).count() == 3
    assert kinds(raw.read_raw(spark, path, "interactions")) == [("1", "a"), ("2", "c")]
    raw.compact(spark, path, "interactions", f"{path}/compacted", "c1")
    assert raw.read_raw(spark, f"{path}/compacted", "interactions", newest=False).count() == 2
    assert kinds(raw.read_raw(spark, f"{path}/compacted", "interactions")) == [("1", "a"), ("2", "c")]


THIRD = Batch("20010203", "2024-05-03 10:00:00")


def test_replaced_rows_stay_away(spark, path):
    """A historic row inside the overlap that is not redelivered goes, and no later increment brings it back."""
    rows_of = {
        FIRST: [("1", "2024-01-01", "a"), ("9", "2024-01-02", "b"), ("2", "2024-02-05", "gone")],
        SECOND: [("3", "2024-02-01", "c")],
        THIRD: [("4", "2024-03-01", "d")],
    }

    def load(how, batch):
        read = lambda _, part: events(spark, *(rows_of[batch] if (part == LATEST) == (batch is not FIRST) else []))
        loads.require_loaded(loads.run_loads(spark, how, read, path, batch, ["interactions"], f"{path}-copies"))

    load(loads.load_initial, FIRST)
    for batch in (SECOND, THIRD, THIRD):
        load(loads.load_increment, batch)
    current = [("1", "a"), ("3", "c"), ("4", "d"), ("9", "b")]
    assert kinds(raw.read_raw(spark, path, "interactions")) == current
    copy = files.read_csv(spark, f"{path}-copies/interactions/{THIRD.batch_id}/csv", "interactions")
    assert kinds(copy) == current
    raw.compact(spark, path, "interactions", f"{path}-new", "all")
    assert kinds(raw.read_raw(spark, f"{path}-new", "interactions")) == current


def test_later_columns_odd_batch_ids_and_emptied_parts(spark, path):
    first = ingest.transform(events(spark, ("1", "2024-01-01", "a")), "interactions", FIRST)
    both = first.withColumn("SOURCE_PART", F.lit(HISTORIC)).unionByName(
        first.withColumns({"EVENT_ID": F.lit("2"), "SOURCE_PART": F.lit(LATEST)})
    )
    sinks.append_batch(both, path, "interactions", "20010201")
    sinks.append_batch(both.where(f"SOURCE_PART = '{HISTORIC}'"), path, "interactions", "20010201")
    later = ingest.transform(events(spark, ("3", "2024-01-01", "c")), "interactions", SECOND)
    sinks.append_batch(later.withColumn("EXTRA", F.lit(7)), path, "interactions", "rerun/2 = odd")
    found = raw.read_raw(spark, path, "interactions")
    assert sorted((r.EVENT_ID, r.EXTRA) for r in found.collect()) == [("1", None), ("3", 7)]
    left = raw.read_raw(spark, path, "interactions", before="20010201")
    assert [r.EVENT_ID for r in left.collect()] == ["3"]


def test_a_conflicting_type_is_rejected_and_the_table_stays_readable(spark, path):
    first = ingest.transform(events(spark, ("1", "2024-01-01", "a")), "interactions", FIRST)
    sinks.append_batch(first, path, "interactions", FIRST.batch_id)
    odd = first.withColumn("CUSTOMER_ID", F.lit(7))
    with pytest.raises(ValueError, match="column CUSTOMER_ID is string in batch b1, int in the new batch"):
        sinks.append_batch(odd, path, "interactions", SECOND.batch_id)
    assert kinds(raw.read_raw(spark, path, "interactions")) == [("1", "a")]
    # A batch may change its own types.
    sinks.append_batch(odd, path, "interactions", FIRST.batch_id)
    assert raw.read_raw(spark, path, "interactions").schema["CUSTOMER_ID"].dataType.simpleString() == "int"


def test_only_committed_batches_are_read(spark, path):
    """Rows of an append that died before its commit are not there; a rerun keeps one copy on disk."""
    first = ingest.transform(events(spark, ("1", "2024-01-01", "a")), "interactions", FIRST)
    for _ in range(2):
        record = sinks.append_batch(first, path, "interactions", FIRST.batch_id)
    first.withColumns({"EVENT_ID": F.lit("2"), sinks.BATCH: F.lit("x")}).write.parquet(f"{path}/interactions/rows/batch-x/1")
    assert kinds(raw.read_raw(spark, path, "interactions")) == [("1", "a")]
    assert [p.name for p in Path(path, "interactions", "rows", "batch-b1").iterdir()] == [record["folder"].split("/")[1]]
    assert (record["total_records"], record["first_loaded"], record["min_date"]) == (1, "2024-05-01 10:00:00", "2024-01-01 00:00:00")
    with pytest.raises(FileNotFoundError):
        raw.read_raw(spark, path, "interactions", before=FIRST.batch_id)


def test_the_raw_table_is_scanned_once(spark, path):
    for day, batch in enumerate((FIRST, SECOND, THIRD), 1):
        rows_of = ingest.transform(events(spark, (str(day), f"2024-01-0{day}", "a")), "interactions", batch)
        sinks.append_batch(rows_of, path, "interactions", batch.batch_id, replaces_from="EVENT_DATE")
    plan = raw.read_raw(spark, path, "interactions")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("BroadcastHashJoin") == 1


def test_mixed_load_times_and_many_cuts(spark, path):
    """Against a plain version: each row goes if a batch loaded later has a cut at or before its date."""
    rng, batches_of, wanted = random.Random(4), [], []
    for number in range(7):
        times = [f"2024-05-{rng.randrange(1, 9):02d} 10:00:00" for _ in range(rng.choice([1, 1, 3]))]
        batches_of.append([(f"{number}-{i}", f"2024-01-{rng.randrange(1, 29):02d}", rng.choice(times), rng.choice([True, False])) for i in range(6)])
    cuts_of = [rng.random() < 0.6 for _ in batches_of]
    for number, own in enumerate(batches_of):
        df = ingest.transform(events(spark, *((i, d if dated else None, "a") for i, d, _, dated in own)), "interactions", FIRST)
        at = F.create_map(*[F.lit(x) for i, _, t, _ in own for x in (i, t)])[F.col("EVENT_ID")]
        sinks.append_batch(
            df.withColumn("LOADED_AT", at.cast("timestamp_ntz")), path, "interactions", f"n{number}",
            replaces_from="EVENT_DATE" if cuts_of[number] else None,
        )
    marks = []
    for own, cutting in zip(batches_of, cuts_of):
        dates = [d for _, d, _, dated in own if dated]
        if cutting and dates:
            marks.append((max(t for *_, t, _ in own), min(dates)))
    for own in batches_of:
        for i, d, t, dated in own:
            if not any(at > t and (not dated or d >= cut) for at, cut in marks):
                wanted.append(i)
    assert sorted(r.EVENT_ID for r in raw.read_raw(spark, path, "interactions").collect()) == sorted(wanted)


def test_the_whole_error_is_kept(spark, path):
    def read(table, part):
        raise OSError("x" * 2000 + " the cause")

    status = loads.run_loads(spark, loads.load_initial, read, path, FIRST, ["orders"])
    assert status.first().error.endswith("the cause")


def test_append_rows_creates_and_extends_a_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS append_test")
    df = spark.createDataFrame([(1, 2.0, True)], "i int, d float, b boolean")
    sinks.append_rows(df, "append_test.t")
    sinks.append_rows(df, "append_test.t", rows_per_file=1)
    sinks.append_rows(df.where("false"), "append_test.t")
    assert dict(spark.table("append_test.t").dtypes) == {"i": "bigint", "d": "double", "b": "boolean"}
    assert spark.table("append_test.t").count() == 2


PARTS = {
    HISTORIC: [("1", "2024-01-01", "a"), ("2", "2024-01-03", "b"), ("3", "2024-01-04", "gone")],
    LATEST: [("2", "2024-01-03", "new"), ("4", "2024-01-05", "d")],
}
NEXT = [("4", "2024-01-05", "again"), ("5", "2024-01-06", "e")]


def test_loads_isolate_failures_and_keep_copies(spark, path):
    def read(table, part):
        if table == "orders":
            raise OSError("source is down")
        return events(spark, *PARTS[part])

    status = loads.run_loads(
        spark, loads.load_initial, read, f"{path}/raw", FIRST, ["orders", "interactions"], f"{path}/copies"
    )
    assert [(r.table_name, r.status) for r in status.collect()] == [
        ("orders", "failed"), ("interactions", "loaded"),
    ]
    with pytest.raises(RuntimeError, match="source is down"):
        loads.require_loaded(status)
    everything = [("1", "a"), ("2", "new"), ("3", "gone"), ("4", "d")]
    assert kinds(raw.read_raw(spark, f"{path}/raw", "interactions")) == everything
    copy = files.read_csv(spark, f"{path}/copies/interactions/b1/csv", "interactions")
    assert kinds(copy) == everything
    about = spark.read.json(f"{path}/copies/interactions/b1/metadata").first()
    assert (about.historic_records, about.latest_records, about.total_records) == (3, 2, 5)


def test_incremental_load_can_be_repeated(spark, path):
    def read(table, part):
        return events(spark, *PARTS[part])

    def read_next(table, part):
        return events(spark, *NEXT)

    names = ["interactions"]
    loads.require_loaded(loads.run_loads(spark, loads.load_initial, read, path, FIRST, names))
    for _ in range(2):
        status = loads.run_loads(
            spark, loads.load_increment, read_next, path, SECOND, names, f"{path}/copies"
        )
        loads.require_loaded(status)
    assert raw.read_raw(spark, path, "interactions", newest=False).count() == 6
    final = [("1", "a"), ("2", "new"), ("3", "gone"), ("4", "again"), ("5", "e")]
    assert kinds(raw.read_raw(spark, path, "interactions")) == final
    copy = files.read_csv(spark, f"{path}/copies/interactions/b2/csv", "interactions")
    assert kinds(copy) == final


def test_an_increment_without_copies_reads_no_history(spark, path, monkeypatch):
    """The batch takes the history's columns and types, none of its rows, whether the table has a key or not."""
    kinds_of = {HISTORIC: "id string, n int, extra int", LATEST: "id string, n int, extra int", "next": "id string, n bigint"}
    parts = {HISTORIC: [("1", 1, 1)], LATEST: [("2", 2, 2)], "next": [("2", 3), ("3", 4)]}
    read = lambda _, part: spark.createDataFrame(parts[part], kinds_of[part])
    loads.load_initial(spark, read, "visits", path, FIRST)
    loads.load_initial(spark, lambda _, part: events(spark, *PARTS[part]), "interactions", path, FIRST)
    appended, append = [], sinks.append_batch
    monkeypatch.setattr(sinks, "append_batch", lambda df, *a, **k: appended.append(df))
    read_next = lambda _, part: read(_, "next")
    loads.load_increment(spark, read_next, "visits", path, SECOND)
    loads.load_increment(spark, lambda *_: events(spark, *NEXT), "interactions", path, SECOND)
    df, keyed = appended
    assert keyed.inputFiles() == [] and keyed.count() == 2 and raw.read_raw(spark, path, "interactions").inputFiles()
    assert df.inputFiles() == [] and raw.read_raw(spark, path, "visits").inputFiles()
    assert rows(df.select("ID", "N", "EXTRA")) == [("2", 3, None), ("3", 4, None)]
    assert [dict(df.dtypes)[c] for c in ("N", "EXTRA")] == ["bigint", "int"]
    with pytest.raises(ValueError, match="column N is int in batch b1, bigint"):
        append(df, path, "visits", SECOND.batch_id)


def test_dates_of_an_unknown_table_are_found_while_it_is_written(spark, path):
    """A column is a timestamp as long as every batch's values are; no job runs before the write."""
    kind = "id string, seen_date string, ship_time string, note string, created_at string"
    first = [("1", "2024-01-01", "2024-01-02 03:04:05", "2024-01-01", "2024-01-01"), ("2", None, None, "x", "2024-02-01")]
    second = [("3", "2024-03-01", "soon", None, "2024-03-01")]
    parts = {HISTORIC: first[:1], LATEST: first[1:]}

    def load(run, batch, data):
        run(spark, lambda _, part: spark.createDataFrame(data[part], kind), "visits", path, batch)

    def kinds_now():
        return {n: k for n, k in raw.read_raw(spark, path, "visits").dtypes if n.endswith(("DATE", "TIME", "_AT")) or n == "NOTE"}

    load(loads.load_initial, FIRST, parts)
    stamps = dict.fromkeys(("SEEN_DATE", "SHIP_TIME", "CREATED_AT", "LOADED_AT"), "timestamp_ntz") | {"NOTE": "string"}
    assert kinds_now() == stamps
    load(loads.load_increment, SECOND, {LATEST: second})
    assert kinds_now() == stamps | {"SHIP_TIME": "string"}
    found = raw.read_raw(spark, path, "visits").select("ID", "SEEN_DATE", "SHIP_TIME")
    assert rows(found) == [
        ("1", dt.datetime(2024, 1, 1), "2024-01-02 03:04:05"), ("2", None, None), ("3", dt.datetime(2024, 3, 1), "soon"),
    ]
    raw.compact(spark, path, "visits", f"{path}/new", "all")
    assert rows(raw.read_raw(spark, f"{path}/new", "visits").select("ID", "SEEN_DATE", "SHIP_TIME")) == rows(found)
    load(loads.load_increment, SECOND, {LATEST: [("3", "2024-03-01", "2024-03-02", None, "2024-03-01")]})
    assert kinds_now() == stamps


def test_stream_equals_batch_and_restarts(spark, path):
    deliveries = [PARTS[HISTORIC], PARTS[LATEST], NEXT]

    def run(number):
        stream_into_raw(
            spark, f"{path}/in", f"{path}/raw", "interactions", f"{path}/ck", 1,
            lambda n: f"2024-05-01 10:00:{n:02d}",
        ).awaitTermination()

    for number, data in enumerate(deliveries):
        events(spark, *data).coalesce(1).write.mode("append").json(f"{path}/in")
        run(number)
    run(3)
    assert raw.read_raw(spark, f"{path}/raw", "interactions", newest=False).count() == 7

    for number, data in enumerate(deliveries):
        batch = Batch(f"batch-{number}", f"2024-05-01 10:00:{number:02d}")
        df = ingest.transform(events(spark, *data), "interactions", batch)
        sinks.append_batch(df, f"{path}/batch", "interactions", batch.batch_id)
    streamed = raw.read_raw(spark, f"{path}/raw", "interactions")
    batched = raw.read_raw(spark, f"{path}/batch", "interactions")
    same = [c for c in streamed.columns if c != "BATCH_ID"]
    assert rows(streamed.select(same)) == rows(batched.select(same))


def test_stream_table_holds_one_row_per_key(spark, path, monkeypatch):
    """Corrections replace, a replay after a crash changes nothing, rows without key stay once each."""
    deliveries = [
        [("a", "2024-01-01", "view"), ("b", "2024-01-01", "view"), (None, "2024-01-01", "lost")],
        [("b", "2024-01-02", "purchase"), ("c", "2024-01-02", "view"), (None, "2024-01-01", "lost")],
        [("a", "2024-01-03", "cart_add"), ("a", "2024-01-03", "cart_add"), (None, "2024-01-03", "lost")],
    ]
    clock = iter(range(60))

    def run():
        stream_into_table(
            spark, f"{path}/in", f"{path}/t", "interactions", f"{path}/ck", 1,
            lambda n: f"2024-05-01 10:00:{next(clock):02d}", 8,
        ).awaitTermination()

    def found():
        return kinds(read_streamed(spark, f"{path}/t"))

    wanted, unkeyed = {}, []
    for number, data in enumerate(deliveries):
        events(spark, *data).coalesce(1).write.mode("append").json(f"{path}/in")
        if number == 1:
            # Dies when the table is written and the micro-batch is not yet committed.
            with monkeypatch.context() as patch:
                patch.setattr(stream, "upsert_path", lambda *a, **k: [tables.upsert_path(*a, **k), 1 / 0])
                with pytest.raises(Exception, match="division by zero"):
                    run()
        run()
        wanted |= {k: kind for k, _, kind in data if k}
        unkeyed += [(None, kind) for k, _, kind in data if k is None]
        assert found() == sorted([*wanted.items(), *unkeyed], key=repr)
    done = found()
    for commit in Path(path, "ck", "commits").glob("*2*"):
        commit.unlink()
    run()
    assert found() == done
    ids = {r.BATCH_ID.rsplit("-", 1)[0] for r in read_streamed(spark, f"{path}/t").collect()}
    assert len(ids) == 1 and "None" not in ids

    # A new checkpoint is another stream: its rows without key are not taken for a replay.
    events(spark, (None, "2024-01-01", "lost"), ("d", "2024-01-01", "view")).write.json(f"{path}/in2")
    stream_into_table(spark, f"{path}/in2", f"{path}/t", "interactions", f"{path}/ck2", 9, buckets=8).awaitTermination()
    assert found() == sorted([*done, (None, "lost"), ("d", "view")], key=repr)
    with pytest.raises(ValueError, match="no key"):
        stream_into_table(spark, f"{path}/in", f"{path}/u", "unknown", f"{path}/ck3")


# --- staging and tables -------------------------------------------------------------------


def test_staging_is_strict_unless_told_otherwise(spark):
    fields = [f.name for f in staged_schema("subcategories").fields]
    raw_rows = spark.createDataFrame([["1"] * 3 + ["no date"] + ["x", "y", "2024-01-01"]], fields)
    upper = raw_rows.toDF(*[c.upper() for c in fields])
    assert stage(upper, "subcategories", strict=False).first().created_at is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(upper, "subcategories").collect()


def test_money_is_rounded_half_up(spark):
    df = spark.sql("SELECT cast(1.005 AS decimal(10,3)) AS total_price")
    fields = [f for f in staged_schema("order_items").fields if f.name != "total_price"]
    full = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    assert str(stage(full, "order_items").first().total_price) == "1.01"


def month(spark, *data):
    df = spark.createDataFrame(list(data), "k string, m string, v int")
    return df.select("k", F.col("m").cast("date").alias("m"), "v")


def test_upsert_rewrites_touched_partitions_only(spark, path):
    tables.upsert_path(month(spark, ("a", "2024-01-01", 1), ("b", "2024-02-01", 1)), f"{path}/t", ["k", "m"], "m")
    untouched = set(Path(path).glob("t/m=2024-01-01/*.parquet"))
    for _ in range(2):
        tables.upsert_path(
            month(spark, ("b", "2024-02-01", 2), ("c", "2024-03-01", 2)), f"{path}/t", ["k", "m"], "m"
        )
    assert rows(tables.read_upserted(spark, f"{path}/t").select("k", "m", "v")) == [
        ("a", dt.date(2024, 1, 1), 1), ("b", dt.date(2024, 2, 1), 2), ("c", dt.date(2024, 3, 1), 2),
    ]
    assert set(Path(path).glob("t/m=2024-01-01/*.parquet")) == untouched


def test_upsert_leaves_no_scratch(spark, path):
    for value in (1, 2):
        tables.upsert_path(month(spark, ("a", "2024-01-01", value)), f"{path}/t", ["k", "m"], "m")
    scratch = Path(session.work_path(spark, "upsert").removeprefix("file:"))
    assert not scratch.exists() or not any(scratch.iterdir())


def test_upsert_by_hash_bucket(spark, path):
    for value in (1, 2):
        df = spark.range(value * 50).select(F.col("id").cast("string").alias("k"), F.lit(value).alias("v"))
        tables.upsert_path(df.where("cast(k as int) >= 20 or v = 1"), f"{path}/t", ["k"], buckets=4)
    found = {int(r.k): r.v for r in tables.read_upserted(spark, f"{path}/t").collect()}
    assert found == {k: 1 if k < 20 else 2 for k in range(100)}


def test_upsert_partition_must_be_part_of_the_key(spark, path):
    with pytest.raises(ValueError, match="key"):
        tables.upsert_path(month(spark), path, ["k"], "m")


def test_layers_tables_and_views(spark, path):
    tables.create_layers(spark, path, ["layer_test"])
    tables.create_layers(spark, path, ["layer_test"])
    build = {"one": spark.range(3), "two": spark.range(5)}
    tables.refresh(build.__getitem__, "layer_test", build)
    tables.write_table(spark.range(4), "layer_test", "one")
    assert spark.table("layer_test.one").count() == 4
    assert Path(path, "layer_test", "two").exists()
    tables.write_view(spark.range(2), "a_view")
    assert spark.table("a_view").count() == 2


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.work_path(spark, "x").startswith(session.shared_folder(spark))


def scanned(df):
    """Rows that a frame's result takes, and rows that its scans hand on."""
    count = len(df.collect())
    plan, found = df._jdf.queryExecution().executedPlan(), 0
    while (kind := plan.getClass().getSimpleName()) in ("AdaptiveSparkPlanExec", "ResultQueryStageExec"):
        plan = plan.executedPlan() if kind.startswith("Adaptive") else plan.plan()
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        found += leaves.apply(i).metrics().apply("numOutputRows").value()
    return count, found


def test_rows_past_a_mark_are_found_by_ranges(spark, path):
    """Of a table sorted by date only the files past the mark give rows; a hot day is parted."""
    tables.create_layers(spark, path, ["mark_test"])
    day = F.when(F.col("id") % 3 == 0, 50).otherwise(F.col("id") % 100).cast("int")
    orders = spark.range(0, 40_000, 1, 8).select(
        F.col("id").alias("order_id"), F.date_add(F.lit("2024-01-01"), day).cast("timestamp_ntz").alias("order_date")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        tables.refresh(lambda _: orders, "mark_test", ["orders"], by_mark=True)
        orders.write.parquet(f"{path}/plain")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    table, plain = spark.table("mark_test.orders"), spark.read.parquet(f"{path}/plain")
    held = plain.where("order_date <= '2024-03-21'")
    assert rows(table.drop(combine.MARK_DAY)) == rows(orders)
    files = table.groupBy(F.input_file_name().alias("f")).agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"), F.count("*").alias("n"))
    files = files.collect()
    hot = [f for f in files if f.lo == f.hi == dt.datetime(2024, 2, 20)]
    assert len(files) == 16 and len(hot) >= 4 and max(f.n for f in files) < 5000
    wanted = orders.where("order_date > '2024-03-21'").count()
    past = sum(f.n for f in files if f.hi >= dt.datetime(2024, 3, 21))
    assert scanned(combine.newer_than(table, held, "order_date")) == (wanted, past) and past < 10_000
    assert scanned(combine.newer_than(plain, held, "order_date")) == (wanted, 40_000)
    assert scanned(combine.newer_than(table, held.where("false"), "order_date")) == (40_000, 40_000)
    assert combine.newer_than(table, held, "order_date").columns == orders.columns
    with pytest.raises(ValueError, match="either"):
        tables.write_table(orders, "mark_test", "orders", "order_id", 4, "order_date")
