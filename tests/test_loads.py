"""Writers, table loads, gates, audit rows and incremental runs."""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismark.plans.curate import curate, curate_flagged
from seismark.plans.loads import daily_load, historical_load, json_route_load, load_documents
from seismark.schema import AUDIT_SCHEMA, CURATED_COLUMNS, RAW_DOCUMENT, VARIANT_DOCUMENT
from seismark.session import work_folder
from seismark.sinks.audit import AuditLog
from seismark.sinks.files import (
    append_load,
    write_landing_json,
    write_parquet_overwrite,
    write_parquet_typed,
)
from seismark.sinks.gates import (
    BadRecordBudgetExceeded,
    EmptyInput,
    LossesExceeded,
    MissingRequiredValues,
    required_null_report,
)
from seismark.sinks.staging import lost_records
from seismark.sinks.tables import ensure_namespace, load_ndjson, load_table, preview
from seismark.sources.documents import parse_documents, read_landing_text
from seismark.sources.split import read_landing_split
from seismark.sources.tables import (
    read_parquet,
    read_parquet_glob,
    read_table,
    rows_with_schema,
    single_seed_element,
)
from seismark.streaming import incremental_append, incremental_load

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


@pytest.fixture
def table(spark, tmp_path):
    ensure_namespace(spark, "loads_test", str(tmp_path / "db"))
    name = f"loads_test.t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql("DROP DATABASE loads_test CASCADE")


def frame(spark, *rows):
    return rows_with_schema(spark, rows, SCHEMA)


def content(df):
    return sorted(tuple(r) for r in df.collect())


def landed(folder, *mags, broken=0):
    folder.mkdir(parents=True, exist_ok=True)
    documents = [
        json.dumps(
            {
                "features": [
                    {
                        "properties": {
                            "mag": m, "place": f"1 km of P{m}, Q", "time": 1, "updated": 2,
                        },
                        "geometry": {"coordinates": [1, 2, 3]},
                    }
                ]
            }
        )
        for m in mags
    ] + ['{"features": ['] * broken
    (folder / f"{uuid.uuid4().hex}.json").write_text("\n".join(documents))
    return str(folder)


def test_day_overwrite_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_parquet_overwrite(frame(spark, (1, "a")), path, "20240101")
    write_parquet_overwrite(frame(spark, (2, "b")), path, dt.date(2024, 1, 2))
    write_parquet_overwrite(frame(spark, (3, "c")), path, "20240102")
    assert content(read_parquet(spark, path).select("k")) == [(1,), (3,)]
    assert content(read_parquet_glob(spark, path).select("k")) == [(1,), (3,)]


def test_overwrite_refuses_an_empty_input(spark, tmp_path, table):
    path = str(tmp_path / "out")
    write_parquet_overwrite(frame(spark, (1, "a")), path)
    with pytest.raises(EmptyInput):
        write_parquet_overwrite(frame(spark), path)
    assert read_parquet(spark, path).count() == 1
    load_table(frame(spark, (1, "a")), table, "truncate")
    with pytest.raises(EmptyInput):
        load_table(frame(spark), table, "truncate")
    assert content(read_table(spark, table)) == [(1, "a")]


def test_shards_are_made_only_on_request(spark, tmp_path):
    df = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v")).repartition(4)
    write_parquet_typed(df, str(tmp_path / "many"), SCHEMA)
    write_parquet_typed(df, str(tmp_path / "one"), SCHEMA, shards=1)
    assert len(list((tmp_path / "many").glob("*.parquet"))) == 4
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1


def test_landing_forms(spark, tmp_path):
    texts = ['{"features":\n[]}', '{"a": "x\\ny"}']
    df = spark.createDataFrame([(t,) for t in texts], "document string")
    write_landing_json(df, str(tmp_path / "files"), one_per_file=True)
    files = [p.read_text().strip() for p in (tmp_path / "files").glob("*.txt")]
    assert sorted(filter(None, files)) == sorted(texts)
    write_landing_json(df, str(tmp_path / "lines"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "lines")).collect()]
    assert sorted(json.loads(x)["a"] for x in lines if "a" in json.loads(x)) == ["x\ny"]
    assert len(lines) == 2


def test_append_keeps_repeats_and_counts_rows(spark, table):
    assert load_table(frame(spark, (1, "a"), (2, "b")), table).rows == 2
    assert load_table(frame(spark, (1, "a")).select("v", "k"), table, "append").rows == 1
    assert content(read_table(spark, table)) == [(1, "a"), (1, "a"), (2, "b")]


def test_append_drops_no_column(spark, table):
    load_table(frame(spark, (1, "a")), table)
    with pytest.raises(ValueError, match=r"\['w'\]"):
        load_table(frame(spark, (1, "a")).withColumn("w", F.lit(1)), table)
    assert content(read_table(spark, table)) == [(1, "a")]


def test_truncate_replaces_content_and_schema(spark, table):
    load_table(frame(spark, (1, "a")), table, "truncate")
    load_table(frame(spark, (2, "b")), table, "truncate")
    assert content(read_table(spark, table)) == [(2, "b")]
    load_table(frame(spark, (3, "c")), table)
    assert content(read_table(spark, table)) == [(2, "b"), (3, "c")]
    load_table(frame(spark, (4, "d")).withColumn("w", F.lit(1)), table, "truncate")
    assert content(read_table(spark, table)) == [(4, "d", 1)]


def test_truncate_survives_a_failing_job(spark, table):
    load_table(frame(spark, (1, "a")), table, "truncate")
    failing = frame(spark, (2, "b")).withColumn(
        "v", F.when(F.col("k") < 9, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="lost"):
        load_table(failing, table, "truncate", refuse_empty=False)
    assert content(read_table(spark, table)) == [(1, "a")]


def test_required_columns_stop_a_load(spark, table):
    df = frame(spark, (1, None), (2, "b"))
    assert required_null_report(df, ["k", "v"]).first() == (0, 1)
    with pytest.raises(MissingRequiredValues, match="'v': 1"):
        load_table(df, table, required=["k", "v"])
    assert not spark.catalog.tableExists(table)


def test_unknown_disposition(spark, table):
    with pytest.raises(ValueError, match="disposition"):
        load_table(frame(spark), table, "upsert")


@pytest.mark.parametrize(("bad", "passes"), [(0, True), (1, True), (50, True), (51, False)])
def test_bad_record_budget(spark, tmp_path, table, bad, passes):
    lines = ['{"k": 1, "v": "a"}', '{"k": 2}'] + ['{"k": '] * bad
    (tmp_path / "in.json").write_text("\n".join(lines))
    args = (spark, str(tmp_path / "in.json"), SCHEMA, table)
    if passes:
        assert load_ndjson(*args, quarantine=str(tmp_path / "bad")).rows == 2
        assert content(read_table(spark, table).select("k")) == [(1,), (2,)]
        assert read_parquet(spark, str(tmp_path / "bad")).count() == bad
    else:
        with pytest.raises(BadRecordBudgetExceeded, match="51"):
            load_ndjson(*args)
        assert not spark.catalog.tableExists(table)


def test_history_and_daily_loads(spark, tmp_path, table):
    history, daily = landed(tmp_path / "h", 1.0, 2.0, broken=1), landed(tmp_path / "d", 3.0)
    silver = str(tmp_path / "silver")
    log = AuditLog(spark, str(tmp_path / "audit"), "feed", "run_1")
    first = historical_load(
        spark, history, silver, table, "20240101", reader=read_landing_text, max_lost=1, audit=log
    )
    second = daily_load(spark, daily, silver, table, dt.date(2024, 1, 2), reader=read_landing_text)
    assert (first.rows, first.broken, second.rows, second.broken) == (2, 1, 1, 0)
    rows = read_table(spark, table).orderBy("mag").collect()
    assert [(r.mag, r.area, r.load_id) for r in rows] == [
        (1.0, "P1.0, Q", "20240101"), (2.0, "P2.0, Q", "20240101"), (3.0, "P3.0, Q", "20240102"),
    ]
    assert content(lost_records(spark, first.folder)) == [("broken", '{"features": [')]
    notes = {r.additional_info for r in log.read().filter("status = 'SUCCESS'").collect()}
    assert "20240101: 2 rows, 0 failed, 1 broken documents" in notes
    assert content(log.read().select("step_name", "status")) == [
        ("curate_to_parquet", "STARTED"), ("curate_to_parquet", "SUCCESS"),
        ("load_table", "STARTED"), ("load_table", "SUCCESS"),
    ]
    daily_load(spark, daily, silver, table, "20240102", reader=read_landing_text)
    assert read_table(spark, table).count() == 3
    historical_load(spark, daily, silver, table, "20240103", reader=read_landing_text)
    assert content(read_table(spark, table).select("mag", "load_id")) == [(3.0, "20240103")]


def test_losses_stop_a_load_unless_allowed(spark, tmp_path, table):
    landing = landed(tmp_path / "h", 1.0, broken=1)
    odd = {"features": [{"properties": {"sig": 1e12, "ids": "big"}}]}
    (tmp_path / "h" / "odd.json").write_text(json.dumps(odd))
    silver = str(tmp_path / "s")
    with pytest.raises(LossesExceeded, match="1 documents did not parse and 1 features did not"):
        historical_load(spark, landing, silver, table, "20240101", reader=read_landing_text, max_lost=1)
    assert not spark.catalog.tableExists(table)
    found = historical_load(spark, landing, silver, table, "20240101", reader=read_landing_text, max_lost=2)
    assert found[1:5] == (1, 1, 1, 0) and read_table(spark, table).count() == 1
    lost = {r.outcome: r.record for r in lost_records(spark, found.folder).collect()}
    assert lost["broken"] == '{"features": [' and json.loads(lost["failed"])["properties"]["ids"] == "big"
    with pytest.raises(LossesExceeded):
        json_route_load(spark, landing, str(tmp_path / "n"), table, reader=read_landing_text)


def test_nulls_in_required_columns_leave_the_table(spark, tmp_path, table):
    silver = str(tmp_path / "s")
    historical_load(spark, landed(tmp_path / "h", 1.0), silver, table, "20240101", reader=read_landing_text)
    documents = parse_documents(
        spark.createDataFrame([('{"features": [{"properties": {"place": "x", "mag": null, "time": 1, "updated": 2}, "geometry": {"coordinates": [1, 2, 3]}}]}',)], "t string"),
        "t", VARIANT_DOCUMENT,
    )
    with pytest.raises(MissingRequiredValues, match="'mag': 1"):
        load_documents(documents, silver, table, "20240102", required=["mag", "place"])
    assert content(read_table(spark, table).select("load_id")) == [("20240101",)]


def test_a_load_reads_its_landing_once(spark, tmp_path, table):
    """Each document is parsed once: an accumulator in the reader counts them."""
    seen = spark.sparkContext.accumulator(0)
    landing = landed(tmp_path / "h", 1.0, 2.0, 3.0, broken=2)

    def counted(spark, path):
        texts = spark.read.text(path)

        def look(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return parse_documents(texts.mapInArrow(look, "value string"), "value")

    found = historical_load(spark, landing, str(tmp_path / "s"), table, "20240101", reader=counted, max_lost=2)
    assert (found.rows, found.broken, seen.value) == (3, 2, 5)


def test_flagged_curation_is_one_pass(spark, tmp_path, capsys):
    landed(tmp_path / "h", 1.0)
    for schema in (RAW_DOCUMENT, VARIANT_DOCUMENT):
        flagged = curate_flagged(read_landing_text(spark, str(tmp_path / "h"), schema))
        flagged.explain("codegen")
        text = capsys.readouterr().out
        assert "Exchange" not in text
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) < 8000


def test_empty_appends_are_counted_as_zero(spark, table):
    for _ in range(2):
        assert load_table(frame(spark), table, "append").rows == 0
    assert load_table(spark.range(3).filter("1 = 0"), table, "truncate", refuse_empty=False).rows == 0


def test_history_with_no_document_leaves_the_table(spark, tmp_path, table):
    silver = str(tmp_path / "silver")
    historical_load(
        spark, landed(tmp_path / "h", 1.0), silver, table, "20240101", reader=read_landing_text
    )
    log = AuditLog(spark, str(tmp_path / "audit"), "feed")
    with pytest.raises(EmptyInput):
        historical_load(
            spark, landed(tmp_path / "e", broken=1), silver, table, "20240102",
            reader=read_landing_text, audit=log, max_lost=1,
        )
    assert read_table(spark, table).count() == 1
    failure = log.read().filter("status = 'FAILURE'").first()
    assert failure.step_name == "curate_to_parquet" and "empty" in failure.error_message
    assert failure.end_time >= failure.start_time


def test_json_route(spark, tmp_path, table):
    at = dt.datetime(2024, 11, 2, 1, 2, 3, 456789)
    loaded = json_route_load(
        spark, landed(tmp_path / "h", 1.0, 2.0), str(tmp_path / "nd"), table,
        reader=read_landing_text, ingested_at=at,
    )
    row = read_table(spark, table).orderBy("mag").first()
    assert loaded.rows == 2
    assert (row.time, row.ingestion_dt) == (dt.datetime(1970, 1, 1, 0, 0, 0, 1000), at)


def test_audit_rows(spark, tmp_path):
    times = iter(dt.datetime(2024, 1, 1, 0, 0, s, tzinfo=dt.timezone.utc) for s in range(60))
    log = AuditLog(spark, str(tmp_path / "audit"), "feed", clock=lambda: next(times))
    assert log.run_id.startswith("run_20240101000000_")
    with log.step("write", info="start") as step:
        step.info = "12 rows"
    with pytest.raises(RuntimeError), log.step("load"):
        raise RuntimeError("no table")
    other = AuditLog(spark, str(tmp_path / "audit"), "feed", "run_x")
    other.record("write", "STARTED", dt.datetime(2024, 1, 1))
    rows = log.read()
    assert rows.schema == AUDIT_SCHEMA
    mine = rows.filter(F.col("pipeline_run_id") == log.run_id).orderBy("execution_timestamp")
    assert [(r.step_name, r.status, r.error_message, r.additional_info) for r in mine.collect()] == [
        ("write", "STARTED", "", "start"), ("write", "SUCCESS", "", "12 rows"),
        ("load", "STARTED", "", ""), ("load", "FAILURE", "no table", ""),
    ]
    done = mine.filter("status = 'SUCCESS'").first()
    assert done.end_time > done.start_time
    assert rows.count() == 5


def test_incremental_run_takes_each_file_once(spark, tmp_path):
    landing, target, seen = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))
    append_load(
        curate(read_landing_text(spark, landed(tmp_path / "history", 9.0))), target, "history"
    )

    def run():
        incremental_append(
            spark, landing, target, seen, reader=read_landing_text, max_files_per_batch=1
        )
        return content(read_parquet(spark, target).select("mag"))

    landed(tmp_path / "landing", 1.0, 2.0)
    landed(tmp_path / "landing", 3.0)
    assert run() == [(1.0,), (2.0,), (3.0,), (9.0,)]
    assert run() == [(1.0,), (2.0,), (3.0,), (9.0,)]
    landed(tmp_path / "landing", 4.0)
    assert run() == [(1.0,), (2.0,), (3.0,), (4.0,), (9.0,)]
    loads = read_parquet(spark, target).select("load_id").distinct().count()
    assert loads == 4


def test_a_batch_repeated_after_a_crash_adds_no_rows(spark, tmp_path, monkeypatch):
    """The first attempt dies after its rows are written and before the batch is committed."""
    from seismark.streaming import incremental

    landing, target, seen = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))
    landed(tmp_path / "landing", 1.0, 2.0)

    def write_then_die(*args):
        append_load(*args)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "append_load", write_then_die)
        with pytest.raises(Exception, match="driver lost"):
            incremental_append(spark, landing, target, seen, reader=read_landing_text)
    assert content(read_parquet(spark, target).select("mag")) == [(1.0,), (2.0,)]
    landed(tmp_path / "landing", 3.0)
    incremental_append(spark, landing, target, seen, reader=read_landing_text)
    assert content(read_parquet(spark, target).select("mag")) == [(1.0,), (2.0,), (3.0,)]


def test_incremental_run_stops_at_losses(spark, tmp_path):
    landing, target, seen = (str(tmp_path / n) for n in ("landing", "target", "seen"))
    landed(tmp_path / "landing", 1.0, broken=2)
    with pytest.raises(Exception, match="2 documents did not parse"):
        incremental_append(spark, landing, target, seen, reader=read_landing_text, max_lost=1)
    assert not list((tmp_path / "target").glob("load_id=*"))
    incremental_append(spark, landing, target, seen, reader=read_landing_text, max_lost=2)
    landed(tmp_path / "landing", 2.0)
    incremental_append(spark, landing, target, seen, reader=read_landing_text)
    assert content(read_parquet(spark, target).select("mag")) == [(1.0,), (2.0,)]


def test_a_batch_repeated_between_publishing_and_checkpoint(spark, tmp_path, table, monkeypatch):
    """The first attempt dies after the table got its rows and before the batch is committed."""
    from seismark.streaming import incremental

    landing, silver, seen = (str(tmp_path / n) for n in ("landing", "silver", "checkpoint"))
    historical_load(spark, landed(tmp_path / "h", 9.0), silver, table, "20240101", reader=read_landing_text)
    landed(tmp_path / "landing", 1.0, 2.0)

    def load_then_die(*args, **options):
        load_documents(*args, **options)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "load_documents", load_then_die)
        with pytest.raises(Exception, match="driver lost"):
            incremental_load(spark, landing, silver, table, seen, reader=read_landing_text)
    assert content(read_table(spark, table).select("mag")) == [(1.0,), (2.0,), (9.0,)]
    landed(tmp_path / "landing", 3.0)
    for _ in range(2):
        incremental_load(spark, landing, silver, table, seen, reader=read_landing_text)
    assert content(read_table(spark, table).select("mag")) == [(1.0,), (2.0,), (3.0,), (9.0,)]


def test_a_file_landed_in_two_halves_gives_its_rows_once(spark, tmp_path, table):
    landing, silver, seen = tmp_path / "landing", str(tmp_path / "silver"), str(tmp_path / "checkpoint")
    landed(landing, 1.0)
    parts = [json.loads(next(landing.glob("*.json")).read_text())["features"][0] for _ in range(3)]
    text = json.dumps({"features": parts})
    half = landing / "late.json"
    half.write_text(text[: len(text) // 2])

    def run():
        incremental_load(spark, str(landing), silver, table, seen, reader=read_landing_split)
        return read_table(spark, table).count()

    assert run() == 1
    assert run() == 1
    half.write_text(text)
    assert run() == 4
    assert run() == 4


def test_incremental_run_with_whole_file_documents(spark, tmp_path):
    landing, target, seen = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))
    landed(tmp_path / "landing", 1.0)
    incremental_append(spark, landing, target, seen)
    assert content(read_parquet(spark, target).select("mag", "area")) == [(1.0, "P1.0, Q")]


def test_a_repeated_load_replaces_its_own_rows(spark, tmp_path):
    target = str(tmp_path / "target")
    append_load(frame(spark, (1, "a")), target, "stream-00000000")
    append_load(frame(spark, (2, "b")), target, "stream-00000001")
    append_load(frame(spark, (2, "b")), target, "stream-00000001")
    assert content(read_parquet(spark, target).select("k")) == [(1,), (2,)]


def test_connector_read_and_seed(spark, tmp_path):
    path = str(tmp_path / "csv")
    frame(spark, (1, "a")).write.option("header", True).csv(path)
    assert read_table(spark, path, "csv", header="true").first() == ("1", "a")
    assert single_seed_element(spark).count() == 1


def test_preview_prints(spark, capsys):
    preview(frame(spark, (1, "a")))
    printed = capsys.readouterr().out
    assert "|1  |a  |" in printed and "|-- k: long" in printed


def test_work_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    a, b = work_folder(spark, "x"), work_folder(spark, "x")
    assert a != b and (shared is None or a.startswith(shared))


@pytest.mark.parametrize("route", ["curated", "json"])
def test_loads_choose_area_and_time_reading(spark, tmp_path, table, route):
    landed(tmp_path / "in", 1.5)
    options = {"area": "regex", "time_format": "string"}
    if route == "curated":
        historical_load(spark, str(tmp_path / "in"), str(tmp_path / "s"), table, "20240101", **options)
    else:
        json_route_load(spark, str(tmp_path / "in"), str(tmp_path / "n"), table, **options)
    loaded = spark.table(table)
    assert loaded.drop("load_id").columns == CURATED_COLUMNS
    assert dict(loaded.dtypes)["time"] == dict(loaded.dtypes)["updated"] == "string"
    assert loaded.select(F.length("time"), F.trim("area")).first() == (19, "P1.5, Q")


def test_location_with_a_quote(spark, tmp_path):
    ensure_namespace(spark, "quoted_test", str(tmp_path / "o'clock"))
    try:
        load_table(frame(spark, (1, "a")), "quoted_test.t", "truncate")
        load_table(frame(spark, (2, "b")), "quoted_test.t", "truncate")
        assert content(spark.table("quoted_test.t")) == [(2, "b")]
    finally:
        spark.sql("DROP DATABASE quoted_test CASCADE")


def test_audit_logs_of_one_second_are_apart(spark, tmp_path):
    clock = lambda: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    first, second = (AuditLog(spark, str(tmp_path), "feed", clock=clock) for _ in range(2))
    assert first.run_id != second.run_id
