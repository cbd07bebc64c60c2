"""Landed documents and the edge cases of their fields."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seismark.functions import (
    area_regex,
    area_split,
    epoch_ms_pair,
    epoch_ms_to_string,
    epoch_ms_to_timestamp,
    state_suffix,
)
from seismark.operators.project import extract_properties, flatten_coerce_default
from seismark.plans.curate import curate, flatten
from seismark.schema import (
    CORRUPT,
    CURATED_SCHEMA,
    FLAT_SCHEMA,
    RAW_DOCUMENT,
    VARIANT_DOCUMENT,
    VARIANT_FEATURE,
)
from seismark.sources.documents import (
    explode_features,
    read_landing_geojson,
    read_landing_text,
    split_documents,
)
from seismark.sources.split import Shape, Summary, quotes_of, read_landing_split, shape_of

NOW = dt.datetime(2024, 11, 2)


def feature(geometry="full", **properties):
    properties.setdefault("time", 1730505600999)
    properties.setdefault("updated", 1730505601000)
    if geometry == "full":
        geometry = {"type": "Point", "coordinates": [1.5, 2.5, 10]}
    out = {"type": "Feature", "properties": properties}
    if geometry != "absent":
        out["geometry"] = geometry
    return out


def land(folder, *documents, indent=None):
    folder.mkdir(parents=True, exist_ok=True)
    for i, document in enumerate(documents):
        text = document if isinstance(document, str) else json.dumps(document, indent=indent)
        (folder / f"{i}.json").write_text(text)
    return str(folder)


def doc(*features):
    return {"type": "FeatureCollection", "features": list(features), "bbox": [0, 1]}


@pytest.mark.parametrize(
    ("place", "split", "regex", "state"),
    [
        ("10 km SSE of Town, CA", "Town, CA", "Town, CA", " CA"),
        ("Fiji region", "Fiji region", "Fiji region", "Fiji region"),
        ("south offshore of X, Y ", "X, Y", "fshore of X, Y ", " Y"),
        ("a of b of c, d, e", "b of c, d, e", "b of c, d, e", " d, e"),
        ("5 km of ", "", "", ""),
        ("3 km of \t X, Y  ", "X, Y", "X, Y  ", " Y"),
        ("", "", "", ""),
        (None, None, None, None),
    ],
)
def test_region_and_state(spark, place, split, regex, state):
    df = spark.createDataFrame([(place,)], "place string").select(
        area_split(F.col("place")).alias("split"), area_regex(F.col("place")).alias("regex")
    )
    assert df.withColumn("state", state_suffix(F.col("split"))).first() == (split, regex, state)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_to_timestamp_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["1730505600999", "-1500", "x", str(10**18)]
        df = spark.createDataFrame([(t,) for t in texts], "ms string")
        rows = df.select(epoch_ms_to_timestamp(F.col("ms")).alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.t for r in rows] == [
        dt.datetime(2024, 11, 2, 0, 0, 0, 999000),
        dt.datetime(1969, 12, 31, 23, 59, 58, 500000),
        None,
        None,
    ]


def test_epoch_to_string_cuts_milliseconds_toward_zero(spark):
    df = spark.createDataFrame([("1730505600999",), ("-1500",)], "ms string")
    rows = df.select(epoch_ms_to_string(F.col("ms")).alias("t")).collect()
    assert [r.t for r in rows] == ["2024-11-02 00:00:00", "1969-12-31 23:59:59"]


def test_epoch_pair_converts_both_or_neither(spark):
    df = spark.createDataFrame([(1000, 2000), (1000, 0), (None, 5), (1000, None)], "a long, b long")
    a, b = epoch_ms_pair(F.col("a"), F.col("b"))
    rows = df.select(a.alias("a"), b.alias("b")).collect()
    assert rows[0] == (dt.datetime(1970, 1, 1, 0, 0, 1), dt.datetime(1970, 1, 1, 0, 0, 2))
    assert all(r == (None, None) for r in rows[1:])


def test_default_policy(spark, tmp_path):
    path = land(
        tmp_path / "in",
        doc(
            feature(mag=None, place="9 km N of A, B", felt=3.7, tz=60),
            feature(geometry=None, mag=1.25, place=None),
            feature(geometry={"coordinates": [1.5]}, time=None),
        ),
    )
    out = curate(read_landing_geojson(spark, path), ingested_at=NOW)
    assert out.schema.names == CURATED_SCHEMA.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in CURATED_SCHEMA]
    by_place = {(r.place, r.mag): r for r in out.collect()}
    first = by_place[("9 km N of A, B", 0.0)]
    assert (first.felt, first.tz, first.area, first.depth) == (3, "60", "A, B", 10.0)
    assert first.time == dt.datetime(2024, 11, 2, 0, 0, 0, 999000)
    second = by_place[("", 1.25)]
    assert (second.longitude, second.depth, second.area, second.net) == (0.0, 0.0, "", "")
    third = by_place[("", 0.0)]
    assert (third.longitude, third.latitude) == (1.5, 0.0)
    assert third.time == dt.datetime(1970, 1, 1)


def test_string_times_and_regex_area(spark, tmp_path):
    path = land(tmp_path / "in", doc(feature(place="south offshore of X, Y ")))
    row = curate(read_landing_geojson(spark, path), area="regex", time_format="string").first()
    assert (row.area, row.time) == ("fshore of X, Y ", "2024-11-02 00:00:00")


def test_epoch_text_form_of_the_flat_rows(spark, tmp_path):
    path = land(tmp_path / "in", doc(feature(), feature(time=None)))
    features = explode_features(read_landing_geojson(spark, path))
    flat = flatten_coerce_default(extract_properties(features), epoch_as_text=True)
    assert flat.schema["time"].dataType.simpleString() == "string"
    assert sorted(r.time for r in flat.collect()) == ["0", "1730505600999"]
    typed = flatten_coerce_default(extract_properties(features))
    assert [f.dataType for f in typed.schema] == [f.dataType for f in FLAT_SCHEMA]


def test_strict_extraction_fails_on_missing_geometry(spark, tmp_path):
    path = land(tmp_path / "in", doc(feature(geometry=None)))
    features = explode_features(read_landing_geojson(spark, path))
    with pytest.raises(PySparkException, match="feature without longitude"):
        extract_properties(features, missing="fail").collect()


def test_values_that_do_not_fit_are_failed_rows(spark, tmp_path):
    far = 9_000_000_000_000_000_000
    path = land(
        tmp_path / "in",
        doc(feature(sig=1e12, ids="big"), feature(sig=7, ids="ok"), feature(time=far, ids="far")),
    )
    for schema in (RAW_DOCUMENT, VARIANT_DOCUMENT):
        documents = read_landing_geojson(spark, path, schema)
        good, failed = flatten(documents)
        assert [(r.ids, r.sig) for r in good.collect()] == [("ok", 7)]
        assert sorted(r.ids for r in failed.collect()) == ["big", "far"]
        assert curate(documents).count() == 1


def test_preserve_policy(spark, tmp_path):
    no_time = feature(ids="no time")
    del no_time["properties"]["time"]
    path = land(
        tmp_path / "in",
        doc(
            feature(ids="null mag", mag=None),
            feature(ids="no mag"),
            feature(ids="null time", time=None),
            feature(ids="no geometry", geometry="absent"),
            feature(ids="no coordinates", geometry={}),
            feature(ids="null depth", geometry={"coordinates": [1, 2, None]}),
            feature(ids="null geometry", geometry=None),
            feature(ids="null coordinates", geometry={"coordinates": None}),
            feature(ids="short", geometry={"coordinates": [1.5]}),
            feature(ids="text mag", mag="strong"),
            no_time,
            {"type": "Feature", "properties": None},
            {"type": "Feature"},
            None,
        ),
    )
    documents = read_landing_geojson(spark, path, VARIANT_DOCUMENT)
    assert explode_features(documents).schema["feature"].dataType == VARIANT_FEATURE
    good, failed = flatten(documents)
    kept = {r.ids: r for r in good.collect()}
    assert set(kept) == {
        "null mag", "no mag", "null time", "no geometry", "no coordinates", "null depth",
    }
    assert kept["null mag"].mag is None and kept["no mag"].mag == 0.0
    assert kept["null time"].time is None
    assert kept["no geometry"].depth == 0.0 and kept["no coordinates"].depth == 0.0
    assert kept["null depth"].depth is None and kept["null depth"].latitude == 2.0
    assert failed.count() == 7


def test_documents_without_rows_and_broken_ones(spark, tmp_path):
    path = land(
        tmp_path / "in", {}, {"features": []}, {"features": None}, '{"features": [', doc(feature())
    )
    documents = read_landing_geojson(spark, path)
    readable, broken = split_documents(documents)
    assert explode_features(readable).count() == 1
    assert explode_features(documents).count() == 1
    assert [tuple(r) for r in broken.collect()] == [('{"features": [', False)]


def test_a_value_of_another_type_converts_or_fails_its_row(spark, tmp_path):
    """Numbers and times as text, counts as flags or with decimals; nothing turns into a default."""
    features = [
        feature(mag="4.5", time="1730505600999", felt="7", ids="a"),
        feature(mag=2, time=1730505600999.0, tsunami=True, felt=3.7, ids="b"),
        feature(mag="strong", ids="c"), feature(time="noon", ids="d"), feature(sig={"x": 1}, ids="e"),
        feature(mag="4.5d", ids="f"), feature(cdi="0x1p3", ids="g"), feature(mag="NaN", ids="h"),
    ]
    path = land(tmp_path / "in", doc(*features))
    for read in (read_landing_geojson, read_landing_text, read_landing_split):
        documents = read(spark, path)
        kept, failed = flatten(documents)
        rows = {r.ids: r for r in kept.collect()}
        assert sorted(rows) == ["a", "b"] and sorted(r.ids for r in failed.collect()) == list("cdefgh")
        assert (rows["a"].mag, rows["a"].time, rows["a"].felt) == (4.5, 1730505600999, 7)
        assert (rows["b"].mag, rows["b"].time, rows["b"].tsunami, rows["b"].felt) == (2.0, 1730505600999, 1, 3)
        assert split_documents(documents)[1].count() == 0


def test_text_lines_skip_blank_lines(spark, tmp_path):
    lines = "\n".join([json.dumps(doc(feature(mag=1.0), feature())), "", "  ", '{"features": ['])
    path = land(tmp_path / "in", lines)
    documents = read_landing_text(spark, path)
    assert documents.count() == 2
    assert explode_features(documents).count() == 2
    assert split_documents(documents)[1].count() == 1


def _place(i):
    return f'{i} km {{"type": "Feature", [of] A, é"\\\\"'


@pytest.fixture
def small_ranges(spark):
    """Files fall into ranges of so many bytes."""
    names = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.maxPartitionBytes": None}
    before = {name: spark.conf.get(name) for name in names}

    def set_bytes(n):
        for name, value in names.items():
            spark.conf.set(name, value or str(n))

    yield set_bytes
    for name, value in before.items():
        spark.conf.set(name, value)


def test_split_reader_equals_whole_documents(spark, tmp_path, small_ranges):
    """Many small ranges, brackets and quotes inside values, other layouts and empty documents."""
    many = doc(*[feature(ids=str(i), mag=i / 4, place=_place(i)) for i in range(60)])
    swapped = {"bbox": [1, 2], "a": [{"features": [{}]}], **doc(feature(ids="a"), {"id": "x", **feature(ids="b")}), "z": [[]]}
    path = land(tmp_path / "in", many, swapped, {}, {"features": []}, {"features": None}, doc(), {"features": [None]}, "  ")
    land(tmp_path / "in" / "pretty", doc(feature(ids="p"), feature(ids="q"), doc(feature())), indent=2)
    land(tmp_path / "in" / "minified", json.dumps(doc(feature(ids="m"), feature(ids="n")), separators=(",", ":")))
    small_ranges(600)
    pieces = read_landing_split(spark, path)
    got = curate(pieces, ingested_at=NOW)
    want = curate(read_landing_geojson(spark, path), ingested_at=NOW)
    assert got.count() == 67
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert pieces.filter(F.col(CORRUPT).isNotNull()).isEmpty()
    got = curate(read_landing_split(spark, path, feature=VARIANT_FEATURE), ingested_at=NOW)
    want = curate(read_landing_geojson(spark, path, VARIANT_DOCUMENT), ingested_at=NOW)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("size", [90, 1 << 20])
def test_split_reader_judges_a_document_cut_at_every_byte(spark, tmp_path, small_ranges, size):
    one = {"properties": {"ids": 'a"{\\', "place": "é"}, "geometry": None}
    text = json.dumps({"m": {"n": [1]}, "features": [one, one], "e": []}, ensure_ascii=False, separators=(", ", ":")).encode() + b" \n"
    (tmp_path / "in").mkdir()
    for cut in range(len(text) + 1):
        (tmp_path / "in" / f"{cut:03}.json").write_bytes(text[:cut])
    small_ranges(size)
    rows = read_landing_split(spark, str(tmp_path / "in")).collect()
    ids, broken = {}, []
    for r in rows:
        name = r.source_file[-8:-5]
        if r[CORRUPT] is not None:
            broken.append(name)
        ids[name] = ids.get(name, 0) + len(r.features or [])
    whole = len(text) - 2  # the closing brace
    assert sorted(broken) == [f"{cut:03}" for cut in range(1, whole)]
    assert {name: n for name, n in ids.items() if n} == {f"{cut:03}": 2 for cut in range(whole, len(text) + 1)}
    judged = read_landing_geojson(spark, str(tmp_path / "in"))
    assert split_documents(judged)[1].count() == len(broken)
    assert explode_features(judged).count() == sum(ids.values())


def test_split_reader_reports_pieces_that_do_not_parse(spark, tmp_path):
    good = json.dumps(feature(ids="g"))
    path = land(
        tmp_path / "in", '{"features": [%s,]}' % good, '{"features": [,%s]}' % good, '{"features": [%s, {"x" 1}]}' % good,
        '{"features": [3]}', '{"features": [}', "[1]", '{"features": "none"}', '{"features": [%s]' % good,
    )
    documents = read_landing_split(spark, path)
    broken = {r.source_file.rsplit("/", 1)[1] for r in documents.filter(F.col(CORRUPT).isNotNull()).collect()}
    assert broken == {f"{i}.json" for i in range(8)}
    assert curate(documents).count() <= 3


def test_summaries_combine_like_the_whole_text():
    """Any cut of any text: the parts' summaries give that of the whole, for both start states."""
    import random

    import numpy as np

    rnd = random.Random(5)

    def summary(text):
        data = np.frombuffer(text, np.uint8)
        quotes = quotes_of(data)
        return Summary(bool(len(quotes) % 2), (shape_of(data, quotes, 0), shape_of(data, quotes, 1)))

    for _ in range(300):
        text = bytes(rnd.choices(b'{}[]{[,"a', k=rnd.randint(0, 14)))
        cuts = sorted(rnd.choices(range(len(text) + 1), k=2))
        parts = [text[: cuts[0]], text[cuts[0] : cuts[1]], text[cuts[1] :]]
        found = Summary()
        for part in parts:
            found = found.then(summary(part))
        assert found == summary(text)
    assert summary(b'"\\\\\\"" {') == Summary(False, (Shape(0, 1, b"{"), Shape()))


def test_whole_file_reader_takes_no_longer_than_the_line_reader(spark, tmp_path):
    """Parsed from memory: numbers are not fetched from the file again."""
    import time

    many = doc(*[feature(ids=str(i), **{n: i / 7 for n in ("mag", "cdi", "mmi", "dmin", "rms", "gap")}) for i in range(4000)])
    path = land(tmp_path / "in", *[many] * 4)
    seconds = []
    for read in (read_landing_text, read_landing_geojson):
        frame = curate(read(spark, path))
        frame.write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        frame.write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 4 * seconds[0] + 0.5
