"""Streams against the batch operators, chunk by chunk."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from anemora.config import RmseRecord
from anemora.operators import cadence, lookup, resample, runs
from anemora.plans.label_queries import BANDS
from anemora.plans.tables import obs
from anemora.sources import readers, sinks
from anemora.streaming import chunks, counters, rollup, runs as streams
from conftest import SF, rows

PARTS = 6


@pytest.fixture(scope="module")
def observations(spark):
    return obs(spark, SF).select("node_id", "timestamp", "event_id", "pred_wind_speed").cache()


@pytest.fixture(scope="module")
def ordered(spark, observations, tmp_path_factory):
    """The observations as files in order of time, each file's rows shuffled."""
    return _files(observations, str(tmp_path_factory.mktemp("ordered")), F.ntile(PARTS).over(_by_time()))


def _by_time():
    from pyspark.sql import Window

    return Window.orderBy("timestamp")


def _files(df, folder, part):
    """One file per part; a stream takes the oldest file first."""
    import os

    numbered = df.withColumn("__part", part).cache()
    for i, (p,) in enumerate(sorted(numbered.select("__part").distinct().collect())):
        target = f"{folder}/in/p{i}"
        numbered.where(F.col("__part") == p).drop("__part").orderBy(F.xxhash64("event_id")).coalesce(1).write.parquet(target)
        for name in os.listdir(target):
            os.utime(f"{target}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    return folder


def _stream(spark, df, folder):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{folder}/in")


def _same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _run(stream, folder, name, mode="append"):
    query = stream.writeStream.format("parquet").option("path", f"{folder}/{name}").option("checkpointLocation", f"{folder}/{name}-state")
    query = query.outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


@pytest.mark.parametrize("gap", [600, 7200])
def test_runs_of_a_stream_are_those_of_the_table(spark, observations, ordered, gap):
    want = runs.observation_runs(observations, gap)
    stream = streams.run_stream(_stream(spark, observations, ordered), gap, "2 hours")
    query = _run(stream, ordered, f"runs{gap}")
    closed = spark.read.schema(stream.schema).parquet(f"{ordered}/runs{gap}")
    held = streams.open_runs(spark, f"{ordered}/runs{gap}-state", gap)
    assert streams.late_rows(query) == 0 and 0 < held.count() < closed.count()
    _same(closed.unionByName(held), want)


def test_runs_by_hand(spark):
    t = datetime(2024, 1, 1)
    data = [("a", t), ("a", t), ("a", t + timedelta(seconds=59)), ("a", t + timedelta(seconds=119)), ("a", None), (None, t)]
    frame = spark.createDataFrame(data, "node_id string, timestamp timestamp_ntz")
    got = rows(runs.observation_runs(frame, 60), "node_id", "run_start")
    assert [(r["node_id"], r["observations"], (r["run_end"] - r["run_start"]).seconds) for r in got] == [("a", 3, 59), ("a", 1, 0), (None, 1, 0)]
    assert runs.observation_runs(frame.limit(0), 60).count() == 0
    many = spark.createDataFrame([("h", t + timedelta(seconds=7 * i + 30 * (i // 50))) for i in range(600)], "node_id string, timestamp timestamp_ntz")
    _same(runs.observation_runs(many, 30, max_rows=40), runs.observation_runs(many, 30, max_rows=None))


def test_first_arrivals(spark, observations, ordered):
    """Every slot once; copies are dropped whatever chunk they come in, and late rows are counted."""
    stream = streams.first_arrivals(_stream(spark, observations, ordered), lateness="2 days")
    query = _run(stream, ordered, "slots")
    got = spark.read.parquet(f"{ordered}/slots").select("node_id", "timestamp")
    _same(got, cadence.normalise(observations.select("node_id", "timestamp", "event_id"), sequence="event_id").select("node_id", "timestamp"))
    assert streams.late_rows(query) == 0


def test_late_rows_are_counted(spark, observations, tmp_path):
    """The oldest part arrives last: its rows are dropped, and known to be."""
    folder = _files(observations, str(tmp_path), F.pmod(F.ntile(PARTS).over(_by_time()) - 2, F.lit(PARTS)))
    query = _run(streams.first_arrivals(_stream(spark, observations, folder), lateness="1 hour"), folder, "slots")
    got = spark.read.parquet(f"{folder}/slots").count()
    late = streams.late_rows(query)
    whole = observations.count()
    assert late > whole / PARTS * 0.9 and got + late <= whole


def test_slots_of_shuffled_chunks_merge(spark, observations, tmp_path):
    """Chunks in any order, one of them run twice, give the table's slots, first record and copies."""
    folder = _files(observations, str(tmp_path), F.pmod(F.xxhash64("event_id"), F.lit(PARTS)))
    partials = rollup.first_in_slot(["event_id", "pred_wind_speed"], "event_id")
    handle = partials.sink(f"{folder}/partials", rollup.with_slot)

    def twice(batch, number):
        handle(batch, number)
        if number == 2:
            handle(batch, number)

    chunks.process_chunks(_stream(spark, observations, folder), twice, f"{folder}/state").awaitTermination()
    merged = partials.read(spark, f"{folder}/partials")
    want = cadence.normalise(observations, sequence="event_id").select("node_id", "us", "copies", "event_id", "pred_wind_speed")
    _same(merged.select("node_id", "us", "copies", "kept.event_id", "kept.pred_wind_speed"), want)
    partials.compact(spark, f"{folder}/partials", f"{folder}/compact")
    _same(partials.read(spark, f"{folder}/compact"), merged)


def test_value_counts_merge_to_moments(spark, observations):
    weights = {"w": F.when(F.col("event_id") % 2 == 0, 1.0).otherwise(0.5)}
    partials = rollup.value_counts(["node_id"], "pred_wind_speed", weights)
    parts = [partials.of(observations.where(F.col("event_id") % 3 == i)) for i in range(3)]
    _same(partials.merged(parts[0].unionByName(parts[1]).unionByName(parts[2])), partials.of(observations))
    got = rows(rollup.moments(partials.of(observations), ["node_id"], "pred_wind_speed"), "node_id")
    want = rows(observations.groupBy("node_id").agg(F.count("pred_wind_speed").alias("n"), F.avg("pred_wind_speed").alias("m"), F.stddev_pop("pred_wind_speed").alias("s")), "node_id")
    assert [r["observations"] for r in got] == [r["n"] for r in want]
    assert [r["mean"] for r in got] == pytest.approx([r["m"] for r in want]) and [r["std"] for r in got] == pytest.approx([r["s"] for r in want])
    with pytest.raises(ValueError):
        rollup.with_period(observations, "week")


@pytest.fixture()
def keyed(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, counters.STATE_STORE)
    yield
    spark.conf.set(name, before)


def _counters(spark, stream, folder, handle=None):
    def keep(batch, number):
        if handle:
            handle(number)
        batch.withColumn("n", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/counters/chunk={number}")

    writer = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/counters-state").outputMode("update")
    writer.trigger(availableNow=True).start().awaitTermination()


def _latest(spark, folder):
    found = spark.read.parquet(f"{folder}/counters").drop("chunk")
    return found.groupBy("node_id").agg(F.max_by(F.struct(*[c for c in found.columns if c not in ("node_id", "n")]), "n").alias("r")).select("node_id", "r.*")


def test_taxonomy_counters_survive_a_failed_batch(spark, observations, ordered, keyed):
    """Counters after the last chunk are the table's, though a batch failed on the way and ran again."""
    failed = []

    def fail_once(number):
        if number == 2 and not failed:
            failed.append(number)
            raise RuntimeError("lost")

    stream = counters.taxonomy_stream(_stream(spark, observations, ordered), "2 hours")
    with pytest.raises(StreamingQueryException):
        _counters(spark, stream, ordered, fail_once)
    _counters(spark, stream, ordered, fail_once)
    got = _latest(spark, ordered)
    assert failed and got.agg(F.sum("late_rows")).first()[0] == 0
    _same(counters.with_bands(got, BANDS), cadence.taxonomy(observations, bands=BANDS))


def test_counters_by_hand():
    start = counters._count((0, 0, 0, 0, 0, None, 0), [0, 1_800_000_000])
    assert start == (2, 2, 0, 0, 1800, 1_800_000_000, 0)
    assert counters._count(start, [1_800_000_000 + 1_801_000_000, 20_000_000_000]) == (4, 2, 1, 1, 16399, 20_000_000_000, 0)


# --- counter-based draws ---


def test_poisson_draws(spark):
    """Mean and variance one, independent of partitions, and different by seed."""
    frame = spark.range(4000).select("id", F.explode(F.array(F.array(*resample.poisson_counts(resample.digest("s", F.col("id"), F.lit(3)))))).alias("k"))
    drawn = [tuple(r.k) for r in frame.orderBy("id").collect()]
    again = [tuple(r.k) for r in frame.repartition(7).orderBy("id").collect()]
    assert drawn == again
    for i in range(resample.PER_DIGEST):
        mean = sum(d[i] for d in drawn) / 4000
        assert abs(mean - 1) < 0.06 and abs(sum((d[i] - mean) ** 2 for d in drawn) / 4000 - 1) < 0.12
    other = spark.range(4000).select(F.array(*resample.poisson_counts(resample.digest("t", F.col("id"), F.lit(3)))).alias("k")).limit(50).collect()
    assert [tuple(r.k) for r in other] != drawn[:50]


def test_poisson_interval(spark):
    """The spread of the replicates is the standard error of a mean; rows without weight or value do not count."""
    data = [("a", i, float(i % 20), 1.0) for i in range(2000)] + [("a", 5000, None, 1.0), ("a", 5001, 99.0, 0.0), ("b", 1, 3.0, 2.0), ("c", 1, None, 1.0)]
    frame = spark.createDataFrame(data, "node_id string, event_id long, x double, w double")
    got = {r.node_id: r for r in resample.poisson_interval(frame, ["node_id"], "event_id", "x", "w", 200).collect()}
    a = got["a"]
    assert set(got) == {"a", "b"} and a.estimate == pytest.approx(9.5) and a.replicates == 200
    error = (sum((i - 9.5) ** 2 for i in range(20)) / 20 / 2000) ** 0.5
    assert a.replicate_std == pytest.approx(error, rel=0.15) and a.lower == pytest.approx(9.5 - 1.96 * error, abs=error) and a.lower < 9.5 < a.upper
    # About a third of the replicates of a single record draw nothing.
    assert got["b"].lower == got["b"].upper == 3.0 and 90 < got["b"].replicates < 160


# --- node tables ---


def test_error_assessments(spark):
    at = datetime(2024, 1, 11)
    frame = spark.createDataFrame([("a", at, "sparse", "regular", True), ("b", datetime(2023, 1, 1), "dense", "regular", False)],
                                  "node_id string, as_of timestamp_ntz, coverage_band string, continuity_band string, low_coverage boolean")
    from datetime import timezone

    day = lambda d: datetime(2024, 1, d, tzinfo=timezone.utc)
    got = rows(lookup.error_assessments(frame, [RmseRecord("v1", 2.5, day(5), day(12), source="s"), RmseRecord("v2", 2.9, day(10), source="t")]), "node_id")
    assert got[0]["global_version"] == "v2" and got[0]["node_rmse"] is None and "global RMSE 2.900000 m/s (source t)" in got[0]["limitation"]
    assert got[1]["global_rmse"] is None and got[1]["unit"] is None and "no global RMSE" in got[1]["limitation"] and got[1]["coverage_band"] == "dense"


def test_node_series(spark, observations):
    first = observations.first().node_id
    got = [r.timestamp for r in readers.node_series(observations, first).collect()]
    assert got == sorted(got) and got
    with pytest.raises(ValueError, match="NODE_99"):
        readers.node_series(observations, "NODE_99")
    with pytest.raises(KeyError):
        readers.node_series(observations.drop("node_id"), first)


FIELDS = {"estimate": "power_density_estimate", "lower": "power_density_lower", "upper": "metrics.power_density.upper", "bootstrap_estimate": None, "replicates": "stats.runs.n", "confidence": "power_density_confidence"}


@pytest.mark.parametrize("shape", ["lines", "list", "object", "csv"])
def test_interval_fields(spark, tmp_path, shape):
    """Flat names, dotted paths, a metric's own object and its default names; text numbers, blanks and odd records."""
    records = [
        {"node_id": "a", "power_density_estimate": "1.5", "power_density_lower": "", "metrics": {"power_density": {"lower": 1, "upper": 2.5, "bootstrap_estimate": "1.4", "estimate": 9}}, "stats": {"runs": {"n": "200"}}},
        {"node_id": "b", "metrics": {"power_density": {"estimate": 3, "confidence": 0.9, "replicates": 50.7}}, "metrics.power_density.upper": 4},
        {"node_id": "c", "power_density_estimate": "null", "power_density_lower": "x", "stats": {"runs": 5}},
        {"node_id": 7, "power_density_estimate": 2}, {"node_id": "", "power_density_estimate": 2}, {"power_density_estimate": 2},
        {"node_id": "d", "power_density_estimate": 1}, {"node_id": "d", "power_density_estimate": 2},
    ]
    want = {"a": (1.5, 1.0, 2.5, 1.4, 200, None), "b": (3.0, None, 4.0, None, 50, 0.9), "c": (None,) * 6, "7": (2.0, None, None, None, None, None), "d": (2.0, None, None, None, None, None)}
    if shape == "csv":
        path = tmp_path / "i.csv"
        path.write_text("node_id,power_density_estimate,power_density_lower,metrics.power_density.upper\na,1.5,,2.5\nc,null,x,\n,1,1,1\n")
        want = {"a": (1.5, None, 2.5, None, None, None), "c": (None,) * 6}
    elif shape == "lines":
        path = tmp_path / "i.jsonl"
        path.write_text("\n".join(map(json.dumps, records)) + "\n\n5\n")
    else:
        path = tmp_path / "i.json"
        path.write_text(json.dumps([*records, 5] if shape == "list" else {f"k{i}": r for i, r in enumerate([*records, "x"])}))
    got = {r.node_id: tuple(r)[1:] for r in readers.read_interval_fields(spark, str(path), FIELDS).collect()}
    assert got == want


def test_metric_of():
    assert readers.metric_of([None, "a.b.lower", "x_y"]) == "b" and readers.metric_of(["power_density_lower"]) == "power_density"
    assert readers.metric_of(["plain", "_x"]) is None


def test_geojson_sequence(spark, tmp_path):
    frame = spark.createDataFrame([(f"n{i}", float(i), 2.0, "p") for i in range(20)], "node_id string, lon double, lat double, p string").repartition(3)
    sinks.write_geojson_sequence(frame, f"{tmp_path}/g")
    found = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/g").collect()]
    assert sorted(f["id"] for f in found) == sorted(f"n{i}" for i in range(20)) and found[0]["geometry"]["type"] == "Point" and found[0]["properties"] == {"p": "p"}
