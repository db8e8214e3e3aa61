"""Readers, writers, schema, catalogues, chunks and the composed stages."""

import hashlib
import json
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from anemora import schema
from anemora.config import BootstrapConfig
from anemora.functions import geometry
from anemora.plans import stages
from anemora.plans.tables import obs, ref
from anemora.sources import files, readers, sinks, stac
from anemora.streaming import chunks


def test_schema_renderings(spark):
    names = [f.name for f in schema.OBSERVATION_FIELDS]
    assert len(names) == len(set(names)) == 91
    kinds = [f.kind for f in schema.OBSERVATION_FIELDS]
    assert [kinds.count(k) for k in ("number", "integer", "string", "boolean", "datetime", "binary")] == [62, 12, 10, 5, 1, 1]
    assert schema.arrow_schema().names == names == [n for n, _ in schema.sql_layout()] == [c["name"] for c in schema.stac_columns()]
    empty = spark.createDataFrame([], schema.observation_schema())
    assert schema.schema_problems(empty) == []
    assert "missing column node_id" in schema.schema_problems(empty.drop("node_id"))
    assert schema.schema_problems(empty.withColumn("node_id", F.lit(1)))[0].startswith("column node_id is int")


def test_filters_are_pushed_down(spark, sf, tmp_path):
    path = str(tmp_path / "obs")
    sinks.write_parquet(obs(spark, sf), path, by="node_id", buckets=4)
    keep = readers.ObservationFilter(include=["NODE_01", "NODE_02"], exclude=["NODE_02"], start=datetime(2024, 1, 2), end=datetime(2024, 1, 20))
    df = readers.read_observations(spark, path, ["node_id", "timestamp", "pred_wind_speed"], keep)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "node_id" in plan.split("PushedFilters")[1] and "GreaterThanOrEqual(timestamp" in plan.split("PushedFilters")[1]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "event_type" not in plan.split("ReadSchema")[1]
    assert {r["node_id"] for r in df.collect()} == {"NODE_01"}
    with pytest.raises(KeyError):
        readers.read_observations(spark, path, ["nope"])


def test_point_round_trip_and_geo_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", -9.2, 43.5), ("b", 1.5, -3.25)], "node_id string, lon double, lat double")
    coded = df.withColumn("geometry", geometry.point_wkb("lon", "lat"))
    back = coded.select("node_id", geometry.point_coordinates("geometry").alias("c")).select("node_id", "c.*")
    assert rows(back, "node_id") == rows(df, "node_id")
    big = spark.sql("select unhex('00000000013FF00000000000004000000000000000') as g").select(geometry.point_coordinates("g").alias("c")).first()["c"]
    assert (big["lon"], big["lat"]) == (1.0, 2.0)
    sinks.write_geojson(df.withColumn("power", F.lit(None).cast("double")), str(tmp_path / "n.geojson"))
    document = json.loads((tmp_path / "n.geojson").read_text())
    assert document["type"] == "FeatureCollection" and document["features"][0]["geometry"] == {"type": "Point", "coordinates": [-9.2, 43.5]}
    assert document["features"][0]["properties"] == {"power": None}
    sinks.write_geoparquet(coded.coalesce(1), str(tmp_path / "geo"))
    part = next((tmp_path / "geo").glob("part-*.parquet"))
    geo = json.loads(pq.read_schema(part).metadata[b"geo"])
    assert geo["columns"]["geometry"]["encoding"] == "WKB" and geo["primary_column"] == "geometry"
    assert spark.read.parquet(str(part)).count() == 2


def test_tables_in_text_formats(spark, tmp_path):
    a = spark.createDataFrame([("x", 1.5)], "node_id string, v double")
    b = spark.createDataFrame([("y", 2.5, "t")], "node_id string, v double, w string")
    sinks.write_csv(a, str(tmp_path / "a"), single=True)
    sinks.write_csv(b, str(tmp_path / "b"), single=True)
    both = readers.read_csv_tables(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert rows(both, "node_id") == [{"node_id": "x", "v": 1.5, "w": None}, {"node_id": "y", "v": 2.5, "w": "t"}]
    sinks.write_json_array(b, str(tmp_path / "b.json"))
    assert json.loads((tmp_path / "b.json").read_text()) == [{"node_id": "y", "v": 2.5, "w": "t"}]
    sinks.write_json_lines(b, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).first()["v"] == 2.5
    assert sinks.markdown_table(a) == "| node_id | v |\n| --- | --- |\n| x | 1.500 |"
    (tmp_path / "tax.json").write_text(json.dumps({"nodes": [{"node_id": "x", "total_observations": 3}, {"total_observations": 9}]}))
    assert readers.read_taxonomy(spark, str(tmp_path / "tax.json")).count() == 1
    (tmp_path / "i.jsonl").write_text(json.dumps({"node_id": "x", "metrics": {"power": {"lower": 1.0, "upper": 2.0}}}) + "\n")
    (tmp_path / "i.csv").write_text("node_id,power_lower,power_upper\nx,1.0,\n")
    assert readers.read_intervals(spark, str(tmp_path / "i.jsonl"), "power").first()["power_upper"] == 2.0
    flat = readers.read_intervals(spark, str(tmp_path / "i.csv"), "power").first()
    assert flat["power_lower"] == 1.0 and flat["power_upper"] is None
    (tmp_path / "r.jsonl").write_text(json.dumps({"node_id": "x", "records": [{"v": 1}, {"v": 2}]}) + "\n")
    assert readers.read_records(spark, str(tmp_path / "r.jsonl")).count() == 2


def test_series_adapters(spark):
    raw = spark.createDataFrame([("2024-01-01 00:00:00", "7.5"), ("2024-01-01 01:00:00", "bad"), ("nope", "3"), ("2024-01-01 02:00:00", "-1"),
                                 ("2024-01-01 03:00:00", "inf")], "timestamp string, wind_speed string")
    got = rows(readers.uncensored_records(raw, node_name="mast"))
    assert len(got) == 1 and got[0]["node_id"] == "mast" and got[0]["prob_range_in"] == 1.0 and got[0]["range_flag"] == "in_range"


def test_catalogue(spark, tmp_path):
    df = spark.createDataFrame([("x", 1.5)], "node_id string, v double")
    folder = f"file://{tmp_path}/cat"
    collection = stac.publish(df, folder, collection_id="c", item_id="data", inputs={"obs": "abc"})
    manifest = json.loads((tmp_path / "cat" / "manifest.json").read_text())
    want = {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in (tmp_path / "cat" / "assets").glob("*.parquet")}
    assert want and manifest["files"] == want and files.names(spark, f"{folder}/assets", ".parquet") == sorted(want)
    (tmp_path / "index.json").write_text(json.dumps({"d": {"collection": "cat/collection.json"}, "bad": {}}))
    index = f"file://{tmp_path}/index.json"
    assert spark.read.parquet(stac.resolve_dataset(spark, index, "d").readable()).first()["v"] == 1.5
    for name in ("other", "bad"):
        with pytest.raises(KeyError):
            stac.resolve_dataset(spark, index, name)
    with pytest.raises(KeyError):
        stac.resolve(spark, collection, "data", "thumbnail")
    with pytest.raises(FileExistsError):
        stac.publish(df, folder, collection_id="c", item_id="data")
    assert stac.publish(df, folder, collection_id="c", item_id="data", overwrite=True) == collection
    item = tmp_path / "cat" / "items" / "data.json"
    payload = json.loads(item.read_text())
    payload["assets"]["data"]["href"] = "https://example.org/x.parquet"
    item.unlink()
    files.write_json(spark, str(item), payload)
    with pytest.raises(ValueError):
        stac.resolve(spark, collection).readable()
    for _ in range(2):
        stac.update_root_catalog(spark, str(tmp_path / "catalog.json"), "cat/collection.json")
    assert len(json.loads((tmp_path / "catalog.json").read_text())["links"]) == 1
    assert stac.relative_to("s3a://b/x/c.json", "./items/i.json") == "s3a://b/x/items/i.json"
    assert stac.relative_to("s3a://b/x/items/i.json", "../assets") == "s3a://b/x/assets"
    assert stac.relative_to("/a/c.json", "hdfs://n/y") == "hdfs://n/y" and stac.relative_to("hdfs://n/c.json", "/z") == "hdfs://n/z"


def test_resume_and_subsets(spark, tmp_path):
    store = str(tmp_path / "done")
    nodes = spark.createDataFrame([("a",), ("b",)], "node_id string")
    assert sinks.pending_nodes(nodes, store).count() == 2
    for value in (1, 2):
        sinks.append_results(spark.createDataFrame([("a", value)], "node_id string, v int"), store)
    assert [r["node_id"] for r in sinks.pending_nodes(nodes, store).collect()] == ["b"]
    assert sinks.stored_results(spark, store).first()["v"] == 2
    assert sinks.subset_key(["a", "b", "a"]) == sinks.subset_key(["a", "b"]) != sinks.subset_key(["b", "a"])
    assert sinks.materialise_subset(nodes, ["b"], str(tmp_path), "one").collect()[0]["node_id"] == "b"
    assert sinks.materialise_subset(nodes.limit(0), ["b"], str(tmp_path), "two").count() == 0
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        sinks.pending_nodes(nodes, str(tmp_path / "broken")).count()


def test_chunked_anomalies(spark, tmp_path):
    start = datetime(2024, 1, 1)
    def batch(day, third):
        return spark.createDataFrame(
            [("n", start + timedelta(days=day, hours=h), 0.2, 0.5, p) for h, p in ((0, 0.3), (1, 0.3), (5, third))],
            "node_id string, timestamp timestamp_ntz, prob_range_below double, prob_range_in double, prob_range_above double").coalesce(1)
    folder, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    batch(0, 0.3).write.mode("append").parquet(folder)
    run = lambda: chunks.process_chunks(
        chunks.observation_chunks(spark, folder, spark.read.parquet(folder).schema, 1), chunks.anomaly_sink(out), mark).awaitTermination(60)
    run()
    assert [r["anomaly"] for r in spark.read.parquet(out).collect()] == ["gap"]
    batch(1, 0.9).write.mode("append").parquet(folder)
    run()
    # The second chunk's first row follows the first chunk's last after most of a day.
    assert sorted(r["anomaly"] for r in spark.read.parquet(out).collect()) == ["gap", "gap", "gap;posterior"]


def test_stages(spark, sf):
    with pytest.raises(ValueError):
        stages.select_stages(["nope"])
    assert stages.select_stages(skip=["bootstrap"])[-1] == "seasonal_power"
    rows_ = obs(spark, sf)
    tables = stages.compute_resource(rows_, stages.ResourceOptions(min_in_weight=20.0), include=["empirical", "power", "node_summary", "dependence"])
    assert set(tables) == {"empirical", "power", "node_summary", "dependence"}
    assert tables["node_summary"].count() == rows_.select("node_id").distinct().count()
    assert set(stages.compute_resource(rows_, include=["taxonomy"])) == {"taxonomy"}
    found = stages.validate_reference(rows_, readers.clean_reference(ref(spark, sf)), min_in_weight=20.0, sequence="event_id",
                                      intervals=BootstrapConfig(replicas=3))
    assert "mean_speed_lower" in found["comparison"].columns
    table = {(r["dataset"], r["scope"]) for r in found["comparison"].collect()}
    assert table == {("model", "paired"), ("model", "global"), ("reference", "paired"), ("reference", "global"), ("reference", "global_censored")}
    assert found["differences"].first()["mean_speed_difference"] is not None
