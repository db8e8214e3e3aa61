"""STAC catalogues: find an asset of a collection, publish a table with provenance.

Documents are read and written through Hadoop's file systems, so a catalogue may lie wherever Spark reads
data.  Relative links are resolved against the document that holds them, as the STAC specification asks.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any
from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemora.schema import describe_columns
from anemora.sources import files

STAC_VERSION = "1.0.0"
#: Schemes that are fetched over the network by others; Spark cannot read them.
_WEB = ("http://", "https://")


@dataclass(frozen=True)
class Asset:
    """Where an asset lies, and the item it belongs to."""

    item_id: str
    key: str
    path: str

    def readable(self) -> str:
        """The path, unless only a web client could fetch it."""
        if self.path.startswith(_WEB):
            raise ValueError(f"{self.path} is a web address, not a path that Spark reads")
        return self.path


def relative_to(document: str, href: str) -> str:
    """A link's target, seen from the document that holds it."""
    scheme, mark, rest = document.partition("://")
    if not mark:
        return urljoin(document, href)
    # urljoin knows few schemes; any hierarchical one resolves like http.
    joined = urljoin(f"http://{rest}", href)
    return joined if "://" in href else scheme + joined.removeprefix("http")


def items(spark: SparkSession, collection: str) -> DataFrame:
    """``(item_id, document, key, href)`` of all assets that the collection's item links lead to."""
    links = files.read_json(spark, collection).get("links", [])
    rows = []
    for link in links:
        if link.get("rel") == "item" and isinstance(link.get("href"), str):
            document = relative_to(collection, link["href"])
            item = files.read_json(spark, document)
            for key, asset in item.get("assets", {}).items():
                rows.append((item.get("id"), document, key, asset.get("href")))
    return spark.createDataFrame(rows, "item_id string, document string, key string, href string")


def resolve(spark: SparkSession, collection: str, item_id: str = "data", key: str = "data") -> Asset:
    """One asset of a collection; KeyError if the collection has no such asset."""
    found = items(spark, collection).where((F.col("item_id") == item_id) & (F.col("key") == key)).first()
    if found is None or found["href"] is None:
        raise KeyError(f"{collection} has no asset {key!r} of an item {item_id!r}")
    return Asset(item_id, key, relative_to(found["document"], found["href"]))


def resolve_dataset(spark: SparkSession, index: str, dataset: str) -> Asset:
    """An asset by its name in an index document: ``{name: {"collection": ..., "item": ..., "asset": ...}}``."""
    known = files.read_json(spark, index)
    if not isinstance(known, dict) or not isinstance(known.get(dataset), dict) or "collection" not in known[dataset]:
        raise KeyError(f"{index} says nothing of a collection for {dataset!r}")
    entry = known[dataset]
    return resolve(spark, relative_to(index, entry["collection"]), entry.get("item", "data"), entry.get("asset", "data"))


def checksums(spark: SparkSession, folder: str) -> dict[str, str]:
    """SHA-256 of a folder's Parquet files, computed where the files are read."""
    read = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return {r["name"]: r["digest"] for r in read.select(name.alias("name"), F.sha2("content", 256).alias("digest")).collect()}


def publish(df: DataFrame, folder: str, *, collection_id: str, item_id: str, title: str = "", inputs: dict[str, str] | None = None,
            parameters: dict[str, Any] | None = None, bbox: list[float] | None = None, overwrite: bool = False) -> str:
    """Write a table as Parquet with collection, item and a manifest of checksums; returns the collection's path."""
    spark, folder = df.sparkSession, str(folder)
    if files.exists(spark, folder):
        if not overwrite:
            raise FileExistsError(folder)
        files.remove(spark, folder)
    assets = files.join(folder, "assets")
    df.write.parquet(assets)
    now, columns = datetime.now(timezone.utc).isoformat(), describe_columns(df)
    collection, item = files.join(folder, "collection.json"), files.join(folder, "items", f"{item_id}.json")
    files.write_json(spark, collection, {
        "type": "Collection", "stac_version": STAC_VERSION, "id": collection_id, "title": title or collection_id, "description": title,
        "license": "other", "extent": {"spatial": {"bbox": [bbox]}, "temporal": {"interval": [[None, None]]}},
        "links": [{"rel": "item", "href": f"./items/{item_id}.json"}], "table:columns": columns})
    files.write_json(spark, item, {
        "type": "Feature", "stac_version": STAC_VERSION, "id": item_id, "collection": collection_id, "geometry": None, "bbox": bbox,
        "properties": {"datetime": now, "table:columns": columns},
        "links": [{"rel": "collection", "href": "../collection.json"}],
        "assets": {"data": {"href": "../assets", "type": "application/x-parquet", "roles": ["data"]}}})
    files.write_json(spark, files.join(folder, "manifest.json"), {
        "generated_at": now, "inputs": inputs or {}, "parameters": parameters or {}, "files": checksums(spark, assets)})
    return collection


def update_root_catalog(spark: SparkSession, path: str, collection: str, title: str = "") -> None:
    """Link a collection from a root catalogue, once."""
    path = str(path)
    catalog = files.read_json(spark, path) if files.exists(spark, path) else {
        "type": "Catalog", "stac_version": STAC_VERSION, "id": "root", "description": "", "links": []}
    if all(link.get("href") != collection for link in catalog["links"]):
        catalog["links"].append({"rel": "child", "href": collection, "title": title})
        files.write_json(spark, path, catalog)
