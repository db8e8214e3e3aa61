"""WKB points by byte arithmetic: encode, decode, GeoJSON geometry."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COORDINATES = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
_POINT = np.dtype([("order", "u1"), ("kind", "<u4"), ("xy", "<f8", (2,))])


@F.pandas_udf(T.BinaryType())
def point_wkb(lon: pd.Series, lat: pd.Series) -> pd.Series:
    """Little-endian WKB point, 21 bytes; null when a coordinate is missing."""
    x, y = lon.to_numpy(dtype=float), lat.to_numpy(dtype=float)
    points = np.zeros(len(x), dtype=_POINT)
    points["order"], points["kind"] = 1, 1
    points["xy"][:, 0], points["xy"][:, 1] = x, y
    raw, size = points.tobytes(), _POINT.itemsize
    return pd.Series([None if np.isnan(a) or np.isnan(b) else raw[i * size:(i + 1) * size] for i, (a, b) in enumerate(zip(x, y))])


@F.pandas_udf(_COORDINATES)
def point_coordinates(wkb: pd.Series) -> pd.DataFrame:
    """Coordinates of WKB points of either byte order; other geometries are an error."""
    out = np.full((len(wkb), 2), np.nan)
    for i, raw in enumerate(wkb):
        if raw is None:
            continue
        if len(raw) != 21:
            raise ValueError("Unsupported geometry length for WKB point.")
        out[i] = np.frombuffer(raw, dtype="<f8" if raw[0] == 1 else ">f8", count=2, offset=5)
    return pd.DataFrame(out, columns=["lon", "lat"])


def from_hex(text: Column) -> Column:
    """Bytes of hexadecimal text, such as a geometry column of a CSV file; null where it is none."""
    return F.unhex(F.trim(text))


def geojson_point(lon: Column, lat: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def feature(identifier: Column, lon: Column, lat: Column, properties: list[str]) -> Column:
    """One GeoJSON feature as text."""
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"), identifier.alias("id"), geojson_point(lon, lat).alias("geometry"),
        F.struct(*properties).alias("properties")), {"ignoreNullFields": "false"})
