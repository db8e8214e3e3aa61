"""The observation table: 91 columns in storage order, and its renderings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column families, logical types and their order.
_STATIONS = ("vila", "prio")
_PEAKS = (("0", "negative"), ("1", "positive"))
_SIGNALS = (("pwr", "signal power", "dB"), ("velo", "radial velocity", "cm/s"))
_STATISTICS = (("mean", "mean"), ("median", "median"), ("stddev", "standard deviation"), ("min", "minimum"),
               ("max", "maximum"), ("n", "count"), ("mad", "MAD"))
_STATION_COLUMNS = (
    ("bearing", "number", "bearing from station to cell centroid, degrees clockwise from geographic north."),
    ("dist_km", "number", "great-circle distance from station to cell centroid, in kilometres."),
    ("maintenance_interval_id", "string", "identifier of the maintenance interval covering the observation."),
    ("maintenance_type", "string", "maintenance category."),
    ("maintenance_start", "string", "ISO8601 start of the active maintenance interval."),
    ("hours_since_last_calibration", "number", "elapsed hours since the last calibration."),
)
_CORE = (
    ("timestamp", "datetime", "Observation timestamp (UTC)."),
    ("node_id", "string", "Mesh node identifier."),
    ("geometry", "binary", "Cell geometry as WKB (lon/lat)."),
)
_PREDICTIONS = (
    ("pred_wind_speed", "number", "Predicted wind speed (m/s)."),
    ("pred_cos_wind_dir", "number", "Cosine of the predicted direction."),
    ("pred_sin_wind_dir", "number", "Sine of the predicted direction."),
    ("pred_wind_direction", "number", "Predicted direction (degrees clockwise from north)."),
    ("prob_range_below", "number", "Posterior of the speed being below the range."),
    ("prob_range_in", "number", "Posterior of the speed being in range."),
    ("prob_range_above", "number", "Posterior of the speed being above the range."),
    ("pred_range_label", "string", "Range class chosen by the classifier."),
    ("pred_range_confidence", "number", "Confidence of the range label."),
    ("pred_speed_range_label", "string", "Range class that follows from the predicted speed."),
    ("range_near_lower_margin", "boolean", "Speed is near the lower margin."),
    ("range_near_upper_margin", "boolean", "Speed is near the upper margin."),
    ("range_near_any_margin", "boolean", "Speed is near any margin."),
    ("range_flag", "string", "Consolidated range flag (below/in/above/uncertain)."),
    ("range_flag_confident", "boolean", "The flag passes the confidence threshold."),
    ("range_prediction_consistent", "boolean", "The flag agrees with the class of the predicted speed."),
)
SPARK_TYPES = {
    "datetime": T.TimestampType(), "string": T.StringType(), "binary": T.BinaryType(), "integer": T.LongType(),
    "number": T.DoubleType(), "boolean": T.BooleanType(),
}
SQL_TYPES = {
    "datetime": "TIMESTAMP", "string": "VARCHAR", "binary": "BLOB", "integer": "BIGINT", "number": "DOUBLE", "boolean": "BOOLEAN",
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    description: str


def _station_fields(station: str) -> list[Field]:
    title = station.upper()
    out = [Field(f"{station}_aggregated__n_{p}", "integer", f"{title}: contributing observations ({side} Bragg peak).")
           for p, side in _PEAKS]
    for signal, noun, unit in _SIGNALS:
        for stat, words in _STATISTICS:
            kind = "integer" if stat == "n" else "number"
            out += [Field(f"{station}_aggregated__{signal}_{stat}_{p}", kind, f"{title}: {words} of {noun} ({side} Bragg peak), in {unit}.")
                    for p, side in _PEAKS]
    return out + [Field(f"{station}_{name}", kind, f"{title}: {text}") for name, kind, text in _STATION_COLUMNS]


OBSERVATION_FIELDS: tuple[Field, ...] = (
    *[Field(*f) for f in _CORE], *[f for s in _STATIONS for f in _station_fields(s)], *[Field(*f) for f in _PREDICTIONS])


def observation_schema() -> T.StructType:
    """Spark schema; descriptions travel as column comments."""
    return T.StructType([T.StructField(f.name, SPARK_TYPES[f.kind], True, {"comment": f.description}) for f in OBSERVATION_FIELDS])


def sql_layout() -> list[tuple[str, str]]:
    return [(f.name, SQL_TYPES[f.kind]) for f in OBSERVATION_FIELDS]


def arrow_schema():
    import pyarrow as pa

    kinds = {"datetime": pa.timestamp("us", tz="UTC"), "string": pa.string(), "binary": pa.binary(), "integer": pa.int64(),
             "number": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([pa.field(f.name, kinds[f.kind]) for f in OBSERVATION_FIELDS])


def stac_columns() -> list[dict[str, str]]:
    return [{"name": f.name, "type": f.kind, "description": f.description} for f in OBSERVATION_FIELDS]


def stac_type(kind: T.DataType) -> str:
    """Logical type of a Spark type, for table descriptions of any DataFrame."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(kind, T.NumericType):
        return "number"
    if isinstance(kind, T.BinaryType):
        return "binary"
    if isinstance(kind, T.StringType):
        return "string"
    raise ValueError(f"unsupported type {kind.simpleString()}")


def describe_columns(df: DataFrame, descriptions: dict[str, str] | None = None) -> list[dict[str, str]]:
    texts = {f.name: f.description for f in OBSERVATION_FIELDS} | (descriptions or {})
    return [{"name": f.name, "type": stac_type(f.dataType), "description": texts.get(f.name, "")} for f in df.schema.fields]


def schema_problems(df: DataFrame) -> list[str]:
    """Differences between a DataFrame and the observation table; order counts."""
    out = []
    want, have = [f.name for f in OBSERVATION_FIELDS], df.columns
    out += [f"missing column {c}" for c in want if c not in have] + [f"unexpected column {c}" for c in have if c not in want]
    if not out and want != have:
        out.append("columns are not in storage order")
    for f in OBSERVATION_FIELDS:
        if f.name in have and stac_type(df.schema[f.name].dataType) != f.kind:
            out.append(f"column {f.name} is {df.schema[f.name].dataType.simpleString()}, expected {f.kind}")
    return out
