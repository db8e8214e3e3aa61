"""Delete-one values of a fitted Weibull power density, without refits.

The fit without a record is one step from the full fit: with the gradient and the second
derivatives of all records known per node, those of the rest are a subtraction, and the step is a
two-by-two system in columns, corrected once by the node's third derivatives.  Records are
read once beside one row per node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.functions.special import log_gamma_of
from anemora.operators.weibull import FLOOR

SLOPES = ("ga", "gb", "haa", "hab", "hbb")
THIRD = ("aaa", "aab", "abb", "bbb")

#: Newton steps over the merged values that take the search's result to the maximum, and the longest of them in log space.
ROUNDS, LONGEST = 3, 0.5


def _curve(df: DataFrame, value: Column) -> DataFrame:
    """The terms all derivatives are made of; each is a column, so that none is written out twice."""
    k = F.exp("a")
    return (df.withColumns({"k": k, "kr": k * (F.ln(value) - F.col("b"))}).withColumn("u", F.exp("kr"))
            .withColumn("below", F.greatest(-F.expm1(-F.col("u")), F.lit(FLOOR))).withColumns({"pull": F.exp(-F.col("u")) * F.col("u") / F.col("below"), "tilt": (F.col("below") - F.col("u")) / F.col("below")})
            .withColumn("bend", F.col("pull") * F.col("tilt")).withColumn("turn", F.col("bend") * F.col("tilt") - F.col("pull") * (F.col("u") + F.col("bend"))))


def _slopes() -> dict[str, dict[str, Column]]:
    """Derivatives, up to the third, of one observation's log-likelihood in log shape (a) and log scale (b), by kind."""
    k, kr, u, pull, bend, turn = (F.col(c) for c in ("k", "kr", "u", "pull", "bend", "turn"))
    right = {"ga": -u * kr, "gb": u * k, "haa": -u * kr - kr * kr * u, "hab": u * k + k * kr * u, "hbb": -k * k * u,
             "aaa": -u * kr - 3.0 * kr * kr * u - kr * kr * kr * u, "aab": u * k + 3.0 * k * kr * u + k * kr * kr * u,
             "abb": -2.0 * k * k * u - k * k * kr * u, "bbb": k * k * k * u}
    # A value seen exactly adds log k + k r to what a lower limit at it would say.
    seen = {"ga": 1.0 + kr, "gb": -k, "haa": kr, "hab": -k, "aaa": kr, "aab": -k}
    return {
        "in": {n: x + seen[n] if n in seen else x for n, x in right.items()},
        "left": {"ga": pull * kr, "gb": -pull * k, "haa": pull * kr + kr * kr * bend, "hab": -pull * k - k * kr * bend, "hbb": k * k * bend,
                 "aaa": pull * kr + 3.0 * kr * kr * bend + kr * kr * kr * turn, "aab": -pull * k - 3.0 * k * kr * bend - k * kr * kr * turn,
                 "abb": 2.0 * k * k * bend + k * k * kr * turn, "bbb": -k * k * k * turn},
        "right": right,
    }


def _stepped(df: DataFrame, name: str, of: dict[str, Column]) -> DataFrame:
    """Add ``name``: ``3 b + ln Gamma(1 + 3 / k)`` at the maximum next to (a, b); null where the likelihood is not concave.

    A Newton step (x, y), then a second one against what the third derivatives add to the gradient there.
    """
    df = df.withColumns({f"__{n}": x for n, x in of.items()})
    ga, gb, haa, hab, hbb = (F.col(f"__{n}") for n in SLOPES)
    concave = (haa < 0) & (haa * hbb - hab * hab > 0)
    df = df.withColumn("__det", F.when(concave, haa * hbb - hab * hab))
    det, x, y = F.col("__det"), F.col("__x"), F.col("__y")
    df = df.withColumns({"__x": (hab * gb - hbb * ga) / det, "__y": (hab * ga - haa * gb) / det})
    aaa, aab, abb, bbb = (F.col(n) for n in THIRD)
    df = df.withColumns({"__ca": 0.5 * (aaa * x * x + 2.0 * aab * x * y + abb * y * y), "__cb": 0.5 * (aab * x * x + 2.0 * abb * x * y + bbb * y * y)})
    ca, cb = F.col("__ca"), F.col("__cb")
    df = df.withColumns({"__g": 1.0 + 3.0 * F.exp(-(F.col("a") + x + (hab * cb - hbb * ca) / det)),
                         "__b": F.col("b") + y + (hab * ca - haa * cb) / det})
    return df.withColumn(name, 3.0 * F.col("__b") + log_gamma_of(F.col("__g"))).drop(
        *[f"__{n}" for n in (*SLOPES, "det", "x", "y", "ca", "cb", "g", "b")])


def delete_one_density(records: DataFrame, sample: DataFrame, fits: DataFrame, lower: float, upper: float, air_density: float) -> DataFrame:
    """``(node_id, n, d1, d2, d3)``: power sums of the distances between the density without a record and with all.

    ``records`` has ``v, w_in, w_left, w_right, speed_scale`` per record, ``sample`` the same merged by value, ``fits``
    the shape and scale of the nodes wanted, which a few Newton steps take to the maximum first.  A record without weight counts with distance zero; a node where the rest of some
    record is not concave (too few values) has NaN sums.
    """
    kinds = _slopes()
    point = fits.select("node_id", F.ln("weibull_shape").alias("a"), F.ln("weibull_scale").alias("b"))

    def summed(at: DataFrame, names: tuple[str, ...]) -> DataFrame:
        sums = []
        for n in names:
            by_kind = F.when(F.col("kind") == "in", kinds["in"][n]).when(F.col("kind") == "left", kinds["left"][n]).otherwise(kinds["right"][n])
            sums.append(F.sum(F.col("weight") * by_kind).alias(n))
        return _curve(sample.join(at, "node_id"), F.col("value")).groupBy("node_id").agg(F.max("a").alias("a"), F.max("b").alias("b"), *sums)

    ga, gb, haa, hab, hbb = (F.col(n) for n in SLOPES)
    for _ in range(ROUNDS):
        det = haa * hbb - hab * hab
        steps = {"a": (hab * gb - hbb * ga) / det, "b": (hab * ga - haa * gb) / det}
        point = summed(point, SLOPES).select("node_id", *[
            (F.col(c) + F.when((haa < 0) & (det > 0), F.greatest(F.lit(-LONGEST), F.least(F.lit(LONGEST), x))).otherwise(0.0)).alias(c)
            for c, x in steps.items()])
    facts = summed(point, (*SLOPES, *THIRD))
    terms = ("k", "kr", "u", "below", "pull", "tilt", "bend", "turn")
    for side, limit in (("left", lower), ("right", upper)):
        facts = _curve(facts, F.lit(limit)).withColumns({f"{side}_{n}": kinds[side][n] for n in SLOPES}).drop(*terms)
    facts = _stepped(facts, "full", {n: F.col(n) for n in SLOPES})
    known = (F.col("w_in") > 0) & F.col("v").isNotNull()
    rows = _curve(records.select("node_id", "v", "w_in", "w_left", "w_right", "speed_scale").join(facts, "node_id"), F.col("v"))
    rest = {n: F.col(n) - F.when(known, F.col("w_in") * x).otherwise(0.0) - F.col("w_left") * F.col(f"left_{n}") - F.col("w_right") * F.col(f"right_{n}")
            for n, x in ((n, kinds["in"][n]) for n in SLOPES)}
    # The factor in front, with the cube of the node's speed scale, waits until the difference is taken.
    factor = 0.5 * air_density * F.pow("speed_scale", F.lit(3)) * F.exp("full")
    distance = _stepped(rows, "rest", rest).select(
        "node_id", F.coalesce(factor * F.expm1(F.col("rest") - F.col("full")), F.lit(float("nan"))).alias("d"))
    d = F.col("d")
    return distance.groupBy("node_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(d).alias("d1"), F.sum(d * d).alias("d2"), F.sum(d * d * d).alias("d3"))
