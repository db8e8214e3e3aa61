"""Bootstrap intervals of speed and power metrics per node.

A replicate is a set of draws with replacement (within strata, over all records, or in
blocks of time) that is evaluated like the records themselves.

There is one route.  A node's records, in time order, are cut into parts of bounded size,
and a task draws all replicates of one part.  How many of a replicate's draws fall into a
part follows the multinomial law of the part sizes; the counts are split down a binary
tree of parts by seeded generators that every part can repeat, so parts agree without
talking to each other.  Blocks start in one part and run on into the first records of the next,
which come along.  A node of one part is finished inside its task.  Of a node of many, only
sums, a histogram and the values of the bins that hold the quantiles leave the tasks.

Draws depend on seed, stratum, part and replicate, not on partitioning or retries; they
follow the law of a sequential implementation with one generator, not its literal sequence.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anemora.config import BootstrapConfig
from anemora.functions.labels import hard_label, posterior, stratum, with_posteriors
from anemora.functions.scalars import is_finite, micros, numeric
from anemora.functions.special import log_gamma_of
from anemora.operators.grouped import hot_keys, spread
from anemora.operators.influence import delete_one_density
from anemora.operators.lookup import with_default
from anemora.operators.ordered import order_rows
from anemora.operators.power import weibull_third_moment
from anemora.operators.weibull import fit_arrays, fit_weibull
from anemora.session import checkpoint_ready, held

METRICS = ("mean_speed", "p50", "p90", "p99", "power_density")
STRATA = ("below", "in", "above", "uncertain")
QUANTILES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
BASELINE = -1

#: Records of a part, the bins of a large node's histogram, and the runs of a stationary draw in mean lengths that a part can follow into the next.
MAX_RECORDS_PER_TASK = 250_000
BINS = 512
RUN_ROOM = 64

_SUMS = ("wi", "wv", "wvvv", "ww", "w4", "wl", "wr", "s_in", "used")
_ROW = (
    "node_id string, replica int, " + ", ".join(f"{s} double" for s in _SUMS)
    + ", scale double, p50 double, p90 double, p99 double, power_density double, method string")


# -- draws -------------------------------------------------------------------------
def shares(total: np.ndarray, sizes: np.ndarray, part: int, key: Sequence[int], excess: np.ndarray | None = None):
    """How many of ``total`` draws (one number per replicate) start in a part.

    Halves the range of parts again and again; every part repeats the same halvings.  With ``excess`` the lengths that
    runs have beyond one record are split as well: lengths are exchangeable, so the left runs hold a
    beta-binomial part of them.
    """
    low, high = 0, len(sizes)
    while high - low > 1:
        middle = (low + high) // 2
        left, both = int(sizes[low:middle].sum()), int(sizes[low:high].sum())
        rng = np.random.default_rng([*key, low, high])
        first = rng.binomial(total, left / both if both else 0.0)
        if excess is not None:
            rest = total - first
            share = rng.beta(np.maximum(first, 1e-9), np.maximum(rest, 1e-9))
            longer = np.where(rest == 0, excess, np.where(first == 0, 0, rng.binomial(excess, share)))
            excess = longer if part < middle else excess - longer
        total, low, high = (first, low, middle) if part < middle else (total - first, middle, high)
    return (total, excess) if excess is not None else total


class Draws:
    """The draws of one part: ``at(replica)`` gives positions among the part's own records and those that follow."""

    def __init__(self, config: BootstrapConfig, length: int, strata: np.ndarray, cells: np.ndarray, part: int, own: int, after: int):
        stratified = config.resampling == "iid" and config.label_strategy == "fixed"
        self.config, self.length, self.own, self.room = config, max(1, length), own, own + after
        self.whole, self.part = len(cells) == 1, part
        self.groups = [np.flatnonzero(strata == s) for s in STRATA] if stratified else [np.arange(own)]
        sizes = cells if stratified else cells.sum(axis=1, keepdims=True)
        self.total = sizes.sum(axis=0)
        replicas = config.replicas
        self.blocks = config.resampling != "iid" and self.length > 1
        self.counts, self.excess, self.last = [], None, None
        for g in range(sizes.shape[1]):
            key, n = (config.seed, g), int(self.total[g])
            if not self.blocks:
                self.counts.append(shares(np.full(replicas, n), sizes[:, g], part, key))
            elif config.resampling == "moving_block":
                runs = -(-n // self.length)
                self.counts.append(shares(np.full(replicas, max(0, runs - 1)), sizes[:, g], part, key))
                start = np.random.default_rng([*key, 1]).integers(0, max(n, 1), size=replicas) - int(sizes[:part, g].sum())
                self.last = np.where((start >= 0) & (start < own), start, -1), n - max(0, runs - 1) * self.length
            else:
                runs = 1 + np.random.default_rng([*key, 2]).binomial(max(0, n - 1), 1.0 / self.length, size=replicas)
                runs = np.minimum(runs, n)
                count, self.excess = shares(runs, sizes[:, g], part, key, n - runs)
                self.counts.append(count)

    def at(self, replica: int) -> tuple[np.ndarray, np.random.Generator]:
        rng = np.random.default_rng([self.config.seed, self.part, replica, 3])
        if not self.blocks:
            parts = [members[rng.integers(0, members.size, size=int(count[replica]))] for members, count in zip(self.groups, self.counts) if members.size]
            return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), rng
        starts = rng.integers(0, self.own, size=int(self.counts[0][replica])) if self.own else np.zeros(0, np.int64)
        lengths = np.full(starts.size, self.length)
        if self.last is not None and self.last[0][replica] >= 0:
            starts, lengths = np.append(starts, self.last[0][replica]), np.append(lengths, self.last[1])
        if self.excess is not None and starts.size:
            lengths = 1 + rng.multinomial(int(self.excess[replica]), rng.dirichlet(np.ones(starts.size)))
        first = np.cumsum(lengths) - lengths
        steps = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        return (np.repeat(starts, lengths) + steps) % (self.own if self.whole else self.room), rng


# -- evaluation of one sample --------------------------------------------------------
def evaluate(speed, w_in, w_left, w_right, s_in, used, config: BootstrapConfig, scale: float) -> tuple:
    """Quantiles, power density and method of one sample given clamped speeds and weights."""
    lower, upper = config.thresholds.lower, config.thresholds.upper
    inside = w_in > 0
    v, w = speed[inside] * scale, w_in[inside]
    total_in = float(w.sum())
    left, right = float(w_left.sum()), float(w_right.sum())
    p50 = p90 = p99 = None
    if total_in > 0:
        p50, p90, p99 = _interpolated(v, w, tuple(QUANTILES.values()))
    method, density = "kaplan_meier", None
    if not _fallback(float(used.sum()), float(s_in.sum()), left, right, config) and total_in >= config.min_in_range_weight:
        kinds = np.concatenate([np.full(v.size, "in"), ["left"] * (left > 0), ["right"] * (right > 0)])
        values = np.concatenate([speed[inside], [lower] * (left > 0), [upper] * (right > 0)])
        weights = np.concatenate([w, [left] * (left > 0), [right] * (right > 0)])
        fit = fit_arrays(kinds, values, weights, config.min_in_range_weight)
        if fit[3] and fit[4]:
            method = "weibull"
            density = 0.5 * config.air_density * weibull_third_moment(fit[0], fit[1] * scale)
    if method == "kaplan_meier":
        total = total_in + left + right
        if total > 0:
            # Speeds are clamped to the bounds, so nothing leaves the risk set before the last
            # event and the product-limit steps reduce to plain shares of the weight.
            tail = config.tail_surrogate if config.tail_surrogate is not None else upper
            cubes = (float(np.dot(w, v**3)) + left * (lower * scale) ** 3 + right * (tail * scale) ** 3) / total
            density = 0.5 * config.air_density * cubes if cubes > 0 else None
    return p50, p90, p99, density, method


def _fallback(used: float, inside: float, left: float, right: float, config: BootstrapConfig) -> bool:
    """Whether the label mix asks for Kaplan-Meier.

    The valid count is not part of this summary and counts as zero, so with the usual
    criteria every sample of the minimum size takes the fallback.
    """
    c = config.criteria
    if used < c.min_total_observations or used <= 0:
        return used >= c.min_total_observations and c.min_uncensored_weight >= 0
    return ((left + right) / used >= c.min_total_censored_ratio or left / used >= c.min_below_ratio
            or 0.0 <= c.max_valid_share or 0.0 <= c.min_uncensored_weight)


def _interpolated(v: np.ndarray, w: np.ndarray, probabilities: Sequence[float]) -> list[float]:
    """Linear in the cumulative weight between neighbours; equal values in order of weight."""
    order = np.lexsort((w, v))
    v, w = v[order], w[order]
    upto = np.cumsum(w)
    total, out = float(upto[-1]), []
    for p in probabilities:
        i = min(int(np.searchsorted(upto, p * total * (1 - 1e-12), side="left")), v.size - 1)
        before = upto[i] - w[i]
        out.append(float(v[i]) if i == 0 else float(v[i - 1] + min(1.0, (p * total - before) / w[i]) * (v[i] - v[i - 1])))
    return out


class _Records:
    """Arrays of one part in time order; records of the next part that blocks may run into come last."""

    def __init__(self, rows: pd.DataFrame, config: BootstrapConfig) -> None:
        rows = rows.sort_values(["after", "us", "tie"], kind="stable")
        column = lambda name: rows[name].to_numpy(dtype=float)
        self.config, self.own = config, int((~rows["after"].to_numpy(dtype=bool)).sum())
        self.after = len(rows) - self.own
        self.scale, self.length = float(rows["speed_scale"].iloc[0]), int(rows["block_length"].iloc[0])
        self.raw = column("raw")
        self.w_in, self.w_left, self.w_right, self.s_in = (column(c) for c in ("w_in", "w_left", "w_right", "s_in"))
        self.below, self.inside, self.above, self.used = (column(c) for c in ("pb", "pi", "pa", "used"))
        self.strata = rows["stratum"].to_numpy()[:self.own]

    def draws(self, cells: np.ndarray | None, part: int) -> Draws:
        if cells is None:
            cells = np.array([[int((self.strata == s).sum()) for s in STRATA]])
        return Draws(self.config, self.length, self.strata, cells, part, self.own, self.after)

    def _drawn(self, draws: Draws | None, replica: int) -> tuple:
        """Positions, clamped speeds, whether they are known, and where labels are redrawn their shares."""
        config, replicated = self.config, replica != BASELINE
        index, rng = draws.at(replica) if replicated else (np.arange(self.own), None)
        raw = self.raw[index]
        if replicated and config.apply_rmse_noise and config.rmse_mode == "velocity" and config.rmse > 0:
            limit = config.noise_truncation * config.rmse
            noise = rng.standard_normal(index.size)
            noise *= config.rmse
            raw += np.clip(noise, -limit, limit, out=noise)
            np.maximum(raw, 0.0, out=raw)
        speed = np.clip(raw, config.thresholds.lower, config.thresholds.upper, out=raw)
        known = ~np.isnan(speed)
        shares = None
        if replicated and config.label_strategy == "label_resample":
            b, i, a, used = (x[index] for x in (self.below, self.inside, self.above, self.used))
            uniform = rng.random(index.size)
            sure = (used > 0) & (np.maximum(np.maximum(b, i), a) >= config.min_confidence)
            is_b, is_i = uniform < b, (uniform >= b) & (uniform < b + i)
            shares = (*(np.where(sure, hit.astype(float), share) for hit, share in ((is_b, b), (is_i, i), (~is_b & ~is_i, a))), used)
        return index, speed, known, shares

    def sample(self, draws: Draws | None, replica: int = BASELINE) -> tuple:
        """Clamped speeds and weights of a replicate, or of the records themselves."""
        index, speed, known, shares = self._drawn(draws, replica)
        if shares is not None:
            b, i, a, used = shares
            w_in, w_left, w_right, s_in = np.where(known, i, 0.0), b, a, i
        else:
            w_in, w_left, w_right, s_in, used = (x[index] for x in (self.w_in, self.w_left, self.w_right, self.s_in, self.used))
        return np.where(known, speed, 0.0), w_in, w_left, w_right, s_in, used

    def weighted(self, draws: Draws | None, replica: int) -> tuple[np.ndarray, np.ndarray]:
        """Scaled speeds and in-range weights of a replicate's records that have such a weight."""
        index, speed, known, shares = self._drawn(draws, replica)
        w = self.w_in[index] if shares is None else np.where(known, shares[1], 0.0)
        some = w > 0
        return np.where(known, speed, 0.0)[some] * self.scale, w[some]


def _prepared(obs: DataFrame, config: BootstrapConfig, tie: str | None, settings: DataFrame | None = None) -> DataFrame:
    """Records with weights, posteriors, stratum; speeds stay raw because noise comes first.

    Without ``tie`` records of equal time are ordered by a hash of their values; those that agree in
    all of them are exchangeable.  ``settings`` has ``node_id`` and may have ``block_length`` and ``speed_scale``.
    """
    finite = is_finite(F.col("raw"))
    clamped = F.greatest(F.lit(config.thresholds.lower), F.least(F.lit(config.thresholds.upper), F.col("raw")))
    rows = with_posteriors(obs.withColumn("raw", numeric(obs, "pred_wind_speed")))
    label = F.lower(F.trim(F.col("range_flag").cast("string")))
    order = F.col(tie).cast("bigint") if tie else F.xxhash64("raw", label, "range_flag_confident", *posterior().values())
    rows = rows.select(
        "node_id", F.coalesce(micros(F.col("timestamp")), F.lit(0)).alias("us"), order.alias("tie"),
        F.when(finite, F.col("raw")).alias("raw"), F.when(finite, clamped).alias("v"),
        stratum(F.col("range_flag"), F.col("range_flag_confident"), posterior(), config.min_confidence).alias("stratum"),
        hard_label(F.col("range_flag"), F.col("range_flag_confident"), posterior(), config.min_confidence).alias("hard"),
        F.col("p_in").isNotNull().cast("double").alias("used"),
        *[F.coalesce(p, F.lit(0.0)).alias(n) for n, p in zip(("pb", "pi", "pa"), posterior().values())])
    # Records without a posterior are never evaluated but do take part in the draws.
    def weight(name, share):
        return F.when(F.col("used") == 0, 0.0).when(F.col("hard") == name, 1.0).when(
            F.col("hard").isNull(), F.col(share)).otherwise(0.0)

    rows = rows.withColumns({
        "s_in": weight("in", "pi"), "w_left": weight("below", "pb"), "w_right": weight("above", "pa"),
    }).withColumn("w_in", F.when(F.col("v").isNotNull(), F.col("s_in")).otherwise(0.0)).drop("hard")
    for name, value in (("block_length", config.block_length), ("speed_scale", config.speed_scale)):
        known = settings is not None and name in settings.columns
        rows = with_default(rows, settings, name, value) if known else rows.withColumn(name, F.lit(value))
    return rows.withColumns({"block_length": F.col("block_length").cast("int"), "speed_scale": F.col("speed_scale").cast("double")})


def replicate_table(obs: DataFrame, config: BootstrapConfig, tie: str | None = None, max_records: int | None = MAX_RECORDS_PER_TASK,
                    settings: DataFrame | None = None) -> DataFrame:
    """``(node_id, replica, metrics…)``; replica -1 is the estimate from the records themselves."""
    rows = _prepared(obs, config, tie, settings).drop("v")
    hot = hot_keys(rows, ["node_id"], max_records)
    if hot is None:
        return _finish(_one_part(rows, config), config)
    large = hot.select("node_id")
    small = _one_part(rows.join(large, "node_id", "left_anti"), config)
    return _finish(small.unionByName(_many_parts(rows.join(large, "node_id", "left_semi"), config, max_records)), config)


def _sums(sample: tuple, config: BootstrapConfig, scale: float) -> tuple:
    speed, w, w_left, w_right, s_in, used = sample
    v = speed * scale
    return (float(w.sum()), float(np.dot(w, v)), float(np.dot(w, v * v * v)), float(np.dot(w, w)),
            float(np.dot(w, (1.5 * config.air_density * v * v) ** 2)), float(w_left.sum()), float(w_right.sum()), float(s_in.sum()), float(used.sum()))


def _one_part(rows: DataFrame, config: BootstrapConfig) -> DataFrame:
    """Nodes that are one part: every replicate is finished where it is drawn."""
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        records = _Records(group, config)
        draws, out = records.draws(None, 0), []
        for replica in range(BASELINE, config.replicas):
            sample = records.sample(draws, replica)
            out.append((key[0], replica, *_sums(sample, config, records.scale), records.scale, *evaluate(*sample, config, records.scale)))
        return pd.DataFrame(out, columns=[f.strip().split(" ")[0] for f in _ROW.split(",")])

    return spread(rows.withColumn("after", F.lit(False)), "node_id").groupBy("node_id").applyInPandas(run, _ROW)


def _dealt(rows: DataFrame, config: BootstrapConfig, max_records: int) -> tuple[DataFrame, DataFrame]:
    """Records with their part, and one row per part with what its draws need: the sizes of all parts, and the edges of the node's histogram.

    The facts meet their part as the other side of a cogroup, so a record carries numbers only.
    """
    checkpoint_ready(rows.sparkSession)
    reach = RUN_ROOM if config.resampling == "stationary" else 1
    numbered = order_rows(rows, ["node_id"], ["us", "tie"]).running_sum(__n=F.lit(1)).dataframe()
    numbered = numbered.withColumns({"part": F.expr(f"cast((__n - 1) div {max_records} as int)"), "__off": (F.col("__n") - 1) % max_records})
    names = [F.count_if(F.col("stratum") == s).alias(f"n_{s}") for s in STRATA]
    cells = numbered.groupBy("node_id", "part").agg(*names).groupBy("node_id").agg(
        F.sort_array(F.collect_list(F.struct("part", *[f"n_{s}" for s in STRATA]))).alias("cells"))
    steps = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    edges = rows.groupBy("node_id").agg(F.array_distinct(F.percentile_approx("raw", steps, 20_000)).alias("edges"))
    known = cells.join(edges, "node_id").checkpoint()
    facts = known.select(F.col("node_id").alias("of_node"), F.explode("cells.part").alias("of_part"), "cells", "edges")
    room = F.when(F.col("block_length") > 1, F.col("block_length") * reach).otherwise(0) if config.resampling != "iid" else F.lit(0)
    both = numbered.join(known.select("node_id", F.size("cells").alias("__parts")), "node_id")
    before = F.pmod(F.col("part") - 1, F.col("__parts"))
    places = F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("after")), F.struct(before.cast("int").alias("part"), F.lit(True).alias("after")))
    chosen = F.when(F.col("__off") < room, places).otherwise(F.slice(places, 1, 1))
    dealt = both.withColumn("__p", F.explode(chosen)).withColumns({"part": F.col("__p.part"), "after": F.col("__p.after")}).drop("__p", "__n", "__off", "__parts")
    return spread(dealt, "node_id", "part"), facts


def _many_parts(rows: DataFrame, config: BootstrapConfig, max_records: int) -> DataFrame:
    """Nodes of several parts.  Two passes draw the same records: sums and histograms, then the values around the quantiles.

    What the passes return is read several times and costs all draws, so it is written down: a row per part and replicate,
    and a row per node and replicate.
    """
    dealt, facts = _dealt(rows, config, max_records)

    def start(group: pd.DataFrame, fact: pd.DataFrame):
        records = _Records(group, config)
        fact = fact.iloc[0]
        cells = np.array([list(c)[1:] if not isinstance(c, dict) else [c[f"n_{s}"] for s in STRATA] for c in fact["cells"]], dtype=np.int64)
        return records, records.draws(cells, int(fact["of_part"])), np.array(fact["edges"], dtype=float)

    def first(key: tuple, group: pd.DataFrame, fact: pd.DataFrame) -> pd.DataFrame:
        records, draws, edges = start(group, fact)
        out = []
        for replica in range(BASELINE, config.replicas):
            sample = records.sample(draws, replica)
            some = sample[1] > 0
            v, w = sample[0][some] * records.scale, sample[1][some]
            bins = np.searchsorted(edges * records.scale, v, side="right")
            top = np.full(edges.size + 1, -np.inf)
            np.maximum.at(top, bins, v)
            out.append((key[0], replica, *_sums(sample, config, records.scale), records.scale,
                        np.bincount(bins, weights=w, minlength=edges.size + 1), np.where(np.isfinite(top), top, np.nan)))
        return pd.DataFrame(out, columns=["node_id", "replica", *_SUMS, "scale", "mass", "top"])

    head = "node_id string, replica int, "
    partial = held(dealt.groupBy("node_id", "part").cogroup(facts.groupBy("of_node", "of_part")).applyInPandas(
        first, head + ", ".join(f"{s} double" for s in _SUMS) + ", scale double, mass array<double>, top array<double>"))
    key = ["node_id", "replica"]
    sums = partial.groupBy(*key).agg(*[F.sum(s).alias(s) for s in _SUMS], F.max("scale").alias("scale"))
    cell = partial.select(*key, F.posexplode(F.arrays_zip("mass", "top")).alias("bin", "m")).groupBy(*key, "bin").agg(
        F.sum("m.mass").alias("mass"), F.max(F.nanvl("m.top", F.lit(None).cast("double"))).alias("top"))
    line = Window.partitionBy(*key).orderBy("bin")
    run = cell.where("mass > 0").withColumns({
        "upto": F.sum("mass").over(line), "prev": F.lag("top").over(line), "total": F.sum("mass").over(Window.partitionBy(*key))})
    ask = []
    for name, p in QUANTILES.items():
        hit = F.col("upto") >= F.col("total") * p * (1 - 1e-12)
        ask += [F.min(F.when(hit, F.struct("bin", (F.col("upto") - F.col("mass")).alias("base"), "prev", "total"))).alias(name)]
    forced = _forced(config, F.col("used"), F.col("wl"), F.col("wr"))
    asked = held(sums.join(run.groupBy(*key).agg(*ask), key, "left").withColumn("whole", ~forced))
    fitted = not asked.where("whole").isEmpty()

    def second(key: tuple, group: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(group):
            fact = wanted["edges"].notna()
            records, draws, edges = start(group, wanted[fact])
            ends = np.concatenate([[-np.inf], edges * records.scale, [np.inf]])
            for row in wanted[~fact].itertuples(index=False):
                v, w = records.weighted(draws, int(row.replica))
                if not row.whole:
                    keep = np.zeros(v.size, bool)
                    for b in {int(b) for b in (row.b50, row.b90, row.b99) if b is not None and b == b}:
                        keep |= (v >= ends[b]) & (v < ends[b + 1])
                    v, w = v[keep], w[keep]
                v, w, count = _counted(v, w)
                out.append(pd.DataFrame({"node_id": row.node_id, "replica": row.replica, "v": v, "w": w, "bin": np.searchsorted(ends[1:-1], v, side="right"), "n": count}))
        return pd.concat(out) if out else pd.DataFrame(columns=["node_id", "replica", "v", "w", "bin", "n"])

    wanted = asked.select(*key, "whole", *[F.col(f"{n}.bin").alias(f"b{n[1:]}") for n in QUANTILES]).join(
        facts.select(F.col("of_node").alias("node_id"), "of_part"), "node_id")
    wanted = wanted.unionByName(facts.withColumnRenamed("of_node", "node_id"), allowMissingColumns=True)
    values = dealt.groupBy("node_id", "part").cogroup(wanted.groupBy("node_id", "of_part")).applyInPandas(
        second, head + "v double, w double, bin int, n long")
    if fitted:
        values = held(values)

    def settle(key: tuple, found: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = list(key)
        for name, p in QUANTILES.items():
            want = wanted[name].iloc[0] if len(wanted) else None
            if want is None:
                out.append(None)
                continue
            b, base, prev, total = (want[f] for f in ("bin", "base", "prev", "total"))
            rows = found[found["bin"] == b].sort_values(["v", "w"])
            v, w, n = (rows[c].to_numpy() for c in ("v", "w", "n"))
            upto = base + np.cumsum(w * n)
            i = min(int(np.searchsorted(upto, p * total * (1 - 1e-12), side="left")), v.size - 1)
            before = upto[i] - w[i] * n[i]
            first = before + w[i] >= p * total * (1 - 1e-12)
            earlier = v[i] if not first else v[i - 1] if i else prev
            out.append(float(v[i]) if earlier is None or earlier != earlier or earlier == v[i]
                       else float(earlier + min(1.0, (p * total - before) / w[i]) * (v[i] - earlier)))
        return pd.DataFrame([out], columns=["node_id", "replica", *QUANTILES])

    quantiles = spread(values, *key).groupBy(*key).cogroup(asked.select(*key, *QUANTILES).groupBy(*key)).applyInPandas(
        settle, head + ", ".join(f"{n} double" for n in QUANTILES))
    out = asked.drop(*QUANTILES).join(quantiles, key, "left")
    total = F.col("wi") + F.col("wl") + F.col("wr")
    lower, upper = config.thresholds.lower, config.thresholds.upper
    tail = config.tail_surrogate if config.tail_surrogate is not None else upper
    cube = F.pow("scale", F.lit(3))
    cubes = (F.col("wvvv") + F.col("wl") * lower**3 * cube + F.col("wr") * tail**3 * cube) / total
    km = F.when((total > 0) & (cubes > 0), 0.5 * config.air_density * cubes)
    names = [f.strip().split(" ")[0] for f in _ROW.split(",")]
    if not fitted:
        return out.withColumns({"power_density": km, "method": F.lit("kaplan_meier")}).select(*names)
    sides = asked.where("whole").select(*key, F.explode(F.array(
        F.struct(F.lit("left").alias("kind"), F.lit(config.thresholds.lower).alias("value"), F.col("wl").alias("weight")),
        F.struct(F.lit("right").alias("kind"), F.lit(config.thresholds.upper).alias("value"), F.col("wr").alias("weight")))).alias("p")).select(*key, "p.*")
    inside = values.join(asked.where("whole").select(*key, "scale"), key).groupBy(*key, F.lit("in").alias("kind"), (F.col("v") / F.col("scale")).alias("value")).agg(
        F.sum(F.col("w") * F.col("n")).alias("weight"))
    fits = fit_weibull(inside.unionByName(sides).where("weight > 0"), key, config.min_in_range_weight).select(
        *key, "weibull_shape", "weibull_scale", (F.col("weibull_success") & F.col("weibull_reliable")).alias("sound"))
    out = out.join(fits, key, "left")
    weibull = F.col("whole") & F.coalesce("sound", F.lit(False)) & (F.col("wi") >= config.min_in_range_weight)
    density = 0.5 * config.air_density * F.pow(F.col("weibull_scale") * F.col("scale"), F.lit(3)) * F.exp(log_gamma_of(1.0 + 3.0 / F.col("weibull_shape")))
    return out.withColumns({
        "power_density": F.when(weibull, density).otherwise(km), "method": F.when(weibull, "weibull").otherwise("kaplan_meier"),
    }).select(*names)


def _counted(v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in order, and how often each occurs."""
    order = np.lexsort((w, v))
    v, w = v[order], w[order]
    first = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])][:v.size])
    return v[first], w[first], np.diff(np.r_[first, v.size])


def _forced(config: BootstrapConfig, used, left, right):
    """The column form of ``_fallback``."""
    c = config.criteria
    mix = ((left + right) / used >= c.min_total_censored_ratio) | (left / used >= c.min_below_ratio) | F.lit(
        0.0 <= c.max_valid_share or 0.0 <= c.min_uncensored_weight)
    few = (used < c.min_total_observations) | (used <= 0)
    return F.when(few, (used >= c.min_total_observations) & F.lit(c.min_uncensored_weight >= 0)).otherwise(mix)


def _finish(rows: DataFrame, config: BootstrapConfig) -> DataFrame:
    """Mean, standard error of the density and, where asked for, its noise; a replicate without error takes the baseline's."""
    own = F.when((F.col("wi") > 0) & (F.col("w4") > 0) & F.lit(config.rmse > 0),
                 config.rmse * F.sqrt((F.col("w4") / F.col("wi")) / (F.col("wi") * F.col("wi") / F.col("ww"))))
    base = F.max(F.when(F.col("replica") == BASELINE, own)).over(Window.partitionBy("node_id"))
    out = rows.withColumns({"mean_speed": F.try_divide("wv", "wi"), "sigma": F.coalesce(own, base), "clamped": F.lit(0)})
    if config.apply_rmse_noise and config.rmse_mode == "power":
        seed = config.seed

        @F.pandas_udf("double")
        def gauss(replica: pd.Series) -> pd.Series:
            return replica.map(lambda r: np.random.default_rng([seed, 9, int(r)]).standard_normal() if r >= 0 else 0.0)

        moved = F.col("power_density") + gauss("replica") * F.coalesce("sigma", F.lit(0.0))
        out = out.withColumn("__moved", moved).withColumns({
            "clamped": F.coalesce((F.col("__moved") < 0).cast("int"), F.lit(0)),
            "power_density": F.greatest("__moved", F.when(F.col("__moved").isNotNull(), 0.0))})
    return out.select("node_id", "replica", *METRICS, "sigma", "method", "clamped")


# -- delete-one values -------------------------------------------------------------
def jackknife(obs: DataFrame, config: BootstrapConfig, tie: str | None = None, settings: DataFrame | None = None) -> DataFrame:
    """``(node_id, metric, n, d1, d2, d3, estimator)``: power sums of the delete-one values' distances from the full value, for any number of records.

    Mean and density follow from the totals minus one record.  A delete-one quantile is a look-up among the records
    whose cumulative weight is within two records of the quantile; no weight exceeds one, so that
    list is short whatever the node's size.  Where the records let the Weibull fit decide, the density's values are
    those of the fit without a record (``influence.py``); ``estimator`` says which a density has.
    """
    rows = _prepared(obs, config, tie, settings)
    v, w = F.coalesce(F.col("v"), F.lit(0.0)) * F.col("speed_scale"), F.col("w_in")
    lower, upper = config.thresholds.lower, config.thresholds.upper
    tail = config.tail_surrogate if config.tail_surrogate is not None else upper
    cube = F.pow("speed_scale", F.lit(3))
    own = w * v * v * v + (F.col("w_left") * lower**3 + F.col("w_right") * tail**3) * cube
    rows = rows.select("node_id", "us", "tie", v.alias("v"), w.alias("w"), (w + F.col("w_left") + F.col("w_right")).alias("t"), own.alias("c"))
    inside = order_rows(rows.where("w > 0"), ["node_id"], ["v", "w", "us", "tie"], hold=True).running_sum(upto=F.col("w")).dataframe()
    totals = rows.groupBy("node_id").agg(*[F.sum(x).alias(f"__{x}") for x in ("w", "t", "c")], F.sum(F.col("w") * F.col("v")).alias("__wv"), F.count(F.lit(1)).alias("__n"))
    near = inside.join(totals.select("node_id", F.col("__w").alias("all_w")), "node_id")
    lists = near.groupBy("node_id").agg(*[
        F.sort_array(F.collect_list(F.when(F.abs(F.col("upto") - F.col("all_w") * p) <= 2.0 + 1e-9 * F.col("all_w"), F.struct("upto", "v", "w")))).alias(f"near_{n}")
        for n, p in QUANTILES.items()])
    parts = F.greatest(F.lit(1), F.ceil(F.col("__n") / MAX_RECORDS_PER_TASK)).cast("int")
    facts = totals.withColumn("parts", parts).join(lists, "node_id", "left")
    rest = rows.where("w <= 0").withColumn("upto", F.lit(None).cast("double"))
    every = inside.unionByName(rest).join(totals.select("node_id", parts.alias("parts")), "node_id").withColumn(
        "part", F.pmod(F.xxhash64("us", "tie", "v"), F.col("parts")).cast("int")).drop("parts")
    per_part = facts.withColumn("of_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts").withColumn(
        "node_id", F.concat("node_id", F.lit("")))  # a column of its own, for the cogroup

    def values(key: tuple, g: pd.DataFrame, facts: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(g):
            one = facts.iloc[0]
            W, T, C, WV = (float(one[f"__{x}"]) for x in ("w", "t", "c", "wv"))
            density = 0.5 * config.air_density
            x = {"mean_speed": _ratio(WV - (g["w"] * g["v"]).to_numpy(), W - g["w"].to_numpy()),
                 "power_density": density * _ratio(C - g["c"].to_numpy(), T - g["t"].to_numpy())}
            full = {"mean_speed": WV / W if W > 0 else math.nan, "power_density": density * C / T if T > 0 else math.nan}
            for n, p in QUANTILES.items():
                near = one[f"near_{n}"]
                cells = np.array([(r["upto"], r["v"], r["w"]) for r in near]).reshape(-1, 3) if near is not None else np.zeros((0, 3))
                full[n], x[n] = _without_one(cells, g["upto"].to_numpy(float), g["w"].to_numpy(float), p, W)
            for m in METRICS:
                d = x[m] - full[m]
                out.append((key[0], m, len(d), float(d.sum()), float((d**2).sum()), float((d**3).sum())))
        return pd.DataFrame(out, columns=["node_id", "metric", "n", "d1", "d2", "d3"])

    made = every.groupBy("node_id", "part").cogroup(per_part.groupBy("node_id", "of_part")).applyInPandas(
        values, "node_id string, metric string, n long, d1 double, d2 double, d3 double")
    density = F.col("metric") == "power_density"
    out = made.groupBy("node_id", "metric").agg(*[F.sum(c).alias(c) for c in ("n", "d1", "d2", "d3")]).withColumn(
        "estimator", F.when(density, "kaplan_meier"))
    fitted = weibull_jackknife(obs, config, tie, settings)
    if fitted is None:
        return out
    fitted = fitted.withColumns({"metric": F.lit("power_density"), "estimator": F.lit("weibull")})
    return out.join(fitted.select("node_id", "metric"), ["node_id", "metric"], "left_anti").unionByName(fitted)


def weibull_jackknife(obs: DataFrame, config: BootstrapConfig, tie: str | None = None, settings: DataFrame | None = None,
                      reliable: bool = True) -> DataFrame | None:
    """Power sums of delete-one densities of the nodes estimated by Weibull; None where the settings admit no such node.

    ``reliable=False`` also takes nodes whose fit reached its last iteration, which the estimates leave to Kaplan-Meier.
    """
    c = config.criteria
    if (0.0 <= c.max_valid_share or 0.0 <= c.min_uncensored_weight) and config.min_in_range_weight >= c.min_total_observations:
        return None
    prepared = _prepared(obs, config, tie, settings)
    lower, upper = config.thresholds.lower, config.thresholds.upper
    merged = held(prepared.groupBy("node_id", "v").agg(*[F.sum(x).alias(x) for x in ("w_in", "w_left", "w_right", "used")]))
    totals = merged.groupBy("node_id").agg(*[F.sum(x).alias(x) for x in ("w_in", "w_left", "w_right", "used")])
    admitted = totals.where(~_forced(config, F.col("used"), F.col("w_left"), F.col("w_right")) & (F.col("w_in") >= config.min_in_range_weight))
    sides = admitted.select("node_id", F.explode(F.array(
        F.struct(F.lit("left").alias("kind"), F.lit(lower).alias("value"), F.col("w_left").alias("weight")),
        F.struct(F.lit("right").alias("kind"), F.lit(upper).alias("value"), F.col("w_right").alias("weight")))).alias("p")).select("node_id", "p.*")
    inside = merged.join(admitted.select("node_id"), "node_id").select("node_id", F.lit("in").alias("kind"), F.col("v").alias("value"), F.col("w_in").alias("weight"))
    sample = held(inside.unionByName(sides).where(F.col("value").isNotNull() & (F.col("weight") > 0)))
    fits = fit_weibull(sample, ["node_id"], config.min_in_range_weight).where(
        F.col("weibull_shape").isNotNull() & ((F.col("weibull_success") & F.col("weibull_reliable")) | F.lit(not reliable)))
    return delete_one_density(prepared, sample, held(fits.select("node_id", "weibull_shape", "weibull_scale")), lower, upper, config.air_density)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(b > 0, a / b, np.nan)


def _without_one(near: np.ndarray, upto: np.ndarray, weight: np.ndarray, p: float, total: float) -> tuple[float, np.ndarray]:
    """A quantile, and its value without each record; ``near`` holds (cumulative weight, value, weight) around it."""
    if not len(near):
        return math.nan, np.full(len(weight), math.nan)
    c, v, w = near.T

    def look(target: np.ndarray, shift: np.ndarray, gone: np.ndarray) -> np.ndarray:
        """First record whose shifted cumulative weight reaches the target, the record ``gone`` left out."""
        i = np.minimum(np.searchsorted(c, target + shift - 1e-12 * total, side="left"), len(c) - 1)
        i = np.where((i == gone) & (i + 1 < len(c)), i + 1, np.where(i == gone, i - 1, i))
        before = np.where(i - 1 == gone, i - 2, i - 1)
        prev = np.maximum(before, 0)
        part = np.clip((target + shift - (c[i] - w[i])) / w[i], 0.0, 1.0)
        return np.where(before < 0, v[i], v[prev] + part * (v[i] - v[prev]))

    none = np.full(1, -9)
    full = float(look(np.array([p * total]), np.zeros(1), none)[0])
    inside = weight > 0
    out = np.full(len(weight), full)
    u, x = upto[inside], weight[inside]
    target = p * (total - x)
    mine = np.searchsorted(c, u - 1e-12 * total, side="left")
    mine = np.where((mine < len(c)) & (np.abs(c[np.minimum(mine, len(c) - 1)] - u) <= 1e-9 * total), mine, -9)
    later = u - x >= target - 1e-12 * total  # the quantile comes before the record
    out[inside] = np.where(later, look(target, np.zeros(len(x)), np.where(later, mine, -9)), look(target, x, np.where(later, -9, mine)))
    return full, out


# -- intervals ---------------------------------------------------------------------
def bootstrap_intervals(obs: DataFrame, config: BootstrapConfig, tie: str | None = None, max_records: int | None = MAX_RECORDS_PER_TASK,
                        settings: DataFrame | None = None) -> DataFrame:
    """``(node_id, metric, estimate, lower, upper, replicates, bootstrap_estimate, ci_method)``."""
    return intervals_of(replicate_table(obs, config, tie, max_records, settings), config,
                        None if config.ci_method == "percentile" else jackknife(obs, config, tie, settings)).drop("power_method")


def intervals_of(replicates: DataFrame, config: BootstrapConfig, delete_one: DataFrame | None = None) -> DataFrame:
    """Intervals from the table of replicates, one aggregate per node and metric; a list holds one value per replicate.

    With perturbed speeds the replicates are moved so that their mean is the estimate.  BCa and percentile-t take the power
    sums of ``jackknife``.  A metric without them, and a density whose sums are not of the estimator that made the
    estimate, have percentile bounds and say so in ``ci_method``.
    """
    entry = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]))
    drawn = F.col("replica") >= 0
    rows = replicates.select("node_id", "replica", "method", entry.alias("e")).select("node_id", "replica", "method", "e.*").groupBy("node_id", "metric").agg(
        F.max(F.when(~drawn, F.col("value"))).alias("estimate"), F.max(F.when(~drawn, F.col("method"))).alias("power_method"),
        F.sort_array(F.collect_list(F.when(drawn, F.col("value")))).alias("draws"))
    size = F.size("draws")
    mean = F.when(size > 0, F.aggregate("draws", F.lit(0.0), lambda s, x: s + x) / size)
    rows = rows.withColumn("__mean", mean)
    if config.apply_rmse_noise and config.rmse_mode == "velocity":
        shift = F.coalesce(F.col("__mean") - F.col("estimate"), F.lit(0.0))
        low = F.when(F.col("metric") == "power_density", 0.0).otherwise(float("-inf"))
        rows = rows.withColumns({"__shift": shift, "__low": low})
        rows = rows.withColumn("draws", F.transform("draws", lambda x: F.greatest(x - F.col("__shift"), F.col("__low")))).withColumn("__mean", mean)
    alpha = 1.0 - config.confidence
    ends = {"lower": F.lit(alpha / 2), "upper": F.lit(1 - alpha / 2)}
    method = F.lit("percentile")
    if delete_one is not None:
        rows = rows.join(delete_one, ["node_id", "metric"], "left")
        refined = refined_levels(config.ci_method, alpha)("estimate", "draws", "n", "d1", "d2", "d3")
        usable = F.col("n").isNotNull() & (F.col("n") > 1) & ~F.isnan("d2") & (F.col("estimator").isNull() | (F.col("estimator") == F.col("power_method")))
        rows = rows.withColumn("__ends", F.when(usable, refined)).withColumn("__sound", F.col("__ends.first").isNotNull())
        method = F.when(F.col("__sound"), config.ci_method).otherwise("percentile")
    known = F.col("estimate").isNotNull() & (size > 0)
    out = {}
    for name, level in ends.items():
        plain = _at_level(F.col("draws"), level)
        if delete_one is not None:
            part = F.col("__ends.first" if name == "lower" else "__ends.second")
            plain = F.when(F.col("__sound"), _at_level(F.col("draws"), part) if config.ci_method == "bca" else part).otherwise(plain)
        out[name] = F.when(known, plain)
    return rows.select("node_id", "metric", "estimate", *[c.alias(n) for n, c in out.items()], size.cast("bigint").alias("replicates"),
                       F.when(known, F.col("__mean")).otherwise(F.col("estimate")).alias("bootstrap_estimate"), method.alias("ci_method"), "power_method")


def _at_level(draws, level):
    """Linear interpolation in a sorted list."""
    place = level * (F.size(draws) - 1)
    low = F.floor(place).cast("int")
    a, b = F.get(draws, low), F.get(draws, F.least(low + 1, F.size(draws) - 1))
    return a + (b - a) * (place - low)


def refined_levels(method: str, alpha: float):
    """BCa: the two levels at which to read the replicates.  Percentile-t: the two bounds.

    With z0 the normal score of the share of replicates below the estimate and a the sixth of the skewness of the
    delete-one values, the BCa level of z is Phi(z0 + (z0 + z) / (1 - a (z0 + z))); where 1 - a (z0 + z) is not positive the
    level is the limit, 0 or 1 by the sign of z0 + z.
    """
    normal = NormalDist()
    scores = normal.inv_cdf(alpha / 2), normal.inv_cdf(1 - alpha / 2)

    def bounds(estimate: float, draws: np.ndarray, n: float, s1: float, s2: float, s3: float):
        m = s1 / n
        second, third = s2 - n * m * m, s3 - 3 * m * s2 + 2 * n * m**3
        if method == "percentile_t":
            if second <= 0:
                return None, None
            error = math.sqrt((n - 1) / n * second)
            t = (draws - estimate) / error
            return estimate - np.quantile(t, 1 - alpha / 2) * error, estimate - np.quantile(t, alpha / 2) * error
        share = (np.count_nonzero(draws < estimate) + np.count_nonzero(draws == estimate) / 2) / draws.size
        z0 = normal.inv_cdf(min(max(share, 1e-10), 1 - 1e-10))
        a = -third / (6 * second**1.5) if second > 0 else 0.0
        levels = []
        for z in scores:
            slope = 1 - a * (z0 + z)
            levels.append(normal.cdf(z0 + (z0 + z) / slope) if slope > 0 else float(z0 + z > 0))
        return levels[0], levels[1]

    @F.pandas_udf("first double, second double")
    def udf(estimate: pd.Series, draws: pd.Series, n: pd.Series, d1: pd.Series, d2: pd.Series, d3: pd.Series) -> pd.DataFrame:
        out = [bounds(e, np.asarray(d, float), *s) if d is not None and len(d) and e == e and s[0] == s[0] and s[0] > 1 and s[1] == s[1] else (None, None)
               for e, d, s in zip(estimate, draws, zip(n, d1, d2, d3))]
        return pd.DataFrame(out, columns=["first", "second"], dtype=float)

    return udf


def bootstrap_summary(obs: DataFrame, config: BootstrapConfig, tie: str | None = None, max_records: int | None = MAX_RECORDS_PER_TASK,
                      settings: DataFrame | None = None) -> DataFrame:
    """One wide row per node: label counts and shares, every metric's interval, methods used, notes."""
    # The intervals and the notes on methods read the table, whose rows cost all draws.
    replicates = held(replicate_table(obs, config, tie, max_records, settings))
    intervals = intervals_of(replicates, config, None if config.ci_method == "percentile" else jackknife(obs, config, tie, settings))
    entries = {}
    for m in METRICS:
        hit = F.col("metric") == m
        for part in ("estimate", "lower", "upper", "replicates", "bootstrap_estimate"):
            entries[f"{m}_{part}"] = F.max(F.when(hit, F.col(part)))
    fell_back = F.array_sort(F.collect_set(F.when(F.col("ci_method") != config.ci_method, F.col("metric"))))
    wide = intervals.groupBy("node_id").agg(*[c.alias(n) for n, c in entries.items()], fell_back.alias("__plain"))
    label = stratum(F.col("range_flag"), F.col("range_flag_confident"), posterior(), config.min_confidence)
    counts = with_posteriors(obs).select("node_id", label.alias("s")).groupBy("node_id").agg(
        F.count(F.lit(1)).alias("total_samples"),
        *[F.count_if(F.col("s") == s).alias(f"label_count_{s}") for s in STRATA])
    for s in STRATA:
        counts = counts.withColumn(f"label_ratio_{s}", F.col(f"label_count_{s}") / F.col("total_samples"))
    methods = replicates.groupBy("node_id").agg(
        F.max(F.when(F.col("replica") == BASELINE, F.col("method"))).alias("power_method"),
        F.count_if((F.col("replica") >= 0) & (F.col("method") == "weibull")).alias("replicate_method_weibull"),
        F.count_if((F.col("replica") >= 0) & (F.col("method") == "kaplan_meier")).alias("replicate_method_kaplan_meier"),
        F.sum("clamped").alias("power_clamped_draws"))
    out = counts.join(wide, "node_id").join(methods, "node_id").withColumn("rmse_value", F.lit(config.rmse))
    notes = F.concat_ws(
        " | ",
        F.when(F.size("__plain") > 0, F.concat(F.lit("percentile bounds for "), F.array_join("__plain", ", "))),
        F.when(F.col("power_clamped_draws") > 0, F.concat(F.col("power_clamped_draws").cast("string"), F.lit(" densities set to zero"))),
        F.when((F.col("replicate_method_weibull") > 0) & (F.col("replicate_method_kaplan_meier") > 0), F.lit("replicates use both estimators")))
    return out.withColumn("notes", notes).drop("__plain")
