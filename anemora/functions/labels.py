"""Range labels: spellings, physical thresholds, posterior weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.config import RangeThresholds

# Canonical labels and accepted spellings.
LABELS = ("below", "in", "above", "uncertain")
ALIASES = {
    "inside": "in",
    "within": "in",
    "in_range": "in",
    "below_range": "below",
    "under": "below",
    "left": "below",
    "over": "above",
    "upper": "above",
    "right": "above",
    "unknown": "uncertain",
    "nan": "uncertain",
}


def _spellings(label: str) -> list[str]:
    return [label, *[alias for alias, target in ALIASES.items() if target == label]]


def _canonical(text: Column) -> Column:
    out = F.when(text.isin(_spellings("in")), "in")
    out = out.when(text.isin(_spellings("below")), "below")
    out = out.when(text.isin(_spellings("above")), "above")
    return out.otherwise("uncertain")


def label_untrimmed(raw: Column) -> Column:
    """Canonical label as the relational stages see it: case folds, blanks count."""
    return _canonical(F.lower(raw))


def label(raw: Column) -> Column:
    """Canonical label after trimming and case folding."""
    return _canonical(F.lower(F.trim(raw)))


def is_unrecognised(raw: Column) -> Column:
    """The label is uncertain without saying so."""
    text = F.lower(raw)
    known = [s for name in LABELS for s in _spellings(name)]
    return raw.isNull() | ~text.isin(known)


def expected_label(speed: Column, bounds: RangeThresholds) -> Column:
    """Label implied by the speed; both bounds belong to the censored side."""
    return (
        F.when(speed.isNull() | F.isnan(speed), "uncertain")
        .when(speed <= bounds.lower, "below")
        .when(speed >= bounds.upper, "above")
        .otherwise("in")
    )


def probability(value: Column) -> Column:
    number = F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.greatest(F.least(number, F.lit(1.0)), F.lit(0.0))


def with_posteriors(df: DataFrame, below: str = "prob_range_below", inside: str = "prob_range_in",
                    above: str = "prob_range_above") -> DataFrame:
    """Add ``p_below, p_in, p_above``: clamped and normalised to one, null where they sum to nothing.

    The result passes through a one-element generator.  Later predicates on anything derived
    from the posteriors stop there; pushed further down they would carry a copy of the whole
    arithmetic for every mention.  Predicates on stored columns still reach the scan.
    """
    parts = {"p_below": below, "p_in": inside, "p_above": above}
    out = df.withColumns({f"__{name}": probability(F.col(source)) for name, source in parts.items()})
    out = out.withColumn("__mass", F.col("__p_below") + F.col("__p_in") + F.col("__p_above"))
    shares = F.struct(*[F.when(F.col("__mass") > 0, F.col(f"__{name}") / F.col("__mass")).alias(name) for name in parts])
    return out.withColumn("__p", F.explode(F.array(shares))).select(*df.columns, "__p.*")


def posterior() -> dict[str, Column]:
    """The columns added by :func:`with_posteriors`."""
    return {"below": F.col("p_below"), "in": F.col("p_in"), "above": F.col("p_above")}


def hard_label(flag: Column, confident: Column, posterior: dict[str, Column], min_confidence: float) -> Column:
    """The flag where it is confident and its posterior agrees, else null."""
    text = F.lower(F.trim(flag))
    sure = F.coalesce(confident, F.lit(False))
    out = F.when(sure & (text == "in") & (posterior["in"] >= min_confidence), "in")
    out = out.when(sure & (text == "below") & (posterior["below"] >= min_confidence), "below")
    return out.when(sure & (text == "above") & (posterior["above"] >= min_confidence), "above")


def stratum(flag: Column, confident: Column, posterior: dict[str, Column], min_confidence: float) -> Column:
    """Stratum of a record: its hard label, else the likeliest class if likely enough."""
    p = {name: F.coalesce(value, F.lit(0.0)) for name, value in posterior.items()}
    best = F.greatest(p["below"], p["in"], p["above"])
    likeliest = F.when(p["below"] == best, "below").when(p["in"] == best, "in").otherwise("above")
    return F.coalesce(
        hard_label(flag, confident, p, min_confidence),
        F.when(best >= min_confidence, likeliest).otherwise("uncertain"),
    )
