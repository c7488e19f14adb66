"""Quality vectors, credibility and score variants as Column expressions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Component weights and class limits.
WEIGHTS = {"completeness": 0.25, "credibility": 0.25, "physics_consistency": 0.20, "error_magnitude": 0.15, "smoothness": 0.10, "metadata": 0.05}
CLASS_LIMITS = (0.90, 0.80, 0.65, 0.50)


def check_weights(weights: Mapping[str, float], tolerance: float = 1e-6) -> None:
    if abs(math.fsum(weights.values()) - 1) > tolerance:
        raise ValueError(f"weights sum to {math.fsum(weights.values())}, not 1")


def _total(parts: Sequence[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def entropy(components: Sequence[Column]) -> Column:
    return _total([F.when(q > 0, -q * F.ln(q)).otherwise(0.0) for q in components])


def quality_class(score: Column) -> Column:
    a, b, c, d = CLASS_LIMITS
    return F.when(score >= a, 1).when(score >= b, 2).when(score >= c, 3).when(score >= d, 4).otherwise(5)


def quality(components: Mapping[str, Column], gate: Column, lam: float, weights: Mapping[str, float] = WEIGHTS) -> dict[str, Column]:
    """Base score, entropy, regularised score and class of a quality vector.

    A component that is null, NaN or outside [0, 1] is an error, tested before the gate; a closed gate gives zeros and class 5.
    """
    check_weights(weights)
    parts = [components[k] for k in weights]
    valid = F.lit(True)
    for q in parts:
        valid = valid & F.coalesce((q >= 0) & (q <= 1), F.lit(False))
    base = _total([F.lit(w) * components[k] for k, w in weights.items()])
    h = entropy(parts)
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), base - lam * h))
    open_ = valid & gate
    pick = lambda c, shut: F.when(open_, c).when(valid, shut)
    return {
        "base_score": pick(base, F.lit(0.0)),
        "entropy": pick(h, F.lit(0.0)),
        "score": pick(score, F.lit(0.0)),
        "quality_class": pick(quality_class(score), F.lit(5)),
        "error_code": F.when(~valid, "COMPONENT_OUT_OF_RANGE"),
    }


def credibility(w_source: Column, n_rep: Column, w_unc: Column, delta: Column, n: Column, e_cv: Column, age: Column, alpha: float, n0: float, beta: float, lam: float) -> Column:
    """Product of source, repetition, uncertainty, physics, statistics, model and age weights, clipped to [0, 1]; null on invalid input."""
    rep = F.when(n_rep >= 1, 1 - F.exp(-n_rep.cast("double"))).otherwise(0.0)
    phys = F.when(delta > 0, F.exp(-alpha * delta)).otherwise(1.0)
    stat = n / (n + n0)
    model = F.exp(-beta * e_cv)
    time = F.exp(-lam * F.greatest(F.lit(0.0), age))
    ok = w_source.between(0, 1) & w_unc.between(0, 1) & (n_rep >= 0) & (n >= 0) & (e_cv >= 0)
    return F.when(ok, F.greatest(F.lit(0.0), F.least(F.lit(1.0), w_source * rep * w_unc * phys * stat * model * time)))


def credibility_class(c: Column) -> Column:
    return F.when(c >= 0.90, "A").when(c >= 0.75, "B").when(c >= 0.50, "C").otherwise("D")


def score_linear(parts: Mapping[str, Column], gate: Column, weights: Mapping[str, float] = WEIGHTS) -> Column:
    return F.when(gate, _total([F.lit(w) * parts[k] for k, w in weights.items()])).otherwise(0.0)


def score_multiplicative(parts: Mapping[str, Column], gate: Column, weights: Mapping[str, float] = WEIGHTS) -> Column:
    out = F.lit(1.0)
    for k, w in weights.items():
        out = out * F.pow(parts[k], F.lit(w))
    return F.when(gate, out).otherwise(0.0)


def score_entropy(parts: Mapping[str, Column], gate: Column, lam: float, weights: Mapping[str, float] = WEIGHTS) -> Column:
    raw = _total([F.lit(w) * parts[k] for k, w in weights.items()]) - lam * entropy([parts[k] for k in weights])
    return F.when(gate, F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))).otherwise(0.0)


def score_risk(parts: Mapping[str, Column], sigmas: Mapping[str, Column], gate: Column, gamma: float, weights: Mapping[str, float] = WEIGHTS) -> Column:
    mean = _total([F.lit(w) * parts[k] for k, w in weights.items()])
    spread = F.sqrt(_total([F.lit(w * w) * sigmas[k] * sigmas[k] for k, w in weights.items()]))
    return F.when(gate, F.greatest(F.lit(0.0), F.least(F.lit(1.0), mean - gamma * spread))).otherwise(0.0)


def dominates(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """a is at least b in every component and above it in one."""
    least, above = F.lit(True), F.lit(False)
    for x, y in zip(a, b, strict=True):
        least, above = least & (x >= y), above | (x > y)
    return least & above
