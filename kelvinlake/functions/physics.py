"""Thermoelectric physics as Column expressions: everything stays inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvinlake.functions import constants as K

INF = float("inf")


def finite(c: Column) -> Column:
    """Not null, not NaN, not infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < INF)


def null_if_not_finite(c: Column) -> Column:
    return F.when(finite(c), c)


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def zt(s: Column, sigma: Column, kappa: Column, t: Column) -> Column:
    return s * s * sigma * t / kappa


def audit_columns(s: Column, sigma: Column, kappa: Column, t: Column, zt_reported: Column) -> dict[str, Column]:
    """The three-gate audit of a state: computed values, tier 1 (A) to 4 (reject), and anomaly flags.

    Gate 1 rejects what is null, not finite or not positive (T, sigma, kappa); gate 1b what exceeds the absolute bounds, first hit only.
    Rejected states have null values. A temperature outside the range costs tier C, a Lorenz number outside its
    range tier B, a negative lattice part tier C, a reported zT more than 10 % off tier C; each sets its bit.
    """
    b = K.BIT
    algebraic = all_of(finite(s), finite(sigma), finite(kappa), finite(t)) & (t > 0) & (sigma > 0) & (kappa > 0)
    bound = F.when(F.abs(s) > K.S_MAX, b["SEEBECK_BOUND_EXCEED"]).when(sigma > K.SIGMA_MAX, b["SIGMA_BOUND_EXCEED"]).when(kappa > K.KAPPA_MAX, b["KAPPA_BOUND_EXCEED"])
    passes = F.coalesce(algebraic, F.lit(False)) & bound.isNull()
    lorenz = kappa / (sigma * t)
    lattice = kappa - F.lit(K.L0) * sigma * t
    value = zt(s, sigma, kappa, t)
    error = F.when(passes & finite(zt_reported) & (F.abs(zt_reported) > K.EPSILON), F.abs(value - zt_reported) / F.abs(zt_reported))
    hot = passes & ((t < K.T_MIN) | (t > K.T_MAX))
    off = passes & ((lorenz < K.L_MIN) | (lorenz > K.L_MAX))
    negative = passes & (lattice < 0)
    mismatch = F.coalesce(error > K.ZT_TOLERANCE, F.lit(False))
    on = lambda c, bit: F.when(c, F.lit(bit)).otherwise(0)
    flags = F.when(~F.coalesce(algebraic, F.lit(False)), F.lit(b["ALGEBRAIC_REJECT"])).when(bound.isNotNull(), bound + b["ALGEBRAIC_REJECT"]).otherwise(
        on(hot, b["TEMPERATURE_OUT_OF_RANGE"]) + on(off | negative, b["WF_VIOLATION"]) + on(mismatch, b["ZT_CROSSCHECK_FAIL"])
    )
    tier = F.when(~passes, 4).when(hot | negative | mismatch, 3).when(off, 2).otherwise(1)
    return {
        "zt_computed": F.when(passes, value),
        "kappa_lattice": F.when(passes, lattice),
        "lorenz_number": F.when(passes, lorenz),
        "zt_error": error,
        "audit_tier": tier.cast("int"),
        "anomaly_flags": flags.cast("int"),
    }


def audit(states: DataFrame, s="s", sigma="sigma", kappa="kappa", t="t", zt_reported="zt_reported", incomplete_flags: int | None = None) -> DataFrame:
    """Add the audit columns to a table of states: one narrow step, no join back.

    ``incomplete_flags``: if given, states with a null among s, sigma, kappa get tier 4 with these flags, as states
    that never reached the audit; otherwise they are algebraic rejects.
    """
    out = audit_columns(*(F.col(c) for c in (s, sigma, kappa, t, zt_reported)))
    if incomplete_flags is not None:
        missing = F.col(s).isNull() | F.col(sigma).isNull() | F.col(kappa).isNull()
        out["anomaly_flags"] = F.when(missing, incomplete_flags).otherwise(out["anomaly_flags"]).cast("int")
    return states.withColumns(out)


def zt_batch(s: Column, sigma: Column, kappa: Column, t: Column) -> Column:
    """zT, or null unless inputs are finite and positive, within bounds, Lorenz number in range and 0 <= zT <= 4."""
    ok = all_of(finite(s), finite(sigma), finite(kappa), finite(t), t > 0, kappa > 0, sigma > 0, F.abs(s) <= K.S_MAX, sigma <= K.SIGMA_MAX, kappa <= K.KAPPA_MAX)
    lorenz = F.when(ok, kappa / (sigma * t))
    value = F.when(ok & (lorenz >= K.L_MIN) & (lorenz <= K.L_MAX), zt(s, sigma, kappa, t))
    return F.when((value >= 0) & (value <= K.ZT_MAX), value)


def bounds_code(s: Column, sigma: Column, kappa: Column, t: Column) -> Column:
    """The first empirical bound a state breaks, in fixed order; null if none."""
    return (
        F.when(F.abs(s) > K.S_MAX, "SEEBECK_BOUND").when(sigma > K.SIGMA_MAX, "SIGMA_BOUND").when(kappa > K.KAPPA_MAX, "KAPPA_BOUND").when((t < K.T_MIN) | (t > K.T_MAX), "TEMPERATURE_BOUND")
    )


def zt_strict(s: Column, sigma: Column, kappa: Column, t: Column) -> dict[str, Column]:
    """zT with an error code: positivity of kappa, T, sigma in this order, then the empirical bounds."""
    code = F.when(~F.coalesce(all_of(finite(s), finite(sigma), finite(kappa), finite(t)), F.lit(False)), "NOT_FINITE").when(kappa <= 0, "KAPPA_NOT_POSITIVE").when(t <= 0, "T_NOT_POSITIVE").when(sigma <= 0, "SIGMA_NOT_POSITIVE").otherwise(bounds_code(s, sigma, kappa, t))
    return {"error_code": code, "zt": F.when(code.isNull(), zt(s, sigma, kappa, t))}


def state_code(s: Column, sigma: Column, kappa: Column, t: Column, zt_value: Column) -> Column:
    """Validation of a state: finiteness of S, sigma, kappa, T in order, then T, sigma, kappa positive, then zT not negative."""
    bad = lambda c: ~F.coalesce(finite(c), F.lit(False))
    return (
        F.when(bad(s), "S_NOT_FINITE").when(bad(sigma), "SIGMA_NOT_FINITE").when(bad(kappa), "KAPPA_NOT_FINITE").when(bad(t), "T_NOT_FINITE")
        .when(t <= 0, "T_NOT_POSITIVE").when(sigma <= 0, "SIGMA_NOT_POSITIVE").when(kappa <= 0, "KAPPA_NOT_POSITIVE").when(zt_value < 0, "ZT_NEGATIVE")
    )


def lorenz(sigma: Column, kappa_e: Column, t: Column) -> Column:
    """Lorenz number; null where sigma or T is not positive."""
    return F.when((sigma > 0) & (t > 0), kappa_e / (sigma * t))


def wiedemann_franz(sigma: Column, kappa: Column, t: Column, lorenz_number: Column | None = None) -> dict[str, Column]:
    """Electronic and lattice part of the thermal conductivity, with an error code.

    The Lorenz number must lie strictly inside its range; a negative lattice part is an error, its value is kept null.
    """
    number = lorenz_number if lorenz_number is not None else F.lit(K.L0)
    electronic = number * sigma * t
    lattice = kappa - electronic
    code = F.when((number <= K.L_MIN) | (number >= K.L_MAX), "LORENZ_OUT_OF_RANGE").when(lattice < 0, "LATTICE_NEGATIVE")
    return {"kappa_electronic": F.when(code.isNull() | (code == "LATTICE_NEGATIVE"), electronic), "kappa_lattice": F.when(code.isNull(), lattice), "error_code": code}


def propagate(s: Column, sigma: Column, kappa: Column, t: Column, ds: Column, dsigma: Column, dkappa: Column, dt: Column) -> dict[str, Column]:
    """zT and its uncertainty by linear propagation; null with a code where kappa or T is not positive."""
    code = F.when(kappa <= 0, "KAPPA_NOT_POSITIVE").when(t <= 0, "T_NOT_POSITIVE")
    square = lambda c: c * c
    total = square(2 * s * sigma * t / kappa * ds) + square(s * s * t / kappa * dsigma) + square(s * s * sigma * t / (kappa * kappa) * dkappa) + square(s * s * sigma / kappa * dt)
    return {"zt": F.when(code.isNull(), zt(s, sigma, kappa, t)), "zt_error": F.when(code.isNull(), F.sqrt(total)), "error_code": code}


def default_error(c: Column) -> Column:
    return F.abs(c) * K.RELATIVE_ERROR


def wf_penalty(sigma: Column, kappa: Column, t: Column, weight: float) -> Column:
    """Quadratic penalty where the electronic part exceeds the whole thermal conductivity."""
    excess = F.greatest(F.lit(0.0), F.lit(K.L0) * sigma * t - kappa)
    return F.lit(weight) * excess * excess


def log_likelihood(s: Column, sigma: Column, kappa: Column, t: Column, zt_observed: Column, zt_sigma: Column, weight: float) -> Column:
    """Gaussian log likelihood of the observed zT, less the penalty; null where it is not defined."""
    ok = (kappa > 0) & (zt_sigma > 0)
    z = (zt_observed - zt(s, sigma, kappa, t)) / zt_sigma
    return F.when(ok, -0.5 * z * z - F.ln(zt_sigma) - 0.5 * F.ln(F.lit(6.283185307179586)) - wf_penalty(sigma, kappa, t, weight))


def power_factor_mw(s: Column, sigma: Column) -> Column:
    return s * s * sigma * 1e3


def decode_flags(flags: Column) -> Column:
    """Names of the bits set, in bit order."""
    return F.array_compact(F.array(*(F.when(flags.bitwiseAND(F.lit(bit)) != 0, F.lit(name)) for name, bit in K.BIT.items())))


def has_flag(flags: Column, name: str) -> Column:
    return flags.bitwiseAND(F.lit(K.BIT[name])) != 0


def sigma_rho_flag(sigma: Column, rho: Column, tolerance: float = K.SIGMA_RHO_TOLERANCE) -> dict[str, Column]:
    """Deviation of sigma from 1/rho and bit 3; rho = 0 has no deviation but the bit; a negative rho never has it."""
    inverse = F.when(rho != 0, 1 / rho)
    deviation = F.when(rho != 0, F.abs(sigma - inverse) / inverse)
    bit = F.lit(K.BIT["SIGMA_RHO_INCON"])
    return {"deviation": deviation, "flag": F.when(rho == 0, bit).when(deviation > tolerance, bit).otherwise(0)}


def sigma_rho_row_flag(flags: Column, sigma: Column, rho: Column, tolerance: float = K.SIGMA_RHO_TOLERANCE) -> Column:
    """Flags with bit 3 where both are finite and positive and their product is off 1 by more than the tolerance."""
    bad = all_of(finite(sigma), finite(rho), sigma > 0, rho > 0) & (F.abs(sigma * rho - 1) > tolerance)
    return F.when(F.coalesce(bad, F.lit(False)), flags.bitwiseOR(F.lit(K.BIT["SIGMA_RHO_INCON"]))).otherwise(flags)


def kolmogorov_p(lam: Column) -> Column:
    """Two-sided Kolmogorov p-value by its alternating series of 100 terms, clamped to [0, 1]; 1 for a tiny argument."""
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k.cast("double") * k * lam * lam))
    return F.when(lam < 1e-12, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * terms)))
