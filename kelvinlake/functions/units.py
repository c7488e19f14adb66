"""Units: the registry, conversion to SI, and quantities with dimension and uncertainty."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvinlake.functions.constants import BIT

#: Unit text, property, SI unit, factor, offset; si = raw * factor + offset.
REGISTRY = (
    ("V/K", "Seebeck", "V/K", 1.0, 0.0),
    ("mV/K", "Seebeck", "V/K", 1e-3, 0.0),
    ("uV/K", "Seebeck", "V/K", 1e-6, 0.0),
    ("µV/K", "Seebeck", "V/K", 1e-6, 0.0),
    ("μV/K", "Seebeck", "V/K", 1e-6, 0.0),
    ("V K-1", "Seebeck", "V/K", 1.0, 0.0),
    ("muV/K", "Seebeck", "V/K", 1e-6, 0.0),
    ("S/m", "ElectricalConductivity", "S/m", 1.0, 0.0),
    ("S/cm", "ElectricalConductivity", "S/m", 100.0, 0.0),
    ("1/(ohm*m)", "ElectricalConductivity", "S/m", 1.0, 0.0),
    ("1/(ohm*cm)", "ElectricalConductivity", "S/m", 100.0, 0.0),
    ("(ohm*cm)^-1", "ElectricalConductivity", "S/m", 100.0, 0.0),
    ("(ohm*m)^-1", "ElectricalConductivity", "S/m", 1.0, 0.0),
    ("S cm-1", "ElectricalConductivity", "S/m", 100.0, 0.0),
    ("ohm*m", "ElectricalResistivity", "ohm*m", 1.0, 0.0),
    ("ohm*cm", "ElectricalResistivity", "ohm*m", 1e-2, 0.0),
    ("mohm*cm", "ElectricalResistivity", "ohm*m", 1e-5, 0.0),
    ("mΩ*cm", "ElectricalResistivity", "ohm*m", 1e-5, 0.0),
    ("uohm*cm", "ElectricalResistivity", "ohm*m", 1e-8, 0.0),
    ("µΩ*cm", "ElectricalResistivity", "ohm*m", 1e-8, 0.0),
    ("Ω*m", "ElectricalResistivity", "ohm*m", 1.0, 0.0),
    ("Ω*cm", "ElectricalResistivity", "ohm*m", 1e-2, 0.0),
    ("W/(m*K)", "ThermalConductivity", "W/(m*K)", 1.0, 0.0),
    ("W/mK", "ThermalConductivity", "W/(m*K)", 1.0, 0.0),
    ("W m-1 K-1", "ThermalConductivity", "W/(m*K)", 1.0, 0.0),
    ("mW/(m*K)", "ThermalConductivity", "W/(m*K)", 1e-3, 0.0),
    ("mW/mK", "ThermalConductivity", "W/(m*K)", 1e-3, 0.0),
    ("W/(cm*K)", "ThermalConductivity", "W/(m*K)", 100.0, 0.0),
    ("W/cmK", "ThermalConductivity", "W/(m*K)", 100.0, 0.0),
    ("K", "Temperature", "K", 1.0, 0.0),
    ("degC", "Temperature", "K", 1.0, 273.15),
    ("°C", "Temperature", "K", 1.0, 273.15),
    ("C", "Temperature", "K", 1.0, 273.15),
    ("W/(m*K^2)", "PowerFactor", "W/(m*K^2)", 1.0, 0.0),
    ("mW/(m*K^2)", "PowerFactor", "W/(m*K^2)", 1e-3, 0.0),
    ("uW/(m*K^2)", "PowerFactor", "W/(m*K^2)", 1e-6, 0.0),
    ("µW/(cm*K^2)", "PowerFactor", "W/(m*K^2)", 1e-4, 0.0),
    ("mW/(cm*K^2)", "PowerFactor", "W/(m*K^2)", 0.1, 0.0),
    ("1", "ZT", "1", 1.0, 0.0),
    ("", "ZT", "1", 1.0, 0.0),
    ("K^-1", "ZFigureOfMerit", "K^-1", 1.0, 0.0),
    # Identity rows for allowed properties that have no unit of their own above.
    ("m^3/C", "HallCoefficient", "m^3/C", 1.0, 0.0),
    ("m^-3", "CarrierConcentration", "m^-3", 1.0, 0.0),
    ("m^2/(V*s)", "HallMobility", "m^2/(V*s)", 1.0, 0.0),
)
#: SI base dimensions (m, kg, s, A, K, mol, cd) and affine scale of the units quantities may use.
UNITS = {"m": ([1, 0, 0, 0, 0, 0, 0], 1.0, 0.0), "mm": ([1, 0, 0, 0, 0, 0, 0], 1e-3, 0.0), "K": ([0, 0, 0, 0, 1, 0, 0], 1.0, 0.0), "degC": ([0, 0, 0, 0, 1, 0, 0], 1.0, 273.15)}


def registry(spark: SparkSession, rows=REGISTRY) -> DataFrame:
    """The unit registry as a table; a unit listed twice counts as last listed."""
    unique = {r[0]: r for r in rows}
    return spark.createDataFrame(list(unique.values()), "unit_text string, unit_property string, unit_si string, unit_factor double, unit_offset double")


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """A registry from a TOML file of ``[[unit]]`` tables."""
    import tomllib

    with open(path, "rb") as f:
        units = tomllib.load(f)["unit"]
    return registry(spark, [(u["raw_string"], u["property"], u["si_unit"], float(u["factor"]), float(u.get("offset", 0.0))) for u in units])


def to_si(df: DataFrame, value: str, unit: str, units: DataFrame) -> DataFrame:
    """Add si_value, si_unit and unit_flag by a broadcast lookup; an unknown unit keeps the raw value and sets bit 2.

    The registry is a configuration table of at most a few hundred rows, which bounds the broadcast.
    """
    out = df.join(F.broadcast(units.select("unit_text", "unit_si", "unit_factor", "unit_offset")), F.col(unit) == F.col("unit_text"), "left")
    known = F.col("unit_text").isNotNull()
    return out.withColumns(
        {
            "si_value": F.when(known, F.col(value) * F.col("unit_factor") + F.col("unit_offset")).otherwise(F.col(value)),
            "si_unit": F.coalesce("unit_si", F.lit("")),
            "unit_flag": F.when(known, 0).otherwise(BIT["UNIT_UNKNOWN"]),
        }
    ).drop("unit_text", "unit_si", "unit_factor", "unit_offset")


def significant(c: Column, digits: int = 12) -> Column:
    """Rounded to significant digits; 0 and values that are not finite stay."""
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(c))))
    return F.when((c == 0) | F.isnan(c) | (F.abs(c) == float("inf")), c).otherwise(F.rint(c * scale) / scale)


def convert(value: Column, sigma: Column, source: str, target: str) -> tuple[Column, Column]:
    """A value and its uncertainty from one unit to another of the same dimension, to 12 significant digits."""
    (d1, k1, b1), (d2, k2, b2) = UNITS[source], UNITS[target]
    if d1 != d2:
        raise ValueError(f"{source} and {target} differ in dimension")
    v = (value * k1 + (b1 - b2)) / k2
    s = sigma * abs(k1 / k2)
    ok = (F.abs(v) <= 1e308) & (F.abs(s) <= 1e308)
    return F.when(ok, significant(v)), F.when(ok, significant(s))


# Quantities: struct(value, uncertainty, dim array<int>).


def quantity(value: Column, uncertainty: Column, dim: list[int]) -> Column:
    return F.struct(value.cast("double").alias("value"), uncertainty.cast("double").alias("uncertainty"), F.array(*(F.lit(d) for d in dim)).alias("dim"))


def add(a: Column, b: Column, sign: int = 1) -> Column:
    """Sum (or difference) of two quantities; null where dimensions differ."""
    return F.when(a["dim"] == b["dim"], F.struct((a["value"] + sign * b["value"]).alias("value"), F.hypot(a["uncertainty"], b["uncertainty"]).alias("uncertainty"), a["dim"].alias("dim")))


def multiply(a: Column, b: Column) -> Column:
    return F.struct(
        (a["value"] * b["value"]).alias("value"),
        F.hypot(a["value"] * b["uncertainty"], b["value"] * a["uncertainty"]).alias("uncertainty"),
        F.zip_with(a["dim"], b["dim"], lambda x, y: x + y).alias("dim"),
    )


def divide(a: Column, b: Column) -> Column:
    """Quotient of two quantities; null where the divisor is 0."""
    ratio = a["value"] / b["value"]
    return F.when(
        b["value"] != 0,
        F.struct(
            ratio.alias("value"),
            F.hypot(a["uncertainty"] / b["value"], ratio * b["uncertainty"] / b["value"]).alias("uncertainty"),
            F.zip_with(a["dim"], b["dim"], lambda x, y: x - y).alias("dim"),
        ),
    )


def exponential(a: Column) -> Column:
    """e to a dimensionless quantity; null if it has a dimension."""
    e = F.exp(a["value"])
    return F.when(F.forall(a["dim"], lambda d: d == 0), F.struct(e.alias("value"), (e * a["uncertainty"]).alias("uncertainty"), a["dim"].alias("dim")))


def scale_by_text(value: Column, unit: Column, role: Column, rules: Mapping[str, list[tuple[str, str | None, float]]]) -> Column:
    """Multiply by the factors of every rule whose pattern is in the unit text (and whose other pattern is not), in order."""
    out = value
    for name, patterns in rules.items():
        for pattern, unless, factor in patterns:
            hit = (role == name) & unit.rlike(pattern)
            hit = hit & ~unit.rlike(unless) if unless else hit
            out = out * F.when(F.coalesce(hit, F.lit(False)), factor).otherwise(1.0)
    return out


#: Rules of unit text by role, applied cumulatively in this order.
TEXT_RULES = {
    "S": [("uV|muV|μV", None, 1e-6), ("mV", None, 1e-3)],
    "Sigma": [("cm", None, 100.0), (r"10\^3", None, 1e3), (r"10\^4", None, 1e4)],
    "Rho": [("mOhm.*cm", None, 1e-5), ("uOhm.*cm|μOhm.*cm", None, 1e-8), ("Ohm.*cm", "mOhm|uOhm|μOhm", 1e-2), ("uOhm.*m|μOhm.*m", "cm", 1e-6)],
    "Kappa": [("mW.*cm|cm.*mW", None, 0.1), (r"mW.*m\^|m\^.*mW", None, 1e-3)],
}
