"""Reading tables: CSV with header heuristics, wide states by column aliases, checked Parquet, configuration."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelvinlake.functions import text
from kelvinlake.operators import states

#: Exact column names accepted per quantity; the first one present is taken.
ALIASES = {
    "s": ("seebeck", "S", "seebeck_coefficient", "Seebeck", "seebeck_uV_K", "S_V_K"),
    "sigma": ("sigma", "electrical_conductivity", "conductivity", "sigma_S_m", "elec_cond"),
    "kappa": ("kappa", "thermal_conductivity", "kappa_total", "kappa_W_mK", "therm_cond"),
    "t": ("T", "temperature", "temp", "T_K", "Temperature"),
    "zt": ("ZT", "zt", "zT", "figure_of_merit", "ZT_reported", "zT_reported", "ZT_dimensionless"),
    "rho": ("rho", "resistivity", "electrical_resistivity", "rho_ohm_m", "rho_Ohm_m", "elec_resistivity"),
    # Names of this library's own tables.
    "composition": ("composition", "material", "formula", "compound"),
    "paper": ("doi", "paper_id", "ref_id", "reference_id", "paperid"),
}


def load(spark: SparkSession, path: str) -> DataFrame:
    """A table by its suffix: .parquet, .csv or .tsv (all columns text); anything else is an error."""
    suffix = Path(path).suffix
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix in (".csv", ".tsv"):
        return spark.read.option("header", True).csv(path, sep="\t" if suffix == ".tsv" else ",")
    raise ValueError(f"unknown kind of table: {path}")


def resolve(df: DataFrame, quantity: str, override: str | None = None) -> str | None:
    """The column of a quantity: the override if it is there, else the first alias present, compared exactly."""
    names = set(df.columns)
    if override in names:
        return override
    return next((a for a in ALIASES[quantity] if a in names), None)


def numeric_states(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """s, sigma, kappa, t, zt as doubles (text that is no number becomes null), beside the other columns.

    Missing S, sigma, kappa or T columns are an error; without a zT column it is null, which turns the cross-check off.
    """
    found = {q: resolve(df, q, (overrides or {}).get(q)) for q in ("s", "sigma", "kappa", "t", "zt")}
    missing = [q for q in ("s", "sigma", "kappa", "t") if found[q] is None]
    if missing:
        raise ValueError(f"no column for {', '.join(missing)}")
    used = {c for c in found.values() if c}
    rest = [F.col(f"`{c}`") for c in df.columns if c not in used and c.lower() not in found]
    return df.select(*(F.col(f"`{c}`").cast("string").try_cast("double").alias(q) if c else F.lit(None).cast("double").alias(q) for q, c in found.items()), *rest)


def csv_roles(header: list[str]) -> dict[str, list[str]]:
    """Columns per role by their trimmed, lower-cased headers."""
    roles: dict[str, list[str]] = {"t": [], "s": [], "sigma": [], "rho": [], "kappa": []}
    for name in header:
        h = name.strip().lower()
        if h in ("temperature", "t"):
            roles["t"].append(name)
        elif "seebeck" in h or h in ("s", "tep", "thermopower"):
            roles["s"].append(name)
        elif h in ("electrical conductivity", "conductance"):
            roles["sigma"].append(name)
        elif "resistivity" in h or h in ("ρ", "resistyvity"):
            roles["rho"].append(name)
        elif h in ("thermal conductivity", "total thermal conductivity", "kappa"):
            roles["kappa"].append(name)
    return roles


def csv_states(df: DataFrame, order: str) -> DataFrame:
    """States of an interpolated table: cells may be lists (the last element counts), the first readable column of a role wins.

    Grouped by composition, sample id ('unknown' if null) and T rounded half away from zero; rows without T are left out;
    per role the last non-null value in ``order`` wins.
    """
    roles = csv_roles([c for c in df.columns if c != order])
    first = {r: (F.coalesce(*(text.last_of_list(F.col(f"`{c}`").cast("string")) for c in cs)) if cs else F.lit(None).cast("double")).alias(r) for r, cs in roles.items()}
    rows = df.select(F.col(order).alias("row_no"), F.col("composition"), F.coalesce(F.col("sampleid"), F.lit("unknown")).alias("sampleid"), *first.values())
    rows = rows.filter("t IS NOT NULL").withColumn("t", F.round("t").cast("long"))
    return states.group_rows(rows, ["composition", "sampleid", "t"], {"s": "s", "sigma": "sigma", "kappa": "kappa"}, "row_no", rho="rho")


def read_parquet_checked(spark: SparkSession, path: str, expected: T.StructType) -> DataFrame:
    """Parquet whose columns and types equal the expected ones (nullability and metadata aside), else ValueError."""
    df = spark.read.parquet(path)
    got = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in expected]
    if got != want:
        raise ValueError(f"schema of {path}: {got}, not {want}")
    return df


def read_json_metadata(path: str) -> dict:
    try:
        return json.loads(Path(path).read_text())
    except (OSError, ValueError) as e:
        raise ValueError(f"metadata {path}: {e}") from e


def read_config(path: str) -> dict:
    """A flat two-level configuration in TOML, or in the simple YAML of ``key: value`` lines and indented sections."""
    body = Path(path).read_text()
    if path.endswith(".toml"):
        import tomllib

        return tomllib.loads(body)
    out: dict = {}
    section = out
    for line in body.splitlines():
        line = line.split(" #")[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        m = re.match(r"^(\s*)([\w.-]+):\s*(.*)$", line)
        if not m:
            raise ValueError(f"{path}: cannot read {line!r}")
        indent, key, value = m.groups()
        target = section if indent else out
        if value == "":
            section = out[key] = {}
        else:
            target[key] = json.loads(value) if re.match(r"^(-?\d|true$|false$|null$|\"|\[)", value) else value
    return out


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A JDBC query; partitioning options (partitionColumn, lowerBound, upperBound, numPartitions) make it parallel."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load() if "partitionColumn" not in options else spark.read.format("jdbc").options(url=url, dbtable=f"({query}) q", **options).load()


def synthetic_states(spark: SparkSession, n: int, seed: int = 424242) -> DataFrame:
    """States with the base distribution of the tests: consistent by construction."""
    u = lambda i, a, b: F.rand(seed + i) * (b - a) + a
    df = spark.range(n).select("id", u(0, 300.0, 900.0).alias("t"), u(1, 50e-6, 300e-6).alias("s"), u(2, 1e3, 1e5).alias("sigma"), u(3, 0.5, 5.0).alias("extra"))
    return df.withColumn("kappa", F.lit(2.44e-8) * F.col("sigma") * F.col("t") + F.col("extra")).drop("extra")
