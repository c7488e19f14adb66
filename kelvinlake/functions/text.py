"""Text functions: compositions, deduplication keys, experiment classes, element systems."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kelvinlake.functions.constants import T_BUCKET

#: Keywords of the two classes, the first class wins.
COMPUTATIONAL = (
    "dft", "vasp", "wien2k", "quantum espresso", "openmx", "ab initio", "first-principles", "first principles",
    "calculated", "simulated", "molecular dynamics", "monte carlo", "phonon calculation", "band structure calculation",
)
EXPERIMENTAL = (
    "measured", "synthesized", "fabricated", "grown", "deposited", "sintered", "pressed", "annealed", "spark plasma sintering",
    "hot pressing", "arc melting", "zone melting", "ball milling", "sputtered", "evaporated", "chemical vapor deposition", "cvd",
    "four-probe", "harman method", "laser flash",
)


def normalize_composition(c: Column) -> Column:
    """White space removed, split before capitals, tokens in lower case, sorted and joined."""
    tokens = F.regexp_extract_all(F.regexp_replace(c, r"\s", ""), F.lit(r"(\p{Lu}?\P{Lu}+|\p{Lu})"), 0)
    return F.array_join(F.array_sort(F.transform(tokens, F.lower)), "")


def temperature_bucket(t_min: Column, t_max: Column, width: float = T_BUCKET) -> Column:
    low = lambda t: (F.floor(t / width) * int(width)).cast("string")
    return F.concat(F.lit("Tmin_"), low(t_min), F.lit("_Tmax_"), low(t_max))


def dedup_key(doi: Column, composition: Column, t_min: Column, t_max: Column) -> Column:
    return F.sha2(F.concat_ws("|", doi, normalize_composition(composition), temperature_bucket(t_min, t_max)), 256)


def row_dedup_key(paper: Column, composition: Column, t: Column, width: float = T_BUCKET) -> Column:
    """Key of the row-wise variant: tokens split at blanks and commas, case kept, one temperature cut to a whole bucket."""
    tokens = F.filter(F.split(F.coalesce(composition, F.lit("")), r"[\s,]+"), lambda x: x != "")
    bucket = (F.floor(t / width) * int(width)).cast("string")
    return F.sha2(F.concat_ws("\u0000", F.coalesce(paper.cast("string"), F.lit("")), F.array_join(F.array_sort(tokens), " "), F.coalesce(bucket, F.lit("NA"))), 256)


def experiment_class(fields: Sequence[Column]) -> Column:
    text = F.lower(F.concat_ws(" ", *fields))

    def any_of(words: Sequence[str]) -> Column:
        out = F.lit(False)
        for w in words:
            out = out | text.contains(w)
        return out

    return F.when(any_of(COMPUTATIONAL), "Computational").when(any_of(EXPERIMENTAL), "Experimental").otherwise("Unknown")


def element_system(composition: Column, most: int = 3) -> Column:
    """The first three distinct element symbols in order, joined by '-'; Unknown if there are none."""
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(composition, F.lit("")), F.lit("([A-Z][a-z]?)"), 1)))
    return F.when(F.size(found) == 0, "Unknown").otherwise(F.array_join(F.slice(found, 1, most), "-"))


def family_label(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("Unclassified"))


def sampleinfo_category(json: Column, key: str) -> Column:
    """The trimmed category of one key of a sampleinfo text, '' on any problem."""
    whole = F.when(F.try_parse_json(json).isNotNull(), json)
    return F.coalesce(F.trim(F.get_json_object(whole, f"$.{key}.category")), F.lit(""))


def flexible_id(c: Column) -> Column:
    """A whole number 0 .. 2**32 - 1 given as number or digits, else null."""
    n = F.trim(c).try_cast("decimal(20,0)")
    return F.when(F.trim(c).rlike(r"^\d+$") & n.between(0, 4294967295), n.cast("long"))


def last_of_list(c: Column) -> Column:
    """A number, or the last of a list like '[1, 2]', as a double; null if it cannot be read."""
    body = F.regexp_replace(F.trim(c), r"^\[|\]$", "")
    return F.trim(F.element_at(F.split(body, ","), -1)).try_cast("double")


def parse_list(c: Column) -> Column:
    """A JSON array of numbers, [] if it cannot be read."""
    return F.coalesce(F.from_json(c, "array<double>"), F.array().cast("array<double>"))
