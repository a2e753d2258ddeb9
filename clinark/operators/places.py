"""patient search through the places — which texts a search can hit, found before the patients are read.

The search text matches a patient's id, city or state. Cities and states are few, so the pattern is
tried on their dictionary, which is written with the tier, and the patients are then read by equality
from a copy laid out by place, whose row groups tell what they hold. An id of the tier is a hash in
hex digits: a pattern with any other character can't match one. Patterns that could, and those that match
more than ``MAX_PLACES`` places, are searched by a scan, with the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinark.functions import exprs as X
from clinark.schemas import CLEAN
from clinark.sources.parquet import write_parquet

PLACES, BY_PLACE = "patients_places", "patients_by_place"
MAX_PLACES = 1000
SCHEMA = "state string, city string, patients bigint"


def place_dictionary(patients: DataFrame) -> DataFrame:
    """Every (state, city) with its number of rows."""
    return patients.groupBy("state", "city").agg(F.count(F.lit(1)).alias("patients"))


def write_places(patients: DataFrame, clean_root: str) -> int:
    """Write the dictionary and the copy by place beside the clustered table; returns the copy's rows. The
    adaptive planner splits a place that is too big over several tasks."""
    root = clean_root.rstrip("/")
    columns = CLEAN["patients"].fieldNames()
    order = [F.asc_nulls_first(c) for c in ("state", "city", "patient_id")]
    rows = write_parquet(patients.select(*columns).hint("rebalance", "state", "city").sortWithinPartitions(*order),
                         f"{root}/{BY_PLACE}")
    write_parquet(place_dictionary(patients.sparkSession.read.schema(CLEAN["patients"]).parquet(f"{root}/{BY_PLACE}")).coalesce(1),
                  f"{root}/{PLACES}")
    return rows


def read_places(spark: SparkSession, clean_root: str) -> tuple[DataFrame, DataFrame]:
    """(dictionary, patients by place)."""
    root = clean_root.rstrip("/")
    return (spark.read.schema(SCHEMA).parquet(f"{root}/{PLACES}"),
            spark.read.schema(CLEAN["patients"]).parquet(f"{root}/{BY_PLACE}"))


def may_match_id(q: str) -> bool:
    """Whether ``%q%`` can match a key of lower-case hex digits: all its literal characters are such."""
    literal, i = [], 0
    while i < len(q):
        if q[i] == "\\" and i + 1 < len(q):
            literal.append(q[i + 1])
            i += 2
            continue
        if q[i] not in "%_":
            literal.append(q[i])
        i += 1
    return all(c in "0123456789abcdef" for c in "".join(literal).lower())


def search_rows(places: tuple[DataFrame, DataFrame], q: str, max_places: int = MAX_PLACES) -> DataFrame | None:
    """The rows that search text ``q`` matches, read by place; None if only a scan can tell."""
    dictionary, patients = places
    q = q.strip()
    if not q or may_match_id(q):
        return None
    pattern = X.like_pattern(f"%{q}%")
    city = F.coalesce(F.col("city").ilike(pattern), F.lit(False))
    state = F.coalesce(F.col("state").ilike(pattern), F.lit(False))
    hits = (dictionary.select("state", "city", city.alias("by_city"), state.alias("by_state"))
            .where("by_city or by_state").limit(max_places + 1).collect())
    if len(hits) > max_places:
        return None
    if not hits:
        return patients.limit(0)
    states = sorted({h["state"] for h in hits if h["by_state"]})
    cities = [h for h in hits if h["by_city"] and not h["by_state"]]
    wanted = F.col("state").isin(states) if states else F.lit(False)
    if cities:
        # The states of these cities, too: the copy is sorted by state first.
        around = sorted({h["state"] for h in cities if h["state"] is not None})
        found = F.col("state").isin(around) if around else F.lit(False)
        if any(h["state"] is None for h in cities):
            found |= F.col("state").isNull()
        wanted |= found & F.col("city").isin(sorted({h["city"] for h in cities}))
    return patients.where(wanted)
