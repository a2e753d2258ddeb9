"""FHIR-shaped raw resources derived from the star-schema test tables.

The raw tier of the pipeline is nested FHIR R4 JSON. The test inputs are TPC-H-like
Parquet tables, so these functions build the four resource types from them as
nested DataFrames with exactly the raw schemas (``clinark.schemas``). The rules
(FIXTURES.md §3) keep every input row; the modulo rules only decide where a
NULL, a malformed value or an injected duplicate appears, so that every edge case
of the normalisers is exercised at every scale.

Everything is a lazy DataFrame plan: star joins are left to the optimizer (the two
fixed-size dimensions, nation and region, are broadcast by size; the large
lineitem/orders/part joins are sort-merge or adaptive).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinark.schemas import RAW, conform_raw

# The moduli that place edge cases, and the date shift.
YEAR_SHIFT = 24  # multiple of four, so 29 February stays valid
TIME_SUFFIX = "T09:00:00-05:00"
NULL_PATIENT_ID_MOD = 211
NULL_GENDER_MOD = 97
MALE_UPPER_MOD = 10
NULL_BIRTH_MOD = 89
BAD_BIRTH_MOD = 83
EMPTY_ADDRESS_MOD = 101
DUPLICATE_PATIENT_MOD = 53
DUPLICATE_CITY = "ZZ_DUP"
URN_REFERENCE_MOD = 97
EMPTY_TYPE_MOD = 101
NULL_START_MOD = 103
NULL_END_MOD = 107
NULL_CODE_MOD = 61
CODE_MOD = 300
NULL_MED_ID_MOD = 101
BARE_ENCOUNTER_MOD = 97
BAD_AUTHORED_MOD = 103
NO_DOSAGE_LINE = 7

# Encounter class by order status; clinical status by return flag;
# medication status by line status; diagnosis-name suffix by part type.
ENCOUNTER_CLASS = (("F", "AMB"), ("O", "EMER"), ("P", "IMP"))
CLINICAL_STATUS = (("N", "active"), ("A", "resolved"))
MED_STATUS = (("O", "active"), ("F", "completed"))
NAME_SUFFIX = (("ECONOMY", " (disorder)"), ("MEDIUM", " (finding)"),
               ("PROMO", " (situation)"), ("STANDARD", " (Procedure) "))
NAME_PLAIN_TYPE = "LARGE"  # name without a suffix; SMALL (and others) give NULL

#: Estimated bytes of a table (its files, by the share of the columns read) for each partition it is dealt to.
SPREAD_BYTES = 4 << 20

STAR_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_nationkey"],
    "part": ["p_partkey", "p_name", "p_type"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
                 "l_linestatus", "l_shipdate"],
}


def star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One star table, pruned to the columns the fixtures read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*STAR_COLUMNS[name])


def shares(df: DataFrame, least: int) -> int:
    """How many parts of about ``SPREAD_BYTES`` a table has, ``least`` at least."""
    return max(least, -(-int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) // SPREAD_BYTES))


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` hash-partitioned on ``key`` over the cores: a test table stored as a single
    Parquet row group is read by one task, so everything built from it would run on one core.
    Partitions grow in number with the table: a sort of one stays in memory."""
    return df.repartition(shares(df, df.sparkSession.sparkContext.defaultParallelism), key)


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _iso(ts: str) -> Column:
    """Shifted ISO timestamp text: (year+24) || '-MM-dd' || 'T09:00:00-05:00'."""
    c = F.col(ts)
    return F.concat(_text(F.year(c) + YEAR_SHIFT), F.substring(_text(c.cast("date")), 5, 6),
                    F.lit(TIME_SUFFIX))


def _case(c: Column, pairs, otherwise=None) -> Column:
    out = None
    for key, value in pairs:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(c == key, v) if out is None else out.when(c == key, v)
    return out.otherwise(otherwise) if otherwise is not None else out


def _empty(arr: Column) -> Column:
    """An empty array with the element type of ``arr``."""
    return F.filter(arr, lambda _x: F.lit(False))


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None).cast("string")).otherwise(value)


def _patient_ref(custkey: str, orderkey: str) -> Column:
    pat = F.concat(F.lit("pat-"), _text(custkey))
    return F.when(F.col(orderkey) % URN_REFERENCE_MOD == 0, F.concat(F.lit("urn:uuid:"), pat)) \
            .otherwise(F.concat(F.lit("Patient/"), pat))


def raw_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient resources: customer ⋈ nation ⋈ region, with injected duplicates."""
    cust = star(spark, sf_dir, "customer")
    nation = star(spark, sf_dir, "nation")
    region = star(spark, sf_dir, "region")
    k = F.col("c_custkey")
    # One scan: duplicates come from a generator, not a second read + union.
    copies = F.explode(F.when(k % DUPLICATE_PATIENT_MOD == 0, F.array(F.lit(False), F.lit(True)))
                       .otherwise(F.array(F.lit(False))))
    rows = (cust.join(nation, cust.c_nationkey == nation.n_nationkey)
                .join(region, nation.n_regionkey == region.r_regionkey)
                .select("c_custkey", "n_name", "r_name", copies.alias("is_dup")))
    no_address = k % EMPTY_ADDRESS_MOD == 0
    one = F.array(F.struct(F.col("r_name").alias("state"), F.col("n_name").alias("city")))
    dup = F.array(F.struct(_null_if(no_address, F.col("r_name")).alias("state"),
                           F.lit(DUPLICATE_CITY).alias("city")))
    address = F.when(F.col("is_dup"), dup).when(no_address, _empty(one)).otherwise(one)
    gender = (F.when(k % NULL_GENDER_MOD == 0, F.lit(None).cast("string"))
               .when(k % MALE_UPPER_MOD == 0, "Male")
               .when(k % 2 == 0, "male")
               .otherwise("female"))
    birth = (F.when(k % NULL_BIRTH_MOD == 0, F.lit(None).cast("string"))
              .when(k % BAD_BIRTH_MOD == 0, "unknown")
              .otherwise(F.concat(_text(F.lit(1930) + (k * 7) % 90), F.lit("-01-15"))))
    out = rows.select(
        F.lit("Patient").alias("resourceType"),
        _null_if(k % NULL_PATIENT_ID_MOD == 0, F.concat(F.lit("pat-"), _text(k))).alias("id"),
        gender.alias("gender"),
        birth.alias("birthDate"),
        address.alias("address"),
    )
    return conform_raw(out, "Patient")


def raw_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounter resources, one per order."""
    o = spread(star(spark, sf_dir, "orders"), "o_orderkey")
    k = F.col("o_orderkey")
    type_arr = F.array(F.struct(F.array(F.struct(F.col("o_orderpriority").alias("display")))
                                .alias("coding")))
    out = o.select(
        F.lit("Encounter").alias("resourceType"),
        F.concat(F.lit("enc-"), _text(k)).alias("id"),
        F.struct(_patient_ref("o_custkey", "o_orderkey").alias("reference")).alias("subject"),
        F.struct(_case(F.col("o_orderstatus"), ENCOUNTER_CLASS).alias("code")).alias("class"),
        F.when(k % EMPTY_TYPE_MOD == 0, _empty(type_arr)).otherwise(type_arr).alias("type"),
        F.struct(_null_if(k % NULL_START_MOD == 0, _iso("o_orderdate")).alias("start"),
                 _null_if(k % NULL_END_MOD == 0, _iso("o_orderdate")).alias("end")).alias("period"),
    )
    return conform_raw(out, "Encounter")


def _line_orders_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Line items are the probe side (spread if under-split); orders and parts are
    # joined to them, broadcast when the planner's size estimate allows.
    li = spread(star(spark, sf_dir, "lineitem"), "l_orderkey")
    o = star(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = star(spark, sf_dir, "part")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(p, li.l_partkey == p.p_partkey))


def _condition() -> list[Column]:
    """A Condition resource of a joined line item."""
    k = F.col("l_orderkey")
    name = F.col("p_name")
    display = _case(F.col("p_type"),
                    [(t, F.concat(name, F.lit(sfx))) for t, sfx in NAME_SUFFIX]
                    + [(NAME_PLAIN_TYPE, name)])
    code = _null_if((k + F.col("l_linenumber")) % NULL_CODE_MOD == 0,
                    F.concat(F.lit("SCT"), _text(F.col("p_partkey") % CODE_MOD)))
    status = _case(F.col("l_returnflag"), CLINICAL_STATUS)
    return [
        F.lit("Condition").alias("resourceType"),
        F.concat(F.lit("cond-"), _text(k), F.lit("-"), _text("l_linenumber")).alias("id"),
        F.struct(_patient_ref("o_custkey", "l_orderkey").alias("reference")).alias("subject"),
        F.struct(F.array(F.struct(code.alias("code"), display.alias("display"))).alias("coding"))
         .alias("code"),
        F.when(status.isNotNull(),
               F.struct(F.array(F.struct(status.alias("code"))).alias("coding")))
         .alias("clinicalStatus"),
        _iso("l_shipdate").alias("onsetDateTime"),
    ]


def _medication_request() -> list[Column]:
    """A MedicationRequest resource of a joined line item."""
    k = F.col("l_orderkey")
    enc = F.concat(F.lit("enc-"), _text(k))
    dosage = F.array(F.struct(
        F.concat(_text(F.col("l_quantity").cast("int")), F.lit(" tablets")).alias("text")))
    return [
        F.lit("MedicationRequest").alias("resourceType"),
        _null_if(k % NULL_MED_ID_MOD == 0,
                 F.concat(F.lit("med-"), _text(k), F.lit("-"), _text("l_linenumber"))).alias("id"),
        _case(F.col("l_linestatus"), MED_STATUS).alias("status"),
        F.struct(F.concat(F.lit("Patient/pat-"), _text("o_custkey")).alias("reference"))
         .alias("subject"),
        F.struct(F.when(k % BARE_ENCOUNTER_MOD == 0, enc)
                  .otherwise(F.concat(F.lit("Encounter/"), enc)).alias("reference"))
         .alias("encounter"),
        F.struct(F.array(F.struct(F.concat(F.lit("RX"), _text("p_partkey")).alias("code"),
                                  F.col("p_name").alias("display"))).alias("coding"))
         .alias("medicationCodeableConcept"),
        F.when(k % BAD_AUTHORED_MOD == 0, F.lit("bad-date")).otherwise(_iso("l_shipdate"))
         .alias("authoredOn"),
        F.when(F.col("l_linenumber") == NO_DOSAGE_LINE, _empty(dosage)).otherwise(dosage)
         .alias("dosageInstruction"),
    ]


def raw_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Condition resources, one per line item."""
    return conform_raw(_line_orders_parts(spark, sf_dir).select(*_condition()), "Condition")


def raw_medication_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MedicationRequest resources, one per line item (ids repeat where the line key does)."""
    return conform_raw(_line_orders_parts(spark, sf_dir).select(*_medication_request()), "MedicationRequest")


def raw_line_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Condition, MedicationRequest): both resources of every line item, so that its order and part are joined once."""
    both = _line_orders_parts(spark, sf_dir).select(F.struct(*_condition()).alias("Condition"),
                                                    F.struct(*_medication_request()).alias("MedicationRequest"))
    # A cast that only changes what may be NULL would copy every resource.
    return both.select(*(F.col(f.name) if f.dataType.simpleString() == RAW[f.name].simpleString()
                         else F.col(f.name).cast(RAW[f.name]).alias(f.name) for f in both.schema))


RAW_BUILDERS = {
    "Patient": raw_patients,
    "Condition": raw_conditions,
    "Encounter": raw_encounters,
    "MedicationRequest": raw_medication_requests,
}
