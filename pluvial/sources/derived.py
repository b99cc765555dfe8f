"""Raw-layer tables derived from the given TPC-H-like tables.

The warehouse lands clinical bundles, daily weather and a code table.  The
given test tables have no such data, so every raw table is a deterministic
Spark derivation of them (see FIXTURES.md): work and row counts grow with
the inputs, and DuckDB can build the same rows from the same files.

Fixed derivation rules (values that must stay as written so that the
oracle SQL builds the same rows):

- patients    <- customer x nation x region; one rounded location per nation,
                 every 50th customer (custkey % 50 = 49) without coordinates,
                 every 10th (custkey % 10 = 0) deceased
- encounters  <- orders; class EMER / IMP / AMB for priority 1-URGENT / 2-HIGH / other
- conditions  <- lineitem x orders, first row per (orderkey, linenumber) wins
- weather     <- lineitem x supplier, one series per supplier nation and ship day
- icd_codes   <- part, codes A00..A29 without A17
"""

from __future__ import annotations

import math
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvial import schemas
from pluvial.functions.exprs import round_half_up
from pluvial.operators.ranks import number_rows
from pluvial.operators.upsert import first_wins
from pluvial.session import tasks_for
from pluvial.sources.tables import Tables
from pluvial.sources.weather import clean_observations

# Fixed values of the derivation.
BIRTH_EPOCH = "1930-01-01"
DEATH_EPOCH = "2001-09-01"
NO_COORDS_MOD, NO_COORDS_REM = 50, 49
DECEASED_MOD = 10
PAIN_DISPLAYS = (
    "Chronic pain (finding)",        # l_partkey % 6 = 0
    "Joint pain (finding)",          # 1
    "Viral sinusitis (disorder)",    # 2
    "Hypertension",                  # 3
    "Prediabetes",                   # 4
    "Anemia (disorder)",             # 5
)
ICD_SYSTEM = "http://hl7.org/fhir/sid/icd-10"
SNOMED_SYSTEM = "http://snomed.info/sct"
ICD_LEFT_OUT = 17


def _ts(col: str):
    """Parquet timestamps load as timestamp_ntz; the warehouse uses zoned ones."""
    return F.col(col).cast("timestamp")


def patients(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    has_coords = F.expr(f"c_custkey % {NO_COORDS_MOD} <> {NO_COORDS_REM}")
    lat = F.expr("cast(40 + n_nationkey * 0.1 + (c_custkey % 3) * 0.00001 as double)")
    lon = F.expr("cast(-70 - n_nationkey * 0.1 - (c_custkey % 3) * 0.00001 as double)")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, F.col("n_regionkey") == r.r_regionkey)
        .select(
            F.concat(F.lit("p"), F.col("c_custkey").cast("string")).alias("id"),
            F.date_add(F.lit(BIRTH_EPOCH).cast("date"),
                       F.expr("cast(c_custkey * 37 % 22000 as int)")).alias("birthdate"),
            F.when(F.expr("c_custkey % 2 = 0"), "female").otherwise("male").alias("gender"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.when(has_coords, lat).alias("lat"),
            F.when(has_coords, lon).alias("lon"),
            F.when(F.expr(f"c_custkey % {DECEASED_MOD} = 0"),
                   F.date_add(F.lit(DEATH_EPOCH).cast("date"),
                              F.expr("cast(c_custkey % 365 as int)")).cast("timestamp"))
            .alias("deceased_datetime"),
        )
    )


def encounters(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                        "o_orderpriority")
    start = _ts("o_orderdate")
    end = F.when(
        F.expr("o_orderkey % 97 <> 0"),
        start + F.make_dt_interval(mins=F.expr("cast(o_orderkey % 180 as int)"),
                                   secs=F.expr("cast(o_orderkey % 60 as int)")),
    )
    has_reason = F.expr("o_orderkey % 3 = 0")
    return o.select(
        F.concat(F.lit("e"), F.col("o_orderkey").cast("string")).alias("encounter_id"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "EMER")
        .when(F.col("o_orderpriority") == "2-HIGH", "IMP").otherwise("AMB").alias("class_code"),
        F.concat(F.lit("T"), F.substring("o_orderpriority", 1, 1)).alias("type_code"),
        F.col("o_orderpriority").alias("type_display"),
        F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("patient_id"),
        start.alias("period_start"),
        end.alias("period_end"),
        F.concat(F.lit("Practitioner "), F.expr("cast(o_custkey % 40 as string)"))
        .alias("practitioner_display"),
        F.concat(F.lit("Clinic "), F.expr("cast(o_orderkey % 13 as string)"))
        .alias("location_display"),
        F.concat(F.lit("Provider "), F.expr("cast(o_custkey % 11 as string)"))
        .alias("service_provider_display"),
        F.when(has_reason, "R1").alias("reason_code"),
        F.when(has_reason, "Routine check").alias("reason_display"),
    )


def _condition_columns(resolved_flag: str = "l_returnflag"):
    display = None
    for i, name in enumerate(PAIN_DISPLAYS):
        cond = F.expr(f"l_partkey % 6 = {i}")
        display = F.when(cond, name) if display is None else display.when(cond, name)
    is_icd = F.expr("l_partkey % 5 = 0")
    resolved = F.col(resolved_flag) != "N"
    return [
        F.concat(F.lit("c"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("condition_id"),
        F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("patient_id"),
        F.when(F.col("l_linenumber") != 7,
               F.concat(F.lit("e"), F.col("l_orderkey").cast("string"))).alias("encounter_id"),
        F.when(resolved, "resolved").otherwise("active").alias("clinical_status"),
        F.lit("confirmed").alias("verification_status"),
        F.lit("encounter-diagnosis").alias("category_code"),
        F.when(is_icd, F.concat(F.lit("A"), F.lpad(F.expr("cast(l_partkey % 30 as string)"), 2, "0")))
        .otherwise(F.expr("cast(38341000 + l_partkey % 50 as string)")).alias("condition_code"),
        F.when(is_icd, ICD_SYSTEM).otherwise(SNOMED_SYSTEM).alias("condition_code_system"),
        display.alias("condition_display"),
        _ts("o_orderdate").alias("onset_datetime"),
        F.col("o_orderdate").cast("date").alias("recorded_date"),
        F.when(resolved, _ts("l_shipdate")).alias("abatement_datetime"),
    ]


LINEITEM_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_returnflag", "l_shipdate")
# "First" among lineitems sharing (orderkey, linenumber): this order, then an
# unreturned line (N) before a returned one.
LINE_ORDER = ("l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")


def condition_batch(t: Tables) -> DataFrame:
    """Every lineitem as a condition row (duplicate condition_ids included),
    with the lineitem's order columns (``_o_*``) that define "first"."""
    li = t.lineitem.select(*LINEITEM_COLS)
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        *_condition_columns(),
        *[F.col(c).alias(f"_o_{c[2:]}") for c in LINE_ORDER],
        (F.col("l_returnflag") != "N").alias("_o_returned"),
    )


CONDITION_ORDER = tuple(f"_o_{c[2:]}" for c in LINE_ORDER) + ("_o_returned",)


def conditions(t: Tables) -> DataFrame:
    """Raw conditions: the lineitem batch upserted into an empty table.

    Same rows as ``first_wins(condition_batch(t), ["condition_id"], ...)``,
    but the first-wins step runs on the numeric lineitem key before the
    join and before any string is built: condition_id is a one-to-one
    function of (l_orderkey, l_linenumber), and every condition column
    depends only on the winning line and its order.
    """
    li = t.lineitem.select(*LINEITEM_COLS).withColumn(
        "_returned", F.col("l_returnflag") != "N")
    # one exchange serves the first-wins window and the join; an order has few lines
    tasks = tasks_for(li.sparkSession, t.lineitem.count())     # from the files' footers
    first = first_wins(li.repartition(tasks, "l_orderkey"), ["l_orderkey", "l_linenumber"],
                       [*LINE_ORDER, "_returned"])
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return first.join(o, first.l_orderkey == o.o_orderkey).select(*_condition_columns())


def weather_observations(t: Tables) -> DataFrame:
    """Landed daily observations: one series per supplier nation and ship day."""
    li = t.lineitem.select("l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    daily = (
        li.join(s, li.l_suppkey == s.s_suppkey)
        .groupBy("s_nationkey", F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.avg("l_quantity").alias("q_avg"),
            F.min("l_quantity").alias("q_min"),
            F.max("l_quantity").alias("q_max"),
            F.min("l_suppkey").alias("s_min"),
            F.min("l_discount").alias("d_min"),
            F.max("l_tax").alias("t_max"),
        )
    )
    return daily.select(
        F.expr("cast(40 + s_nationkey * 0.1 as double)").alias("lat"),
        F.expr("cast(-70 - s_nationkey * 0.1 as double)").alias("lon"),
        "date",
        round_half_up(F.col("q_avg") - 15, 1).alias("tavg"),
        (F.col("q_min") - 15).alias("tmin"),
        (F.col("q_max") - 15).alias("tmax"),
        F.when(F.expr("s_min % 11 <> 0"), round_half_up(F.col("d_min") * 100, 1)).alias("prcp"),
        (F.lit(1000.0) + round_half_up(F.col("t_max") * 100, 1)).alias("pres"),
    )


def weather(t: Tables) -> DataFrame:
    """Raw weather = cleaned observations, still without their surrogate id."""
    return clean_observations(weather_observations(t))


def numbered_weather(t: Tables) -> DataFrame:
    """Raw weather as one load stores it: numbered by its natural key (A13)."""
    return number_rows(weather(t), schemas.KEYS["weather"], "id").select(*schemas.columns(schemas.WEATHER))


def icd_codes(t: Tables) -> DataFrame:
    p = t.part.select("p_partkey").select(F.expr("p_partkey % 30").alias("k"))
    return (
        p.where(F.col("k") != ICD_LEFT_OUT).distinct()
        .select(
            F.concat(F.lit("A"), F.lpad(F.col("k").cast("string"), 2, "0")).alias("code"),
            F.concat(F.lit("Title "), F.col("k").cast("string")).alias("title"),
            F.concat(F.lit("Codes of group "), F.col("k").cast("string")).alias("description"),
            F.when(F.col("k") < 10, "A00-A09").when(F.col("k") < 20, "A10-A19")
            .otherwise("A20-A29").alias("parent_code"),
        )
    )


class RawLayer:
    """The five raw tables of one input folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.tables = Tables(spark, sf_dir)

    @property
    def patients(self) -> DataFrame:
        return patients(self.tables)

    @property
    def encounters(self) -> DataFrame:
        return encounters(self.tables)

    @property
    def conditions(self) -> DataFrame:
        return conditions(self.tables)

    @property
    def weather(self) -> DataFrame:
        return weather(self.tables)

    @property
    def numbered_weather(self) -> DataFrame:
        return numbered_weather(self.tables)

    @property
    def icd_codes(self) -> DataFrame:
        return icd_codes(self.tables)

    def landed(self) -> "Landed":
        """The raw tables as written to the shared checkpoint folder (what jobs
        downstream of landing read), each when it is first asked for."""
        return Landed(self)


# --- upsert scenarios (B1, B2) ---------------------------------------------------
# The first condition load held lines shipped before this day; the next batch
# carries every line.
FIRST_LOAD_BEFORE = "1997-01-01"


def conditions_after_reload(t: Tables) -> DataFrame:
    """B1: conditions loaded once (lines shipped before FIRST_LOAD_BEFORE),
    then the whole lineitem batch upserted with ON CONFLICT DO NOTHING."""
    from pluvial.operators.upsert import upsert_ignore

    batch = condition_batch(t)
    target = first_wins(batch.where(F.col("_o_shipdate") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz")),
                        ["condition_id"], CONDITION_ORDER) \
        .select(*schemas.columns(schemas.CONDITIONS))
    return upsert_ignore(target, batch, ["condition_id"], CONDITION_ORDER)


def icd_revision_batch(t: Tables) -> DataFrame:
    """A revised code list: one row per part, so every code comes many times;
    the row of the highest part key (the latest) must win."""
    k = F.expr("p_partkey % 30")
    return t.part.select("p_partkey", "p_brand", "p_type").select(
        F.concat(F.lit("A"), F.lpad(k.cast("string"), 2, "0")).alias("code"),
        F.concat(F.lit("Title "), k.cast("string"), F.lit(" / "), F.col("p_brand")).alias("title"),
        F.col("p_type").alias("description"),
        F.when(k < 10, "A00-A09").when(k < 20, "A10-A19").otherwise("A20-A29").alias("parent_code"),
        F.col("p_partkey").alias("_revision"),
    )


def icd_after_revision(t: Tables) -> DataFrame:
    """B2: the code table after upserting the revision (ON CONFLICT DO UPDATE)."""
    from pluvial.operators.upsert import upsert_replace

    return upsert_replace(icd_codes(t), icd_revision_batch(t), ["code"], ["_revision"])


# --- observations with gaps (A12, B7, S19) ----------------------------------------
#: The nation whose series never lands; missing measures by day of the year.
LEFT_OUT_NATION = 3
MISSING_EVERY = {"tavg": 2, "prcp": 3, "pres": 5, "tmin": 7}


def gappy_observations(t: Tables) -> DataFrame:
    """Landed observations without one nation's, with measures missing: NaN on
    days that its number in ``MISSING_EVERY`` divides, NULL in even years.  Every 30th
    day has neither temperature nor rain nor pressure."""
    obs = weather_observations(t).where(
        F.col("lat") != F.expr(f"cast(40 + {LEFT_OUT_NATION} * 0.1 as double)"))
    none = F.when(F.year("date") % 2 == 0, F.lit(None).cast("double")).otherwise(F.lit(float("nan")))
    return obs.withColumns({m: F.when(F.dayofyear("date") % n == 0, none).otherwise(F.col(m))
                            for m, n in MISSING_EVERY.items()})


# --- bundles that cannot be read (A3) --------------------------------------------
#: What is wrong with a customer's bundle, by custkey modulo this number.
SPOILED_MOD = 13


def spoiled_bundles(t: Tables) -> DataFrame:
    """A bundle per customer (patient, visit, diagnosis) as a line; nine of
    thirteen kinds are spoiled, each in a way that a parser trips over."""
    key = F.col("c_custkey").cast("string")
    kind = F.col("c_custkey") % SPOILED_MOD
    subject = F.concat(F.lit('"subject":{"reference":"urn:uuid:p'), key, F.lit('"}'))
    patient = F.when(kind == 1, F.lit('{"resourceType":"Patient","gender":"male"}')) \
        .when(kind == 6, F.concat(F.lit('{"resourceType":"Patient","id":"p'), key, F.lit('","address":{"city":"x"}}'))) \
        .otherwise(F.concat(F.lit('{"resourceType":"Patient","id":"p'), key, F.lit('","gender":"male"}')))
    visit = F.concat(F.lit('{"resourceType":"Encounter",'),
                     F.when(kind == 9, F.lit('"id":null,')).otherwise(F.concat(F.lit('"id":"v'), key, F.lit('",'))),
                     F.when(kind == 7, F.lit('"period":"today",')).otherwise(F.lit('"period":{},')), subject, F.lit("}"))
    diagnosis = F.concat(F.lit('{"resourceType":"Condition","id":"d'), key, F.lit('",'),
                         F.when(kind == 8, F.lit('"subject":{"reference":12}')).otherwise(subject), F.lit("}"))
    entry = F.concat_ws(",", *(F.concat(F.lit('{"resource":'), r, F.lit("}")) for r in (patient, visit, diagnosis)),
                        F.when(kind == 4, F.lit('"a string"')), F.when(kind == 5, F.lit('{"resource":[]}')))
    whole = F.concat(F.lit('{"resourceType":"Bundle","entry":'),
                     F.when(kind == 3, F.lit("{}")).otherwise(F.concat(F.lit("["), entry, F.lit("]"))), F.lit("}"))
    return t.customer.select("c_custkey").select(
        F.when(kind == 2, F.substring(whole, 1, 60)).otherwise(whole).alias("value"))


# --- code hierarchy (A15, A16) ------------------------------------------------
# The root URL of the landed classification release, and the
# node kinds derived from ``part``:
#   root -> T-<type>     -> P<partkey>        (ordinal 1000 + 100*ascii(type) + length(type))
#   root -> BRAND<n>     -> P<partkey>        (ordinal 2n)
#   root -> <band*10>    -> SIZE<s> -> P<partkey>   (band = (size-1) div 10, ordinal 10*band + 3)
#   P<partkey> -> root, P<partkey> -> <band*10>     for size 50 (cycles)
HIERARCHY_ROOT = "http://id.example.org/icd/release/10/2019"
CYCLE_SIZE = 50


def _url(segment):
    return F.concat(F.lit(HIERARCHY_ROOT + "/"), segment)


def _part_nodes(t: Tables) -> DataFrame:
    p = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    band = F.floor((F.col("p_size") - 1) / 10).cast("int")
    return p.select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size",
        F.regexp_extract("p_brand", r"#(\d+)", 1).cast("int").alias("brand_n"),
        band.alias("band"),
        _url(F.concat(F.lit("P"), F.col("p_partkey").cast("string"))).alias("part_url"),
        _url(F.concat(F.lit("T-"), F.col("p_type"))).alias("type_url"),
        _url(F.concat(F.lit("BRAND"), F.regexp_extract("p_brand", r"#(\d+)", 1))).alias("brand_url"),
        _url((band * 10).cast("string")).alias("band_url"),
        _url(F.concat(F.lit("SIZE"), F.col("p_size").cast("string"))).alias("size_url"),
    )


def hierarchy_links(t: Tables) -> DataFrame:
    n = _part_nodes(t)
    root = F.lit(HIERARCHY_ROOT)
    cyc = n.where(F.col("p_size") == CYCLE_SIZE)
    parts = [
        n.select(root.alias("parent_url"), F.col("type_url").alias("child_url"),
                 (F.lit(1000) + F.ascii("p_type") * 100 + F.length("p_type")).cast("bigint")
                 .alias("ordinal")).distinct(),
        n.select(root.alias("parent_url"), F.col("brand_url").alias("child_url"),
                 (F.col("brand_n") * 2).cast("bigint").alias("ordinal")).distinct(),
        n.select(root.alias("parent_url"), F.col("band_url").alias("child_url"),
                 (F.col("band") * 10 + 3).cast("bigint").alias("ordinal")).distinct(),
        n.select(F.col("band_url").alias("parent_url"), F.col("size_url").alias("child_url"),
                 F.col("p_size").cast("bigint").alias("ordinal")).distinct(),
        n.select(F.col("type_url").alias("parent_url"), F.col("part_url").alias("child_url"),
                 F.col("p_partkey").alias("ordinal")),
        n.select(F.col("brand_url").alias("parent_url"), F.col("part_url").alias("child_url"),
                 F.col("p_partkey").alias("ordinal")),
        n.select(F.col("size_url").alias("parent_url"), F.col("part_url").alias("child_url"),
                 F.col("p_partkey").alias("ordinal")),
        cyc.select(F.col("part_url").alias("parent_url"), root.alias("child_url"),
                   F.lit(0).cast("bigint").alias("ordinal")),
        cyc.select(F.col("part_url").alias("parent_url"), F.col("band_url").alias("child_url"),
                   F.lit(1).cast("bigint").alias("ordinal")),
    ]
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out


def _value(col):
    return F.struct(col.alias("@value"))


def hierarchy_documents(t: Tables) -> DataFrame:
    """Landed entity documents (url, doc) as the classification API serves them."""
    n = _part_nodes(t)
    spark = t.spark
    root = spark.range(1).select(
        F.lit(HIERARCHY_ROOT).alias("url"),
        F.to_json(F.struct(_value(F.lit("ICD-10 release 2019")).alias("title"))).alias("doc"))
    types = n.select("type_url", "p_type").distinct().select(
        F.col("type_url").alias("url"),
        F.to_json(F.struct(F.concat(F.lit("T-"), F.col("p_type")).alias("code"),
                           _value(F.col("p_type")).alias("title"),
                           _value(F.concat(F.lit("Parts of type "), F.col("p_type")))
                           .alias("definition"))).alias("doc"))
    brands = n.select("brand_url", "brand_n", "p_brand").distinct().select(
        F.col("brand_url").alias("url"),
        F.to_json(F.struct(F.concat(F.lit("BRAND"), F.col("brand_n").cast("string")).alias("code"),
                           _value(F.col("p_brand")).alias("title"),
                           F.concat(F.lit("Brand number "), F.col("brand_n").cast("string"))
                           .alias("definition"))).alias("doc"))
    bands = n.select("band_url", "band").distinct().select(
        F.col("band_url").alias("url"),
        F.to_json(F.struct(_value(F.concat(F.lit("Sizes from "),
                                           (F.col("band") * 10 + 1).cast("string")))
                           .alias("title"))).alias("doc"))
    sizes = n.select("size_url", "p_size").distinct().select(
        F.col("size_url").alias("url"),
        F.to_json(F.struct(F.concat(F.lit("SIZE"), F.col("p_size").cast("string")).alias("code"),
                           _value(F.concat(F.lit("Size "), F.col("p_size").cast("string")))
                           .alias("title"))).alias("doc"))
    parts = n.select(
        F.col("part_url").alias("url"),
        F.to_json(F.struct(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("code"),
                           _value(F.col("p_name")).alias("title"),
                           _value(F.col("p_type")).alias("definition"))).alias("doc"))
    return root.unionByName(types).unionByName(brands).unionByName(bands) \
        .unionByName(sizes).unionByName(parts)


def icd_from_hierarchy(t: Tables) -> DataFrame:
    """A15 + A16: parse the landed documents and flatten the hierarchy."""
    from pluvial.sources.hierarchy import flatten, parse_entities

    entities = parse_entities(hierarchy_documents(t))
    return flatten(t.spark, entities, hierarchy_links(t), HIERARCHY_ROOT)


#: The landed classification whose documents list their children: node k, of a part
#: key, has the children 10 k .. 10 k + 9, and lists the first child of k + 1 as well,
#: if k + 1 has as many digits.  So shared children are found by two parents.
NUMBERED_ROOT = "http://id.example.org/numbers/release/11/2024"


def numbered_documents(t: Tables) -> DataFrame:
    """Entity documents (url, doc) with ``child`` arrays; part keys are 1, 2, ... n."""
    last = t.part.agg(F.max("p_partkey").alias("last"))

    def url(k: Column) -> Column:
        return F.concat(F.lit(f"{NUMBERED_ROOT}/N"), k.cast("string"))

    def present(keys: Column) -> Column:
        return F.transform(F.filter(keys, lambda k: (k >= 1) & (k <= F.col("last"))), url)

    k = F.col("p_partkey")
    after = F.when(F.length((k + 1).cast("string")) == F.length(k.cast("string")), F.array(k * 10 + 10))
    own = F.concat(F.sequence(k * 10, k * 10 + 9), F.coalesce(after, F.array().cast("array<bigint>")))
    nodes = t.part.select("p_partkey", "p_name", "p_type").join(last).select(
        url(k).alias("url"),
        F.to_json(F.struct(F.concat(F.lit("N"), k.cast("string")).alias("code"), _value(F.col("p_name")).alias("title"),
                           _value(F.col("p_type")).alias("definition"), present(own).alias("child"))).alias("doc"))
    root = last.select(
        F.lit(NUMBERED_ROOT).alias("url"),
        F.to_json(F.struct(_value(F.lit("Numbers")).alias("title"),
                           present(F.sequence(F.lit(1).cast("bigint"), F.lit(9).cast("bigint"))).alias("child"))).alias("doc"))
    return root.unionByName(nodes)


#: Documents of one task, about.
TASK_DOCUMENTS = 20_000


def landed_documents(t: Tables) -> DataFrame:
    """``numbered_documents`` as landed: written once, in tasks by their number (the
    part table is a small file, so that few tasks would derive them, again for each level)."""
    from pluvial.session import reliable_checkpoint

    tasks = math.ceil((t.part.count() + 1) / TASK_DOCUMENTS)
    spread = SimpleNamespace(part=t.part.select("p_partkey", "p_name", "p_type").repartition(tasks, "p_partkey"))
    return reliable_checkpoint(numbered_documents(spread))


def codes_by_walk(t: Tables) -> DataFrame:
    """A15 + A16 over documents that list their children, by the frontier loop."""
    from pluvial.sources.hierarchy import flatten, links_from_documents, parse_entities

    docs = landed_documents(t)
    return flatten(t.spark, parse_entities(docs), links_from_documents(docs), NUMBERED_ROOT)


def codes_by_recursion(t: Tables) -> DataFrame:
    """The same codes by a recursive query."""
    from pluvial.sources.hierarchy import flatten, links_from_documents, parse_entities, walk_recursive

    docs = landed_documents(t)
    return flatten(t.spark, parse_entities(docs), links_from_documents(docs), NUMBERED_ROOT, walk_recursive)


#: The mapping of clinical codes to classification codes that K7 takes (a choice of
#: ours: the first thirty numbers of the clinical codes).
MAPPED_CODES = 30


def code_mapping(t: Tables) -> DataFrame:
    """(from_code, to_code): clinical code 38341000 + k stands for A<k>, k below 30."""
    k = F.expr("p_partkey % 50")
    return t.part.select(k.alias("k")).where(F.col("k") < MAPPED_CODES).distinct().select(
        F.expr("cast(38341000 + k as string)").alias("from_code"),
        F.concat(F.lit("A"), F.lpad(F.col("k").cast("string"), 2, "0")).alias("to_code"))


class Landed:
    """Raw tables written on first use, as attributes."""

    def __init__(self, raw: RawLayer):
        self._raw = raw

    def __getattr__(self, name: str) -> DataFrame:
        from pluvial.session import reliable_checkpoint

        if name.startswith("_"):
            raise AttributeError(name)
        table = reliable_checkpoint(getattr(self._raw, name))
        setattr(self, name, table)
        return table


def with_orphans(raw) -> SimpleNamespace:
    """The clinical tables without the patients whose id ends with 3, and with
    visits whose id ends with 7 that name no patient."""
    return SimpleNamespace(
        patients=raw.patients.where(~F.col("id").endswith("3")),
        encounters=raw.encounters.withColumn(
            "patient_id", F.when(~F.col("encounter_id").endswith("7"), F.col("patient_id"))),
        conditions=raw.conditions)


def damaged(raw) -> SimpleNamespace:
    """The raw tables with planted faults: patients missing (orphans), visits
    twice (duplicates), conditions without a key, and swapped temperatures."""
    enc, swap = raw.encounters, F.dayofmonth("date") == 13
    return SimpleNamespace(
        patients=raw.patients.where(~F.col("id").endswith("17")),
        encounters=enc.unionByName(enc.where(F.col("encounter_id").endswith("01"))),
        conditions=raw.conditions.withColumn(
            "condition_id", F.when(~F.col("condition_id").endswith("5"), F.col("condition_id"))),
        weather=raw.weather.withColumns({
            "tmin": F.when(swap, F.col("tmax") + 1).otherwise(F.col("tmin")),
            "tmax": F.when(swap, F.col("tmin") - 1).otherwise(F.col("tmax"))}),
        icd_codes=raw.icd_codes)
