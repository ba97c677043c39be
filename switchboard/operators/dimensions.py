"""Dimension builds: surrogate keys, key lookup, org tree, primary contact, calendar.

Surrogate keys are ``xxhash64`` of a namespace and the natural key rather
than a global ``row_number()``: a global numbering needs one ordered
partition (the whole dimension in one task), a hash is computed row by row
and is stable across rebuilds. Collisions of a 64-bit hash are ignored here;
``key_registry`` gives keys without collisions from a stored registry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.operators.history import pick_max
from switchboard.session import fresh_path


def with_surrogate_key(dim: DataFrame, sk_col: str, natural_key: list[str], namespace: str) -> DataFrame:
    return dim.withColumn(sk_col, F.xxhash64(F.lit(namespace), *[F.col(c) for c in natural_key]))


def lookup_keys(fact: DataFrame, dims: list[tuple[DataFrame, list[str], str]]) -> DataFrame:
    """Replace natural keys of the fact by surrogate keys (left join: unknown keys → NULL sk)."""
    out = fact
    for dim, nk, sk in dims:
        out = out.join(dim.select(*nk, sk), nk, "left").drop(*nk)
    return out


def resolve_keys(fact: DataFrame, dims: list[tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Surrogate keys back to natural keys through the dimensions."""
    out = fact
    for dim, sk, nk in dims:
        out = out.join(dim.select(sk, *nk), sk, "left").drop(sk)
    return out


# Fixed-date US holidays as (month, day): New Year's Day, Independence Day, Christmas Day.
US_FIXED_HOLIDAYS = [(1, 1), (7, 4), (12, 25)]

# Org unit id ranges per level (level * 10^12 + natural key).
ORG_LEVEL_BASE = 1_000_000_000_000


def org_units(region: DataFrame, nation: DataFrame, supplier: DataFrame) -> DataFrame:
    """root → region → nation → supplier as one parent-pointer table."""
    b = ORG_LEVEL_BASE
    root = region.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("org_unit_id"), F.lit(None).cast("bigint").alias("parent_unit_id"),
        F.lit("ROOT").alias("unit_code"), F.lit("ROOT").alias("unit_name"), F.lit("ROOT").alias("unit_type"))
    regions = region.select(
        (F.lit(b) + F.col("r_regionkey")).cast("bigint").alias("org_unit_id"),
        F.lit(0).cast("bigint").alias("parent_unit_id"),
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("unit_code"),
        F.col("r_name").alias("unit_name"), F.lit("REGION").alias("unit_type"))
    nations = nation.select(
        (F.lit(2 * b) + F.col("n_nationkey")).cast("bigint").alias("org_unit_id"),
        (F.lit(b) + F.col("n_regionkey")).cast("bigint").alias("parent_unit_id"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("unit_code"),
        F.col("n_name").alias("unit_name"), F.lit("NATION").alias("unit_type"))
    sites = supplier.select(
        (F.lit(3 * b) + F.col("s_suppkey")).cast("bigint").alias("org_unit_id"),
        (F.lit(2 * b) + F.col("s_nationkey")).cast("bigint").alias("parent_unit_id"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("unit_code"),
        F.col("s_name").alias("unit_name"), F.lit("SITE").alias("unit_type"))
    return root.unionByName(regions).unionByName(nations).unionByName(sites)


def org_paths(units: DataFrame, unit: str = "org_unit_id", parent: str = "parent_unit_id",
              name: str = "unit_name", carry: list[str] | None = None) -> DataFrame:
    """(unit, ``carry`` columns, path, is_cyclic): the names from the root down to each unit, at any depth.

    Pointer doubling: a unit knows the names of a stretch above it and the unit
    that stands above the stretch; each round puts the stretch of that unit in
    front, so lengths double and a tree of depth d takes about log2(d) rounds,
    where a join per level takes d. Every round is one join on the unit id and
    is written to the shared folder, so the plan does not grow.

    In every round the units that are nearest to the root among the open ones
    end. A round in which no unit ends shows that the open ones stand on a
    cycle of parents or below one: their ``path`` is NULL and ``is_cyclic`` true.
    A parent that is not among the units ends a path, like a NULL parent. Unit
    ids are unique, but for NULL ones, which no unit has as its parent.
    """
    spark, kept = units.sparkSession, [unit, *(carry or [])]

    def stored(df: DataFrame) -> DataFrame:
        path = fresh_path(spark, "org-paths")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    ids = units.select(F.col(unit).alias("_known"))
    cur = stored(units.join(ids, F.col(parent) == F.col("_known"), "left")
                 .select(*kept, F.col("_known").alias("_above"), F.array(name).alias("path")))
    is_open = F.col("_above").isNotNull()
    left = cur.where(is_open).count()
    while left:
        top = cur.select(F.col(unit).alias("_above"), F.col("_above").alias("_next"), F.col("path").alias("_front"))
        # only open units meet the join; the others would all meet at NULL
        longer = cur.where(is_open).join(top, "_above").select(
            *kept, F.col("_next").alias("_above"), F.concat("_front", "path").alias("path"))
        cur = stored(longer.unionByName(cur.where(~is_open)))
        before, left = left, cur.where(is_open).count()
        if left == before:
            break
    return cur.select(*kept, F.when(~is_open, F.col("path")).alias("path"), is_open.alias("is_cyclic"))


def flatten_org(units: DataFrame, depth: int = 4) -> DataFrame:
    """Each unit with the names on its path from the root, as level1..levelN.

    Level 1 is the root whatever the unit's depth; names below level N are in
    ``org_paths`` only. Units on or below a cycle have no levels.
    """
    shown = ["unit_code", "unit_name", "unit_type"]
    levels = [F.get(F.col("path"), i).alias(f"level{i + 1}_name") for i in range(depth)]
    return org_paths(units, carry=shown).select("org_unit_id", *shown, *levels)


def primary_contact(contacts: DataFrame, client_col: str, rank: list[Column]) -> DataFrame:
    """Per client, the contact ranked first (greatest ``rank`` tuple), as a map-side-combined aggregate."""
    best = pick_max(contacts, [client_col], rank, ["contact_id", "full_name", "email"])
    return best.select(client_col, "contact_id", F.col("full_name").alias("primary_contact_name"),
                       F.col("email").alias("primary_contact_email"))


def calendar_columns() -> list[Column]:
    """Columns of dim_date for a frame holding one row per day in ``full_date_d`` (DATE)."""
    d = F.col("full_date_d")
    return [
        F.date_format(d, "yyyyMMdd").cast("bigint").alias("date_key"),
        F.date_format(d, "yyyy-MM-dd").alias("full_date"),
        # ISO day of week: Monday 1 .. Sunday 7
        (((F.dayofweek(d) + 5) % 7) + 1).cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).cast("bigint").alias("week_of_year"),
        F.month(d).cast("bigint").alias("month_no"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("bigint").alias("quarter_no"),
        F.year(d).cast("bigint").alias("year_no"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        _holiday(d).alias("is_holiday_us"),
        F.concat(F.year(d).cast("string"), F.lit("-P"), F.lpad(F.month(d).cast("string"), 2, "0"))
        .alias("fiscal_period"),
    ]


def _holiday(d: Column) -> Column:
    out = F.lit(False)
    for m, day in US_FIXED_HOLIDAYS:
        out = out | ((F.month(d) == m) & (F.dayofmonth(d) == day))
    return out


def date_spine(bounds: DataFrame, first_col: str, last_col: str) -> DataFrame:
    """One row per day between the bounds (inclusive), generated per bounds row."""
    return bounds.select(F.explode(F.sequence(F.col(first_col), F.col(last_col),
                                              F.expr("INTERVAL 1 DAY"))).alias("full_date_d"))

