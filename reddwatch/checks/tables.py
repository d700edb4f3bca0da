"""The driver's tables read as detections, sites, gauge readings and reports."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reddwatch import schemas
from reddwatch.functions.text import first_word
from reddwatch.operators.detections import (
    add_observation_calendar,
    add_release_calendar,
    latest_season,
)
from reddwatch.operators.joins import lookup_join
from reddwatch.params import SiteGroup
from reddwatch.session import workspace

GROUP_A = SiteGroup(
    name="A",
    members=("1-URGENT", "2-HIGH", "5-LOW"),
    presence=("1-URGENT", "2-HIGH"),
    entry=("1-URGENT",),
    home_release=("5", "6", "7", "8", "9", "10", "11", "12"),
)
GROUP_B = SiteGroup(
    name="B",
    members=("3-MEDIUM", "4-NOT", "5-LOW"),
    presence=("3-MEDIUM", "4-NOT"),
    entry=("4-NOT",),
    home_release=("13", "14", "15", "16", "17", "18", "19", "20"),
)
# The report of group A alone, with every site in it.
REPORT_A = replace(GROUP_A, all_sites=True)
TEMPERATURE_EVENT = "view"
DISCHARGE_EVENT = "click"


# The columns used; naming them saves a job that would infer the schema from a footer.
TABLE_SCHEMAS = {
    "orders": "o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string",
    "lineitem": "l_suppkey bigint, l_returnflag string",
    "part": "p_partkey bigint, p_type string, p_retailprice double",
    "events": "user_id bigint, ts timestamp_ntz, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def tag_code(key: Column) -> Column:
    return F.concat(F.lit("3DD."), F.lpad(F.hex(key), 10, "0"))


def release_date(key: Column) -> Column:
    return F.make_date(
        (F.lit(1995) + key % 7).cast("int"), (F.lit(1) + key % 12).cast("int"), F.lit(1)
    )


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release attributes per tag, from customers."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("marked_id"),
        F.col("c_nationkey").cast("string").alias("release_sitecode"),
        release_date(F.col("c_custkey")).alias("release_datetime"),
        # Whole millimetres, so that sums are exact in any order.
        F.floor("c_acctbal").cast("double").alias("length_mm"),
    )


def observations(orders: DataFrame) -> DataFrame:
    """Orders as observations of the customers' tags."""
    return add_observation_calendar(orders.select(
        F.col("o_custkey").alias("pit_id"),
        F.lit(None).cast("string").alias("rear_type"),
        F.when(F.col("o_orderstatus") == "F", "Adult").otherwise("Juvenile")
        .alias("release_lifestage"),
        first_word("o_orderpriority").alias("observation_sitecode"),
        F.col("o_orderdate").alias("observation_datetime"),
        *[c for c in orders.columns if c.startswith("_source")],
    ))


def with_marks(seen: DataFrame, mark_table: DataFrame) -> DataFrame:
    """Observations with the release attributes of their tag."""
    return add_release_calendar(
        lookup_join(seen, mark_table, [("pit_id", "marked_id")], how="inner")
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_marks(observations(table(spark, sf_dir, "orders")), marks(spark, sf_dir))


def latest_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest season, picked before the release attributes are joined."""
    return with_marks(
        latest_season(observations(table(spark, sf_dir, "orders"))), marks(spark, sf_dir)
    )


def downstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier keys of line items read as tags seen downstream."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("pit_id"))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as release sites; one region is without coordinates."""
    placed = F.col("n_regionkey") != 4
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("site_code"),
        F.col("n_name").alias("site_name"),
        F.when(placed, F.col("n_nationkey") * 1.5).cast("double").alias("latitude"),
        F.when(placed, F.col("n_regionkey") * 10.0 - 120).cast("double").alias("longitude"),
    )


def readings(spark: SparkSession, sf_dir: str, site: Column | None = None) -> DataFrame:
    """Events as gauge readings, of one gauge unless `site` tells several apart."""
    return table(spark, sf_dir, "events").select(
        (F.lit("G") if site is None else site.cast("string")).alias("site_no"),
        F.to_date("ts").alias("date"),
        F.col("event_type").alias("parameter_cd"),
        "value",
    )


def measured_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as individuals with a length; economy parts are the adults."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pit_id"),
        F.when(F.col("p_type") == "ECONOMY", "Adult").otherwise("Juvenile")
        .alias("release_lifestage"),
        F.col("p_retailprice").alias("length_mm"),
    )


def land_parts(spark: SparkSession, parts: list[DataFrame], purpose: str) -> str:
    """Write each part as a file of one folder, in their order, and return the folder."""
    folder = workspace(spark, purpose)
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as rows of a report."""
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    attributes = lookup_join(customers, nations, [("c_nationkey", "n_nationkey")], how="inner")
    rows = lookup_join(
        table(spark, sf_dir, "orders"),
        attributes.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment", "n_name"),
        [("o_custkey", "c_custkey")],
        how="inner",
    )
    header = schemas.REPORT_HEADERS
    length = (
        F.when(F.col("c_acctbal") < 0, "unmeasured")
        .when(F.col("c_mktsegment") == "MACHINERY", "NA")
        .when(F.col("c_mktsegment") == "BUILDING", "NaN")
        .otherwise(F.col("c_acctbal").cast("string"))
    )
    return rows.select(
        tag_code(F.col("o_custkey")).alias(header["tag"]),
        F.substring("c_mktsegment", 1, 1).alias(header["rear_type"]),
        F.concat_ws(" - ", F.col("c_nationkey"), F.col("n_name")).alias(header["release_site"]),
        F.when(F.col("o_orderstatus") == "F", "Adult").otherwise("Juvenile")
        .alias(header["lifestage"]),
        F.date_format(release_date(F.col("o_custkey")), "M/d/yyyy")
        .alias(header["release_date"]),
        F.col("o_orderpriority").alias(header["site"]),
        F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a").alias(header["obs_time"]),
        length.alias(header["length"]),
    )


def write_report(rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").options(header=True, encoding="UTF-16LE").csv(folder)


def land_report(spark: SparkSession, sf_dir: str) -> str:
    """Write the orders as UTF-16LE report files and return their folder."""
    folder = workspace(spark, "report")
    write_report(report_rows(spark, sf_dir), folder)
    return folder


def land_mixed_reports(spark: SparkSession, sf_dir: str) -> str:
    """The same rows in three shapes of report, by tag, and the nations as files that are no report."""
    rows = report_rows(spark, sf_dir)
    names = list(rows.columns)
    shape = F.pmod(F.xxhash64(schemas.REPORT_HEADERS["tag"]), F.lit(3))
    folder = workspace(spark, "mixed")
    write_report(rows.filter(shape == 0), folder)
    write_report(rows.filter(shape == 1).select(*reversed(names)), folder)
    write_report(rows.filter(shape == 2).select(F.lit("x").alias("Extra"), *names[::2], *names[1::2]), folder)
    write_report(table(spark, sf_dir, "nation").select(F.col("n_name").alias("Other"), F.lit("y").alias("Thing")), folder)
    return folder


def land_report_with_notes(spark: SparkSession, sf_dir: str) -> str:
    """The orders as report files with a column of notes that hold line breaks, commas and quotes."""
    rows = report_rows(spark, sf_dir)
    tag = F.col(schemas.REPORT_HEADERS["tag"])
    note = F.when(F.pmod(F.xxhash64(tag), F.lit(3)) == 0, F.concat(F.lit('seen "twice",\n\n"'), tag, F.lit('",\nand gone')))
    folder = workspace(spark, "notes")
    rows.withColumn("Notes", F.coalesce(note, F.lit('no "notes"'))).write.options(
        header=True, encoding="UTF-16LE", escape='"'
    ).csv(folder)
    return folder


def in_order(served: DataFrame, *keys: str) -> DataFrame:
    """The rows with their place within a key, in the order in which they are served."""
    served = served.withColumn("row", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("row"))
    return served.withColumn("place", place).drop("row")


def land_downstream(spark: SparkSession, sf_dir: str) -> str:
    """Write the line items' supplier tags as a downstream report."""
    folder = workspace(spark, "downstream")
    table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("Flag"),
        tag_code(F.col("l_suppkey")).alias(schemas.REPORT_HEADERS["tag"]),
    ).write.options(header=True, encoding="UTF-16LE").csv(folder)
    return folder


def land_watch_list(spark: SparkSession, sf_dir: str) -> str:
    """Write supplier tags and supplier names, the latter badly formed, as text lines."""
    suppliers = table(spark, sf_dir, "supplier")
    folder = workspace(spark, "watch")
    suppliers.select(tag_code(F.col("s_suppkey")).alias("value")).union(
        suppliers.select("s_name")
    ).write.text(folder)
    return folder


def as_longs(result: DataFrame) -> DataFrame:
    """Integers widened, so that counts and calendar parts have one type."""
    return result.select(*[
        F.col(f.name).cast("long").alias(f.name)
        if isinstance(f.dataType, T.IntegerType) else F.col(f.name)
        for f in result.schema.fields
    ])


def rounded(result: DataFrame, *columns: str, digits: int = 8) -> DataFrame:
    """Float results rounded, as sums depend on the order they are taken in."""
    return result.withColumns({c: F.round(c, digits) for c in columns})
