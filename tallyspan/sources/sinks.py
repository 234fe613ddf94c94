"""Sinks: merged upserts, replaced units, write-if-changed snapshots, exports with checksums, feeds."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.operators.diffs import digest
from tallyspan.session import materialize


def merge_rows(rows: DataFrame, keys: list[str], rules: dict[str, str], at: str) -> DataFrame:
    """One row per key whatever the input order: ``newest`` known value by ``at``, ``least``, ``most``, or ``any`` flag."""
    known = lambda c: F.when(F.col(c).isNotNull(), F.struct(at, c))
    make = {
        "newest": lambda c: F.max(known(c))[c],
        "oldest": lambda c: F.min(known(c))[c],
        "least": F.min,
        "most": F.max,
        "any": F.bool_or,
    }
    return rows.groupBy(*keys).agg(*[make[rule](c).alias(c) for c, rule in rules.items()])


def replace_units(stored: DataFrame, new: DataFrame, unit: str) -> DataFrame:
    """``stored`` with all rows of the units in ``new`` replaced by those; rows that a unit no longer has go."""
    return stored.join(new.select(unit).distinct(), unit, "left_anti").unionByName(new)


def write_if_changed(df: DataFrame, path: str) -> bool:
    """Write ``df`` as the newest generation under ``path`` unless the current one holds the same rows; says whether it wrote.

    Generations are folders; the pointer file is written last, so a failed
    write leaves the old one current.
    """
    spark = df.sparkSession
    old = current(spark, path)
    if old is not None and old.columns == df.columns and digest(old).first() == digest(df).first():
        return False
    number = 1 + max([0, *_generations(spark, path)])
    df.write.parquet(f"{path}/generation-{number}")
    spark.createDataFrame([(number,)], "generation int").coalesce(1).write.mode("append").parquet(f"{path}/pointer")
    return True


def _generations(spark: SparkSession, path: str) -> list[int]:
    try:
        return [r["g"] for r in spark.read.parquet(f"{path}/pointer").agg(F.max("generation").alias("g")).collect() if r["g"]]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []  # no pointer yet


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete generation, None before the first."""
    found = _generations(spark, path)
    return spark.read.parquet(f"{path}/generation-{found[0]}") if found else None


def export_csv(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Each table as gzipped CSV with a header, null as empty; returns the manifest ``(name, n, digest)``, written beside them last."""
    spark = next(iter(tables.values())).sparkSession
    manifest = None
    for name, df in tables.items():
        df = materialize(df, "export")  # its rows and its digest are those of one computation
        df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").option("compression", "gzip").csv(f"{path}/{name}")
        one = digest(df).withColumn("name", F.lit(name))
        manifest = one if manifest is None else manifest.unionByName(one)
    manifest.select("name", "n", "digest").coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return spark.read.schema("name string, n long, digest string").json(f"{path}/manifest")


def verify_export(spark: SparkSession, path: str, schemas: dict) -> DataFrame:
    """``(name, n, verified)``: every table of an export read back and held against the manifest; ``schemas`` names the types."""
    found = None
    for name, schema in schemas.items():
        rows = spark.read.schema(schema).option("header", True).option("nullValue", "").csv(f"{path}/{name}")
        one = digest(rows).select(F.lit(name).alias("name"), F.col("n").alias("__n"), F.col("digest").alias("__digest"))
        found = one if found is None else found.unionByName(one)
    manifest = spark.read.schema("name string, n long, digest string").json(f"{path}/manifest")
    same = F.coalesce((F.col("n") == F.col("__n")) & (F.col("digest") == F.col("__digest")), F.lit(False))
    return manifest.join(found, "name", "left").select("name", "n", same.alias("verified"))


def review_sheet(df: DataFrame, path: str) -> None:
    """A tab-separated sheet in one file, for people to fill in: for samples, not for tables."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def feed(facts: DataFrame, period: str, order: str, newest: int = 12) -> DataFrame:
    """``(period, entry)``: a JSON entry for each of the newest periods, its facts in order."""
    last = facts.select(period).distinct().orderBy(F.desc(period)).limit(newest)
    fields = [c for c in facts.columns if c != period]
    items = F.array_sort(F.collect_list(F.struct(order, *[c for c in fields if c != order]))).alias("facts")
    g = facts.join(last, period, "left_semi").groupBy(period).agg(items)
    return g.select(period, F.to_json(F.struct(F.lit(1).alias("schema_version"), period, "facts")).alias("entry"))


def rss_items(entries: DataFrame, period: str, title: str, link: str, finished: str) -> DataFrame:
    """``(period, item)``: RSS items of the finished periods."""
    item = F.struct(F.col(title).alias("title"), F.col(link).alias("link"), F.col(period).alias("guid"))
    return entries.filter(F.col(finished)).select(period, F.to_xml(item, {"rowTag": "item"}).alias("item"))
