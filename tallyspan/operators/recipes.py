"""Published recipes: one SQL text each, run as it stands, with the columns it declares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyspan.tables import table


@dataclass(frozen=True)
class Recipe:
    """A documented query. ``tables`` are what its text reads; ``columns`` what it gives, in order."""

    recipe_id: str
    sql: str
    tables: tuple[str, ...]
    columns: tuple[str, ...]


def run(spark: SparkSession, sf_dir: str, recipe: Recipe) -> DataFrame:
    """The recipe's rows; an error names it, and so does a column that it doesn't declare."""
    for t in recipe.tables:
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    try:
        out = spark.sql(recipe.sql)
    except Exception as e:
        raise ValueError(f"recipe {recipe.recipe_id}: {e}") from e
    if tuple(out.columns) != recipe.columns:
        raise ValueError(f"recipe {recipe.recipe_id}: columns {out.columns}, declared {list(recipe.columns)}")
    return out
