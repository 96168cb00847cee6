"""Versioned publication: all tables of a run are switched to at once, by a manifest that is written last.

Tables lie under path/data/<version>/<name>, manifests under path/manifests/version=<version>, one row a table. A reader
takes the newest version that has a whole manifest: a run that ends between two tables leaves it on the version before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "name string, tables int, schema_version string, version string"


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """The manifests at path, a row a table: name, tables (how many the version has), schema_version, version; none where nothing was published."""
    try:
        return spark.read.schema(MANIFEST).json(f"{path}/manifests")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], MANIFEST)


def newest(spark: SparkSession, path: str) -> str | None:
    """The newest version, in the order of names, all of whose tables its manifest has."""
    whole = manifests(spark, path).groupBy("version").agg(F.count("*").alias("n"), F.max("tables").alias("tables")).where("n = tables")
    return whole.agg(F.max("version")).first()[0]


def publish(tables: dict[str, tuple[DataFrame, str]], path: str, version: str) -> bool:
    """Write tables (name to table and schema version) as one version; False, and nothing, if it is there already.

    A version that an earlier try left without a manifest is written anew.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    if not manifests(spark, path).where(F.col("version") == version).isEmpty():
        return False
    for name, (df, _) in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/data/{version}/{name}")
    rows = [(name, len(tables), schema) for name, (_, schema) in sorted(tables.items())]
    spark.createDataFrame(rows, "name string, tables int, schema_version string").coalesce(1).write.mode("overwrite").json(f"{path}/manifests/version={version}")
    return True


def current(spark: SparkSession, path: str, name: str, schema: StructType | str, schema_version: str) -> DataFrame:
    """A table of the newest version; empty, with this schema, if there is none or it was written under another schema version."""
    version = newest(spark, path)
    if version is not None:
        found = manifests(spark, path).where((F.col("version") == version) & (F.col("name") == name)).first()
        if found is not None and found["schema_version"] == schema_version:
            return spark.read.schema(schema).parquet(f"{path}/data/{version}/{name}")
    return spark.createDataFrame([], schema)
