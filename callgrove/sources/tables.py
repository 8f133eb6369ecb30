"""Reading and writing a stored profile collection."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callgrove import model
from callgrove.errors import KeyCheckError
from callgrove.plans.lineage import remove_folder
from callgrove.plans.lookup import lookup, measured_bytes

if TYPE_CHECKING:
    from callgrove.profile import Profile

#: Folder that tells a collection whose keys were checked.
CHECKED = "checked"
#: Folder layout: readers that ask for an experiment or a metric skip the rest.
PARTITIONS = {"facts": ["experiment_id", "metric"], "cnodes": ["experiment_id"]}
#: Order of the rows of a file below its partition columns, by which writers sort anyway.
_ORDER = {"facts": ["cnode_id", "thread_id"], "cnodes": ["cnode_id"]}


def read(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Open the five tables below ``path``, checking their columns and types."""
    return {name: _open(spark, path, name) for name in model.TABLES}


def _open(spark: SparkSession, path: str, name: str) -> DataFrame:
    folder = f"{path.rstrip('/')}/{name}"
    try:
        found = spark.read.parquet(folder).schema
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no table {name!r} in {path}") from exc
        raise
    wanted = model.TABLES[name]
    if name == "cnodes" and set(model.PATH_COLUMNS.fieldNames()) <= set(found.fieldNames()):
        wanted = model.TREE
    partitions = PARTITIONS.get(name, [])
    for field in wanted:
        if field.name not in found.fieldNames():
            raise ValueError(f"table {name!r} in {path} lacks column {field.name!r}")
        kind = found[field.name].dataType
        if field.name not in partitions and not _same_type(kind, field.dataType):
            raise ValueError(
                f"column {field.name!r} of table {name!r} is {kind.simpleString()},"
                f" expected {field.dataType.simpleString()}"
            )
    return spark.read.schema(wanted).parquet(folder).select(wanted.fieldNames())


def _same_type(found: T.DataType, wanted: T.DataType) -> bool:
    return found.simpleString() == wanted.simpleString()


def write(profile: Profile, path: str) -> None:
    """Store the tables in new folders below ``path``; existing ones are an error.

    Facts of a thread without a location are refused: no operation could place them.
    Facts of unknown nodes may stay, all operations leave them out.  The job that writes the
    facts counts the former, so the facts are computed once and not moved to meet the nodes;
    the latter are counted by the two key columns as they are stored.

    Rows are rebalanced on the partition columns: small experiments do not end up
    in many files, and one that holds a large share of all rows is split over tasks.
    """
    folder = path.rstrip("/")
    facts, unknown = _observed_facts(profile)
    _write_table(facts, "facts", folder)
    if unknown.get["threads"]:
        remove_folder(profile.facts.sparkSession, f"{folder}/facts")
        _remove_if_empty(profile.facts.sparkSession, folder)
        _refuse(unknown.get["threads"], unknown.get["example"])
    for name in ("experiments", "metrics", "locations"):
        _write_table(getattr(profile, name), name, folder)
    _write_table(profile.tree.select(model.TREE.fieldNames()), "cnodes", folder)
    spark = profile.facts.sparkSession
    nodes = _facts_of_unknown_nodes(spark, folder)
    marker = spark.range(1).select(F.lit(nodes).cast("long").alias("unknown_nodes"))
    marker.coalesce(1).write.parquet(f"{folder}/{CHECKED}")


def _write_table(frame: DataFrame, name: str, folder: str) -> None:
    schema = model.TREE if name == "cnodes" else model.TABLES[name]
    typed = frame.select(*(F.col(f.name).cast(f.dataType) for f in schema))
    keys = PARTITIONS.get(name, [])
    balanced = typed.hint("rebalance", *keys)
    if keys:
        balanced = balanced.sortWithinPartitions(*keys, *_ORDER[name])
    writer = balanced.write.mode("errorifexists")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(f"{folder}/{name}")


def _observed_facts(profile: Profile) -> tuple[DataFrame, Observation]:
    """The facts, and what the job that writes them sees of their threads.

    ``threads`` is the number of facts whose thread is unknown.
    """
    places = profile.locations.select("experiment_id", "thread_id").distinct()
    places = places.withColumn("_place", F.lit(True))
    with_places = lookup(
        profile.facts,
        places,
        ["experiment_id", "thread_id"],
        table_bytes=measured_bytes(places, 32),
        spread=["metric", "cnode_id"],
        how="left",
    )
    lost = F.col("_place").isNull()
    seen = Observation()
    observed = with_places.observe(
        seen,
        F.count_if(lost).alias("threads"),
        F.min(F.when(lost, F.struct("experiment_id", "thread_id"))).alias("example"),
    )
    return observed.drop("_place"), seen


def _facts_of_unknown_nodes(spark: SparkSession, folder: str) -> int:
    """Number of stored facts whose node is not in the stored tree.

    Facts are counted by node, combined before the shuffle, and only the counts meet the nodes.
    """
    keys = ["experiment_id", "cnode_id"]
    used = _open(spark, folder, "facts").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    unknown = used.join(_open(spark, folder, "cnodes").select(*keys), keys, "left_anti")
    return unknown.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _remove_if_empty(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(folder) and not len(system.listStatus(folder)):
        system.delete(folder, False)


def _refuse(n: int, example) -> None:
    raise KeyCheckError(
        f"{n} facts of threads without a location, e.g. thread {example['thread_id']}"
        f" of experiment {example['experiment_id']}"
    )


def refuse_unknown_threads(profile: Profile) -> None:
    """Raise where facts have threads without a location.

    One job: threads are few, so they are aggregated before they meet the locations.
    """
    keys = ["experiment_id", "thread_id"]
    used = profile.facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    unknown = used.join(profile.locations.select(*keys), keys, "left_anti")
    n, example = unknown.agg(F.coalesce(F.sum("n"), F.lit(0)), F.min(F.struct(*keys))).first()
    if n:
        _refuse(n, example)


def unknown_nodes(spark: SparkSession, path: str) -> int | None:
    """Facts of unknown nodes in a collection that :func:`write` made and so checked.

    ``None`` for other collections.  Whoever adds facts to one by other means has to remove
    its folder ``checked``.
    """
    try:
        row = spark.read.schema("unknown_nodes long").parquet(f"{path.rstrip('/')}/{CHECKED}").first()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if row is None else row.unknown_nodes
