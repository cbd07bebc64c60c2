"""Intermediate tables, row selection and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seismark.llm._bitmap import bitmap_of, sifted
from seismark.session import work_folder


#: Lets Spark delete a query's shuffle files as the query ends, not when the driver next collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of 4 MB between Spark and Python, unless the session sets a size.

    At the default, 64 MB, a batch of long texts lies in the JVM's direct memory, which grows by doubling,
    and in the Python worker, for every task of an executor at once.
    """
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, "4m")


def written(frame: DataFrame, label: str, free_shuffles: bool = False) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe from lost executors.

    With ``free_shuffles`` what was shuffled for it goes at once; the table no longer needs it.
    """
    spark = frame.sparkSession
    path = work_folder(spark, label)
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, str(free_shuffles or before == "true").lower())
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a ``written`` table; nothing may read it or what was derived from it unwritten."""
    context = table.sparkSession.sparkContext
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def remainder(id_column: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string")) % n


def text_hash(text_column: str) -> Column:
    """A hash of the text, a null one being empty."""
    return F.xxhash64(F.coalesce(text_column, F.lit("")))


def numbered(documents: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The columns under names of their own, which clash with none that an operator makes, and the
    new name of each."""
    names = {c: f"__{i}" for i, c in enumerate(documents.columns)}
    return documents.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def renamed_back(frame: DataFrame, names: dict[str, str]) -> DataFrame:
    return frame.select(*[F.col(n).alias(c) for c, n in names.items()])


def one_of_each(documents: DataFrame, groups: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each component of ``groups`` (text_hash, component), which names every text once.

    The row with the smallest id stays, null ids coming last; ties go by the hash of the text, then
    by that of the whole row, so what stays does not depend on the order of the rows.

    Rows and their texts stay where they are unless their component has several: only the row that
    stays of each of these moves, and few others that a bitmap cannot tell from it.
    """
    frame, names = numbered(documents)
    own, keys = F.col(names[id_column]), ["_text", "_row"]
    source = frame.withColumns({"_text": text_hash(names[text_column]), "_row": F.xxhash64(*names.values())})
    place = F.struct(own.isNull().alias("none"), own.alias("id"), F.col("_text").alias("text"), F.col("_row").alias("row"))
    first = source.groupBy(F.col("_text").alias("text_hash")).agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n"))
    named = first.join(groups, "text_hash")
    kept = named.groupBy("component").agg(F.min("place").alias("place"), F.sum("n").alias("n"))
    kept = written(kept, "one-of-each-kept", free_shuffles=True)
    several = kept.where("n > 1").select("component", F.lit(True).alias("several"))
    doubtful = bitmap_of(named.join(several, "component").select("text_hash"), "text_hash")
    chosen = kept.select(F.col("place.id").alias("_id"), F.col("place.text").alias("_text"), F.col("place.row").alias("_row"))
    alone = sifted(source, ("_text", doubtful), met=False)
    met = sifted(source, ("_text", doubtful), ("_row", bitmap_of(chosen, "_row"))).join(chosen, keys)
    # a text has one component, so these keys are those of the join and the texts move once
    stays = met.where(own.eqNullSafe(F.col("_id"))).dropDuplicates(keys)
    return renamed_back(alone.select(*names.values()).unionByName(stays.select(*names.values())), names)


def components(edges: DataFrame, label: str, rounds: int = 60, free: bool = False) -> DataFrame:
    """(node, component) of every node of an edge list (a, b), the smallest node naming it.

    Alternates large-star and small-star steps until the edges are stars that stay as they are.
    Minima are combined before the shuffle, and each round is a written table. With ``free`` the
    shuffles and the table of a round go when the next one is written.
    """
    spark = edges.sparkSession
    current = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label, free)
    state = None
    for _ in range(rounds):
        found = current.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state or not found[0]:
            break
        state = found
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        last, current = current, written(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), label, free)
        if free:
            discard(last)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def bounded_sample(frame: DataFrame, key: Column, limits: dict[object, int], counts: dict[object, int], salt: Column) -> DataFrame:
    """About twice ``limits[k]`` rows of each key value, chosen by a hash; small groups whole."""
    chance = F.lit(0.0)
    for value, limit in limits.items():
        chance = F.when(key == F.lit(value), F.lit(2.0 * limit / max(counts[value], 1))).otherwise(chance)
    return frame.where((F.pmod(salt, F.lit(1_000_000)) / 1e6) < chance)
