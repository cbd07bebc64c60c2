"""Append newly landed files to a table, each file once."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismark.plans.curate import EARLY_END, GOOD, MARKS, OUTCOME, curate_flagged
from seismark.plans.loads import load_documents, load_folder
from seismark.schema import SOURCE
from seismark.sinks.files import append_load
from seismark.sinks.staging import check, loads_of, lost_records, stage
from seismark.sources.documents import read_landing_geojson

Reader = Callable[..., DataFrame]


def _run(spark: SparkSession, landing: str, checkpoint: str, reader: Reader, max_files: int, publish: Callable[[DataFrame, int], None]) -> None:
    """Hand the documents of every file not yet seen to ``publish``, batch by batch, then stop."""
    landed = reader(spark, landing, streaming=True, maxFilesPerTrigger=max_files)
    of_batch = getattr(reader, "of_batch", None) or (lambda documents: documents)
    query = (
        landed.writeStream.foreachBatch(lambda rows, batch: publish(of_batch(rows), batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def incremental_append(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    reader: Reader = read_landing_geojson,
    name: str = "stream",
    max_files_per_batch: int = 1000,
    max_lost: int = 0,
) -> None:
    """Curate every landed file not yet seen, append its rows to the folder ``target``, then stop.

    The checkpoint remembers which files belong to which batch, and a batch is written as the
    partition ``load_id=<name>-<batch>``. A batch that is repeated after a crash therefore
    replaces its own rows. History loads written by ``append_load`` live beside it. A batch that
    loses more than ``max_lost`` documents and features stops the run; what was lost lies below
    ``target/_staged``.
    """

    def publish(documents: DataFrame, batch_id: int) -> None:
        load = f"{name}-{batch_id:08d}"
        staged = stage(curate_flagged(documents), load_folder(f"{target}/_staged", load))
        check(staged, max_lost, refuse_empty=False)
        append_load(staged.side(spark, GOOD).drop(*MARKS), target, load)

    _run(spark, landing, checkpoint, reader, max_files_per_batch, publish)


def incremental_load(
    spark: SparkSession,
    landing: str,
    silver: str,
    table: str,
    checkpoint: str,
    reader: Reader = read_landing_geojson,
    name: str = "stream",
    max_files_per_batch: int = 1000,
    **options,
) -> None:
    """Load every landed file not yet seen into the table that the scheduled loads fill, then stop.

    A batch is the load ``<name>-<batch>`` of the table: repeated after a crash, also one between
    publishing and the checkpoint, it takes the place of its own rows. ``options`` as in
    ``load_documents``.

    A file whose document is unfinished, as ``read_landing_split`` can tell, gives no rows yet. It is
    noted, and looked at again at the end of this and every later run, until its document is complete:
    then it is a load of its own.
    """
    noted = f"{silver.rstrip('/')}/_unfinished-{name}"

    def publish(documents: DataFrame, batch_id: int) -> None:
        load = f"{name}-{batch_id:08d}"
        done = load_documents(documents, silver, table, load, hold=True, **options)
        if done.unfinished:
            early = lost_records(spark, done.folder, SOURCE).where(F.col(OUTCOME) == EARLY_END)
            append_load(early.select(SOURCE), noted, load)

    _run(spark, landing, checkpoint, reader, max_files_per_batch, publish)
    for file, load in _still_noted(spark, noted, table, name):
        load_documents(reader(spark, file), silver, table, load, hold=True, **options)


def _still_noted(spark: SparkSession, noted: str, table: str, name: str) -> list[tuple[str, str]]:
    """(file, load id) of the noted files that are not a load of the table yet."""
    try:
        files = [r[0] for r in spark.read.parquet(noted).select(SOURCE).distinct().collect()]
    except AnalysisException:  # nothing was ever noted
        return []
    loaded = set(loads_of(spark, table))
    named = [(file, f"{name}-file-{hashlib.sha256(file.encode()).hexdigest()[:20]}") for file in sorted(files)]
    return [(file, load) for file, load in named if load not in loaded]

