"""Lots processed as they arrive: a file stream triggers one batch run per new lot date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotforge.sources.csv_lots import IncompleteLotError, UnfinishedLotError, lot_manifest

_WAITING = "passo long, lote_data date, espera boolean"
_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_files(spark: SparkSession, lots_root: str) -> DataFrame:
    """New files below the lots folder with the lot date taken from their path."""
    day = F.regexp_extract("path", r"/(\d{4}-\d{2}-\d{2})/[a-z]+_\d{4}-\d{2}-\d{2}\.csv", 1)
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("recursiveFileLookup", "true")
        .load(lots_root)
        .select("path", day.try_cast("date").alias("lote_data"))
        .where(F.col("lote_data").isNotNull())
    )


def _waiting(spark: SparkSession, folder: str) -> tuple[list[dt.date], int]:
    """Dates whose last record says that they wait, and the number of the next record."""
    try:
        records = spark.read.schema(_WAITING).json(folder)
        last = records.groupBy("lote_data").agg(F.max("passo").alias("passo"), F.max_by("espera", "passo").alias("espera"))
        rows = last.orderBy("lote_data").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return [], 0
    return [r["lote_data"] for r in rows if r["espera"]], max((r["passo"] for r in rows), default=-1) + 1


def _record(spark: SparkSession, folder: str, lot_date: dt.date, waits: bool) -> None:
    _, step = _waiting(spark, folder)
    spark.createDataFrame([(step, lot_date, waits)], _WAITING).coalesce(1).write.mode("append").json(folder)


def process_arrivals(
    spark: SparkSession,
    lots_root: str,
    checkpoint: str,
    run_lot: Callable[[dt.date], object],
) -> StreamingQuery:
    """Run every complete lot that has new files, oldest date first, then stop.

    An incomplete lot is left alone: the file that completes it brings the date up again. The marker
    that finishes a folder is no file a stream sees, so dates that lack only markers are recorded
    in the checkpoint folder and tried first at the next call. Running a lot twice is harmless, so a
    micro-batch repeated after a failure is safe.
    """
    waiting = f"{checkpoint}/waiting"
    for lot_date in _waiting(spark, waiting)[0]:
        try:
            lot_manifest(spark, lots_root, lot_date)
        except IncompleteLotError:
            continue
        run_lot(lot_date)
        _record(spark, waiting, lot_date, False)

    def handle(files: DataFrame, _: int) -> None:
        dates = files.select("lote_data").distinct().orderBy("lote_data").collect()
        for row in dates:
            try:
                lot_manifest(spark, lots_root, row["lote_data"])
            except UnfinishedLotError:
                _record(spark, waiting, row["lote_data"], True)
                continue
            except IncompleteLotError:
                continue
            run_lot(row["lote_data"])

    return (
        arriving_files(spark, lots_root)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
