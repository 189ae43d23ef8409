"""Work tables in the shared folder, and a join that survives hot keys."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of bytes outside ASCII white space (UTF-8 continuation bytes never fall in it).
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def ship(module_name: str) -> None:
    """Send the task functions of a module by value: workers need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def work_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the cluster shares (``spark.checkpoint.dir``).

    Only a ``local[...]`` session without the setting gets a folder of its own.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="llm-work-")
        sc.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return os.path.join(work_folder(spark), f"{name}-{uuid.uuid4().hex}")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under internal names: extra or clashing columns cannot interfere."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in columns.items()])


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, t_hash, row): all columns in one struct, so that none can clash with those of a join; ``row.*`` unpacks."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("t_hash"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


#: A key is hot if it holds more than this share of all rows; so at most 512 keys are hot.
HOT_SHARE = 512


def join_hot(left: DataFrame, right: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """Join many rows to one row per key without gathering a hot key in one task.

    ``right`` has one row per ``key`` and, in ``count``, how many rows of ``left``
    have it. Keys above 1/512 of the sum of ``count`` number at most 511, so
    broadcasting those is bounded whatever the input; all other keys are small
    and meet in a shuffle join. Both inputs are read more than once and should be
    saved tables. ``how``: inner or left. Null keys match nothing.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    hot_rows = right.filter(F.col(count) * HOT_SHARE > total)
    cold_rows = right.filter(F.col(count) * HOT_SHARE <= total)
    hot_keys = F.broadcast(hot_rows.select(key))
    at_hot = left.join(F.broadcast(hot_rows), key, "inner")
    rest = left.join(hot_keys, key, "left_anti").join(cold_rows, key, how)
    return at_hot.unionByName(rest)
