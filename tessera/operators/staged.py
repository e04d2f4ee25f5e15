"""Written tables in the shared checkpoint folder: compute once, read many times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tessera.session import ensure_checkpoint_dir

#: Values (rows times columns) in a file: a reader's task takes whole files, so that a table whose
#: values pack well is not one small file, and all of its unpacked rows one task's.
CELLS_PER_FILE = 2_000_000


def written_once(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as a table under ``spark.checkpoint.dir`` and read back with its own schema.

    What feeds several branches of a plan (a staged batch feeds inserts, updates
    and the change feed) runs once, and a lost executor repeats nothing above.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", max(1, CELLS_PER_FILE // len(df.columns))).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
