"""Results that several parts of a plan read are made once and kept in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df``, computed now and written to the session's checkpoint folder.

    The folder is the one that the cluster names in spark.checkpoint.dir. Where that is unset one is made, in a local
    session only: on a cluster executors could not read each other's.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return df.checkpoint(eager=True)
