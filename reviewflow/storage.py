"""Shared storage for intermediate tables, and shipping of this package to executors."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import threading
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors share.

    Only where the setting is absent in a local session, as in tests, a folder of this machine is made; it goes with the process.
    On a cluster a folder of one machine would be another one on every executor, so the setting must be there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        folder = tempfile.mkdtemp(prefix="reviewflow-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        found = "file://" + folder
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and read it back: cuts lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = path or f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: The mark is on the application's context: a copy of this module that is imported anew must find it, for executors take no second file of one name.
SHIPPED = "_reviewflow_shipped"
_shipping = threading.Lock()


@cache
def _package() -> dict[str, bytes]:
    root = Path(__file__).resolve().parent
    return {os.path.join("reviewflow", p.relative_to(root)): p.read_bytes() for p in sorted(root.rglob("*")) if p.suffix in (".py", ".json")}


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package once per application, so that nothing needs to be installed there.

    A package that was changed since then and imported anew is an error: executors would go on with the former one.
    """
    context = spark.sparkContext
    with _shipping:
        before = getattr(context, SHIPPED, None)
        if before is not None:
            if before != _package():
                raise RuntimeError("reviewflow was changed after it was given to the executors of this application; start a new one")
            return
        target = Path(tempfile.mkdtemp(prefix="reviewflow-zip-")) / "reviewflow.zip"
        with zipfile.ZipFile(target, "w") as z:
            for name, content in _package().items():
                z.writestr(name, content)
        context.addPyFile(str(target))
        setattr(context, SHIPPED, _package())
