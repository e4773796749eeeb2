"""What a Spark session needs before the library's Python work can run on its executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()

#: Bytes of a table's rows, as they are seen while it is shuffled, up to which joins send it to all tasks within ``joined_by_rows``.
SENT_BYTES = 1 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once for each application, as ``--py-files`` would.

    Times are read and written in UTC.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = Path(__file__).resolve().parent
        path = os.path.join(tempfile.mkdtemp(prefix="runlake-"), f"{top.name}.zip")
        with zipfile.ZipFile(path, "w") as out:
            for source in sorted(top.rglob("*.py")):
                out.write(source, source.relative_to(top.parent))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark


@contextmanager
def joined_by_rows(spark: SparkSession) -> Iterator[None]:
    """Within it joins don't send a table to all tasks, by way of the driver, for how few bytes its files have.

    Rows take many times those bytes in memory: a file of a few megabytes may hold millions of runs. Tables are shuffled, and sent only
    if their rows turn out to be small (or are marked as few, see ``csvfiles.few``). These are settings of the session, and come back after.
    """
    files, rows = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {files: spark.conf.get(files), rows: spark.conf.get(rows, None)}
    said = before[rows] or before[files]
    most = said if said.startswith("-") else min(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(said), SENT_BYTES)
    spark.conf.set(rows, str(most))
    spark.conf.set(files, "-1")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the one that all executors share, for intermediate tables.

    ``spark.checkpoint.dir`` names it. Only where Spark runs in one process, as in tests, may it be unset: a folder
    of the machine is made then. On a cluster that would lose data, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="runlake-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/runlake-{label}-{uuid.uuid4().hex}"
