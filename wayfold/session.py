"""Session construction and the few session facts that operators need."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "wayfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; keyword arguments override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benches."""
    tmp = os.path.join(tempfile.gettempdir(), "wayfold")
    base = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "12g",
        "spark.driver.host": "127.0.0.1",
        "spark.sql.warehouse.dir": os.path.join(tmp, "warehouse"),
        "spark.checkpoint.dir": os.path.join(tmp, "checkpoints"),
    }
    return build_session(master=f"local[{cores}]", **{**base, **conf})


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Gives this package to Python workers, once for each application, wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    at = os.path.join(tempfile.mkdtemp(prefix="wayfold-code-"), "wayfold_code.zip")
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(at)
    _shipped.add(app)
