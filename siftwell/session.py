"""Sessions, and the package's way to the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_HERE = Path(__file__).resolve().parent
_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors of ``spark``, once for each application, so that its
    Python functions can be loaded there whatever their search path."""
    app = spark.sparkContext.applicationId
    if app not in _sent:
        path = Path(tempfile.mkdtemp(prefix="siftwell-")) / "siftwell.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(_HERE.rglob("*.py")):
                z.write(f, Path("siftwell") / f.relative_to(_HERE))
        spark.sparkContext.addPyFile(str(path))
        _sent.add(app)
    return spark


def local_session(cores: str = "8", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return ship(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siftwell")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
