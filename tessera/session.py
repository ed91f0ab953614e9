"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local session tuned like the tests expect (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is. Only when
    it is unset (local tests) do we create a private folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared checkpoint folder (for written intermediate tables/files).

    ``file:`` URIs become plain paths; other schemes (hdfs://, s3a://, …) are kept as URIs.
    """
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = "/" + base[len("file:"):].lstrip("/")
    return "/".join([base.rstrip("/"), *parts]) if parts else base


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in every Python worker.

    Arrow-batched functions are pickled by reference to this package, so executors must be
    able to import it. The package is zipped (content-addressed) into the shared folder and
    registered once per SparkContext with ``addPyFile``, which distributes it to executors.
    """
    import hashlib
    import io
    import pathlib
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    root = pathlib.Path(__file__).resolve().parent
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for f in sorted(root.rglob("*.py")):
            info = zipfile.ZipInfo(str(pathlib.Path("tessera") / f.relative_to(root)), date_time=(2020, 1, 1, 0, 0, 0))
            zf.writestr(info, f.read_bytes())
    data = buf.getvalue()
    name = f"tessera-{hashlib.sha1(data).hexdigest()[:16]}.zip"
    path = shared_path(spark, "pyfiles", name)
    from .sources.png import write_bytes

    try:
        write_bytes(path, data)
    except (OSError, ImportError):  # no client for the shared filesystem in this Python: ship from the driver
        path = os.path.join(tempfile.mkdtemp(prefix="tessera-pyfiles-"), name)
        with open(path, "wb") as f:
            f.write(data)
    sc.addPyFile(path)
    _SHIPPED.add(key)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
