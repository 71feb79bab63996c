"""Session and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "skriftverk", **conf: str) -> SparkSession:
    """A local session with the settings that the engine expects; on a cluster the submitter's settings win."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one made for a local session where it is unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = getattr(spark, "_skriftverk_dir", None)
        if d is None:
            d = "file://" + tempfile.mkdtemp(prefix="skriftverk-")
            spark._skriftverk_dir = d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/skriftverk/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, with_path: bool = False) -> DataFrame | tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and a lost executor costs nothing.

    With ``with_path`` also the path, for an owner that drops it; the rest goes at the end of the session.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if with_path:
        return out, path
    _leave(spark, path)
    return out


_left: list[tuple[object, object]] = []


def _leave(spark: SparkSession, path: str) -> None:
    """Note a scratch table that a returned frame may still read; ``release`` drops it, at the latest when Python ends."""
    if not _left:
        atexit.register(release)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _left.append((p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p))  # these outlive the Spark context


def release() -> None:
    """Drop the scratch tables of this process; frames that were made from them can no longer be read."""
    while _left:
        fs, p = _left.pop()
        try:
            fs.delete(p, True)
        except Exception:  # noqa: BLE001 - the JVM is gone
            _left.clear()


class Scratch:
    """Intermediate tables of one operator: ``with Scratch(spark) as keep`` writes them and drops them at the end."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        out, path = materialize(df, name, with_path=True)
        self.paths.append(path)
        return out

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for p in self.paths:
            drop_path(self.spark, p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced as a whole."""
    jvm = spark.sparkContext._jvm
    p, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".new")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    fs.rename(new, p)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; of an interrupted replacement, the new one; None if there is none."""
    jvm = spark.sparkContext._jvm
    for name in (path, path + ".new"):
        p = jvm.org.apache.hadoop.fs.Path(name)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(p):
            stream = fs.open(p)
            try:
                return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
    return None


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that no plan reads any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input of fewer splits than cores; larger inputs keep their splits and are not shuffled."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session; they may have another path than the driver."""
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if getattr(sc, "_skriftverk_shipped", False):
        return
    root = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="skriftverk-")) / "skriftverk.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(out))
    sc._skriftverk_shipped = True
