"""File and image scans, paths, EXIF dumps and image files."""

from __future__ import annotations

import posixpath
import tempfile
import urllib.parse
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom import config
from rasterloom.functions import kernels


def with_path_parts(df: DataFrame, path: str = "path") -> DataFrame:
    """Adds name, parent (the folder's path) and parent_name."""
    p = F.col(path)
    return df.withColumns(
        {
            "name": F.regexp_extract(p, "([^/]*)$", 1),
            "parent": F.regexp_extract(p, "^(.*)/[^/]*$", 1),
            "parent_name": F.regexp_extract(p, "([^/]*)/[^/]*$", 1),
        }
    )


def ppi_from_name(name: Column) -> Column:
    """The resolution in names like page_400.tif; null if there is none."""
    return F.nullif(F.regexp_extract(name, r"_([0-9]+)\.", 1), F.lit("")).try_cast("int")


def suffix(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(\.[^./]*)$", 1))


def one_slash(path: Column) -> Column:
    """Local paths in one spelling; Spark's sources differ in how many slashes follow the scheme."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def files(spark: SparkSession, root: str, contents: bool = False) -> DataFrame:
    """All files below ``root``, every folder down, with path parts; contents are read only if asked for."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    found = found.withColumn("path", one_slash(F.col("path")))
    columns = ["path", "length", "modificationTime", *(["content"] if contents else [])]
    return with_path_parts(found.select(*columns))


def folders(found: DataFrame, root: str) -> DataFrame:
    """The folders below ``root`` that hold files, the root itself not among them."""
    top = root.rstrip("/")
    return found.select(F.col("parent").alias("folder")).distinct().where(~F.col("folder").endswith(top))


def image_files(found: DataFrame, suffixes: tuple[str, ...] = config.IMAGE_SUFFIXES) -> DataFrame:
    """Files with an image's suffix, whatever its case, that are not a folder's thumbnails."""
    return found.where((F.lower("name") != "thumbs.db") & suffix(F.col("name")).isin(*suffixes))


def images(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """(path, height, width, channels, data) of all files below ``root``; data is null where decoding fails."""
    found = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(root)
    valid = F.col("image.width") > 0
    return found.select(
        one_slash(F.col("image.origin")).alias("path"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.when(valid, F.col("image.data")).alias("data"),
    )


def validated(found: DataFrame, decoded: DataFrame) -> DataFrame:
    """Files with valid and error: the size is looked at before the decoded image, the first failure wins."""
    from rasterloom.operators.relational import validity

    opened = decoded.select("path", F.col("data").isNotNull().alias("__open"))
    error = F.coalesce(validity(F.col("length")), F.when(~F.coalesce("__open", F.lit(False)), F.lit("[OPEN FAIL]")))
    return found.join(opened, "path", "left").withColumn("error", error).withColumn("valid", F.col("error").isNull()).drop("__open")


def exif(spark: SparkSession, path: str) -> DataFrame:
    """(file, key, value) of dumps with lines "Key : Value"; a value may hold the separator or be empty."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), "value")
    pair = r"^\s*([^:]*?)\s*:\s?(.*?)\s*$"
    rows = lines.select("file", F.regexp_extract("value", pair, 1).alias("key"), F.regexp_extract("value", pair, 2).alias("value"))
    return rows.where("key <> ''")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share; in local mode a temporary one does."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="rasterloom-")


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder and what it holds, where it is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


#: First bytes of image files.
_SIGNATURES = (b"\x89PNG\r\n\x1a\n", b"\xff\xd8\xff", b"II*\0", b"MM\0*", b"BM", b"GIF8")


def failure_reason(content: bytes) -> str:
    """Why a file did not decode: it is no image, its first part is damaged, or its pixels do not load."""
    if not content.startswith(_SIGNATURES):
        return "[OPEN FAIL]"
    if content.startswith(_SIGNATURES[0]):
        size = int.from_bytes(content[8:12], "big")
        head, crc = content[12 : 16 + size], content[16 + size : 20 + size]
        if head[:4] != b"IHDR" or zlib.crc32(head) != int.from_bytes(crc, "big"):
            return "[VERIFY FAIL]"
    return "[LOAD FAIL]"


def explained(spark: SparkSession, root: str, checked: DataFrame, most: int = 1000) -> DataFrame:
    """``checked`` files with the reason why each undecodable one is; only these are read, or all where there are many."""
    bad = checked.where("error = '[OPEN FAIL]'").select("path")
    paths = [r.path for r in bad.limit(most + 1).collect()]
    if not paths:
        return checked
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths if len(paths) <= most else root)

    def run(batches):
        for batch in batches:
            reasons = [failure_reason(c) for c in batch.column("head").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.array(reasons, pa.string())], ["at", "reason"])

    heads = found.select(one_slash(F.col("path")).alias("path"), F.substring("content", 1, 64).alias("head")).join(bad, "path", "left_semi")
    reasons = heads.select(F.col("path").alias("at"), "head").mapInArrow(run, "at string, reason string")
    joined = checked.join(reasons, checked["path"] == reasons["at"], "left")
    return joined.withColumn("error", F.coalesce("reason", "error")).drop("at", "reason")


def scaled_name(name: Column, scale: int) -> Column:
    """The name with the scale before its suffix: page.png becomes page_x2.png."""
    return F.regexp_replace(name, r"^(.*?)(\.[^./]*)?$", f"$1_x{scale}$2")


def write_png(images_: DataFrame, folder: str, relative: Column, ppi: Column | None = None) -> DataFrame:
    """Writes each image below ``folder`` at its relative path: (path, bytes, error, input, relative_path), bytes or an error.

    The folder is one that all executors share, with or without a scheme. A file appears under its name only when it is
    whole, so a task that runs again replaces it.
    """
    rows = images_.select("path", "height", "width", "channels", "data", relative.alias("__to"), (F.lit(None).cast("int") if ppi is None else ppi.cast("int")).alias("__ppi"))

    def run(batches):
        from rasterloom.operators.images import pixels_of

        files_, base = pa.fs.FileSystem.from_uri(folder if "://" in folder else "file://" + urllib.parse.quote(posixpath.abspath(folder.removeprefix("file:"))))
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                to, size, error = posixpath.join(base, row["__to"]), None, None
                try:
                    files_.create_dir(posixpath.dirname(to), recursive=True)
                    data = kernels.encode_png(pixels_of(row)[..., ::-1], row["__ppi"])
                    part = f"{to}.{uuid.uuid4().hex}.part"
                    with files_.open_output_stream(part) as file:
                        file.write(data)
                    files_.move(part, to)
                    size = len(data)
                except Exception as raised:  # noqa: BLE001
                    error = str(raised) or type(raised).__name__
                done.append({"path": to, "bytes": size, "error": error, "input": row["path"], "relative_path": row["__to"]})
            yield pa.RecordBatch.from_pylist(done, kind)

    kind = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("error", pa.string()), ("input", pa.string()), ("relative_path", pa.string())])
    return rows.mapInArrow(run, "path string, bytes long, error string, input string, relative_path string")
