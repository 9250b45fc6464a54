"""Files in: routing by content or name, object ranges, model output, result texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S

# Leading bytes of the accepted file types, in hex.
SIGNATURES = [
    ("pdf", "25504446"), ("png", "89504E470D0A1A0A"), ("jpeg", "FFD8FF"), ("gif", "47494638"), ("bmp", "424D"),
    ("tiff", "49492A00"), ("tiff", "4D4D002A"), ("jp2", "0000000C6A502020"),
]
IMAGE_TYPES = ["png", "jpeg", "jp2", "webp", "gif", "bmp", "jpg", "tiff"]
# Extensions that go to the page parser.
PAGE_EXTENSIONS = ["pdf", "png", "jpg", "jpeg", "bmp", "tiff", "tif", "webp"]


def content_type(content: Column) -> Column:
    """SC1: file type by its first bytes, null if unknown."""
    head = F.hex(F.substring(content, 1, 12))
    kind = F.when(head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250"), "webp")
    for name, lead in SIGNATURES:
        kind = kind.when(head.startswith(lead), name)
    return kind


def route_by_content(files: DataFrame) -> DataFrame:
    """SC1: (path, content) with ``kind`` pdf or image; other files are left out."""
    suffix = content_type(F.col("content"))
    kind = F.when(suffix == "pdf", "pdf").when(suffix.isin(IMAGE_TYPES), "image")
    return files.withColumn("suffix", suffix).withColumn("kind", kind).where(F.col("kind").isNotNull())


def scan_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """SC1: files under a folder as (path, modificationTime, length, content), by Spark's binary source."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def route_by_extension(path: Column) -> Column:
    """SC2: ``pdf_image`` for what the page parser reads, else ``other``."""
    return F.when(extension(path).isin(PAGE_EXTENSIONS), "pdf_image").otherwise("other")


def object_ranges(refs: DataFrame, bucket: str, prefix: str = "", col: str = "ref") -> DataFrame:
    """SC3: ``s3://bucket/key?bytes=offset,length`` split into bucket, key, start and length (-1 = rest).

    References without a scheme lie in the default bucket under the prefix.
    """
    bare = F.regexp_extract(col, r"^([^?]*)", 1)
    absolute = bare.rlike(r"^s3a?://")
    span = r"\?bytes=(\d+),(-?\d+)$"
    has_range = F.col(col).rlike(span)
    rel = F.concat(F.lit(f"{prefix}/" if prefix else ""), bare)
    return refs.withColumns({
        "bucket": F.when(absolute, F.regexp_extract(bare, r"^s3a?://([^/]+)/", 1)).otherwise(F.lit(bucket)),
        "key": F.when(absolute, F.regexp_extract(bare, r"^s3a?://[^/]+/(.*)$", 1)).otherwise(rel),
        "start": F.when(has_range, F.regexp_extract(col, span, 1).try_cast("bigint")).otherwise(F.lit(0)),
        "length": F.when(has_range, F.regexp_extract(col, span, 2).try_cast("bigint")).otherwise(F.lit(-1))})


def read_ranges(ranges: DataFrame, objects: DataFrame) -> DataFrame:
    """SC3: ``data`` of each range from objects (bucket, key, content)."""
    joined = ranges.join(objects.select("bucket", "key", "content"), ["bucket", "key"])
    start = (F.col("start") + 1).cast("int")
    size = F.when(F.col("length") < 0, F.length("content")).otherwise(F.col("length")).cast("int")
    return joined.withColumn("data", F.substring(F.col("content"), start, size)).drop("content")


def read_page_results(spark: SparkSession, folder: str, multi_line: bool = False) -> DataFrame:
    """SC5: model output, one JSON array of pages per document (``doc_id``, ``pages``), as one row per
    detection. ``multi_line`` reads indented files; the doc id is then the file name."""
    if multi_line:
        raw = spark.read.schema(S.PAGE_RESULT).option("multiLine", "true").json(folder).select(
            F.regexp_extract("_metadata.file_path", r"([^/]+)\.json$", 1).alias("doc_id"), "layout_dets", "page_info")
        pages = raw.select("doc_id", F.col("page_info.page_no").cast("bigint").alias("page_idx"), "layout_dets", "page_info")
    else:
        schema = S.T.StructType([S.T.StructField("doc_id", S.T.LongType()), S.T.StructField("pages", S.T.ArrayType(S.PAGE_RESULT))])
        docs = spark.read.schema(schema).json(folder)
        pages = docs.select("doc_id", F.posexplode("pages").alias("page_idx", "p")).select(
            "doc_id", F.col("p.page_info.page_no").cast("bigint").alias("page_idx"), "p.layout_dets", "p.page_info")
    dets = pages.select("doc_id", "page_idx", "page_info.width", "page_info.height", F.posexplode("layout_dets").alias("k", "d"))
    return dets.select("doc_id", "page_idx", "width", "height", (F.col("k") + 1).alias("det_id"), "d.*")


def read_model_blocks(docs: DataFrame, value: str = "value") -> DataFrame:
    """SC6: language-model output (pages of blocks as JSON text) as one row per block."""
    kind = f"array<array<{S.MODEL_BLOCK.simpleString()}>>"
    pages = docs.select("doc_id", F.posexplode(F.from_json(value, kind)).alias("page_idx", "blocks"))
    rows = pages.select("doc_id", "page_idx", F.posexplode("blocks").alias("idx", "b"))
    box = F.col("b.bbox")
    return rows.select("doc_id", "page_idx", "idx", "b.type", box[0].alias("x0"), box[1].alias("y0"), box[2].alias("x1"), box[3].alias("y1"), "b.angle", "b.content")


def read_middle(spark: SparkSession, folder: str, keys: str = "doc_id bigint") -> DataFrame:
    """SC7: middle JSON with its schema given."""
    schema = S.T.StructType([*S.T.StructType.fromDDL(keys).fields, *S.MIDDLE.fields])
    return spark.read.schema(schema).json(folder)


def read_result_texts(spark: SparkSession, folder: str) -> DataFrame:
    """SC14: every .md and .txt file of a result tree, once. A file that cannot be read fails the job; none is left out silently."""
    return (
        spark.read
        .text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.{md,txt}").select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))
