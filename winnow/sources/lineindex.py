"""A sparse line index beside a JSONL corpus: pages without reading the corpus.

One row per file: physical and valid (JSON, not blank) lines, and how many of
both lie before the file in path order.  The index is built by one narrow scan
with a partially aggregated count per file and is written as a small Parquet
table.  A page then reads only the files that can hold its lines, numbers the
lines of those files from the index's sums, and ends in a top-k: no sort or
checkpoint of the corpus, no scan of the other files.

Files are known by path, size and modification time; ``refresh`` counts new and
changed files alone.  Reading a page of a stale index raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winnow.operators import validate as va
from winnow.sources.lines import read_lines

FILE = "path string, size bigint, modified timestamp"
SCHEMA = FILE + ", lines bigint, valid bigint, lines_before bigint, valid_before bigint"


def plain_path(c: F.Column, encoded: bool = True) -> F.Column:
    """One spelling of a file's path: Spark's readers encode it as a URI, its
    listings do not, and local ones differ in their slashes."""
    c = F.url_decode(F.regexp_replace(c, r"\+", "%2B")) if encoded else c
    return F.regexp_replace(c, "^file:/+", "file:/")


def corpus_files(spark: SparkSession, paths) -> DataFrame:
    """(path, size, modified) of the corpus files; contents are not read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.format("binaryFile").load(paths)
            .select(plain_path(F.col("path"), False).alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")))


def _counts(spark: SparkSession, files: list[str]) -> DataFrame:
    lines = spark.read.text(files).select(
        "value", plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"))
    p = va.parse(lines)
    return p.groupBy("path", "size", "modified").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("_blank") & F.col("_v").isNotNull()).alias("valid"))


def _summed(counts: DataFrame) -> DataFrame:
    """Sums over the files before each (one small row per file)."""
    w = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("path", "size", "modified", "lines", "valid",
                         F.coalesce(F.sum("lines").over(w), F.lit(0)).alias("lines_before"),
                         F.coalesce(F.sum("valid").over(w), F.lit(0)).alias("valid_before"))


class LineIndex:
    def __init__(self, spark: SparkSession, paths, at: str):
        self.spark, self.paths, self.at = spark, paths, at.rstrip("/")

    @classmethod
    def build(cls, spark: SparkSession, paths, at: str) -> LineIndex:
        """Count every file of ``paths`` and write the index to ``at``."""
        index = cls(spark, paths, at)
        index._write(index._count(corpus_files(spark, paths)), 0)
        return index

    def _count(self, files: DataFrame) -> DataFrame:
        """Counted rows of ``files``; a file without any line has none of both."""
        some = [r.path for r in files.where("size > 0").select("path").collect()]  # file names, as any reader lists them
        empty = files.where("size = 0").select("*", F.lit(0).cast("bigint").alias("lines"), F.lit(0).cast("bigint").alias("valid"))
        return _counts(self.spark, some).unionByName(empty) if some else empty

    def _write(self, counts: DataFrame, version: int) -> None:
        _summed(counts).write.mode("overwrite").parquet(f"{self.at}/v{version}")

    def _version(self) -> int:
        seen = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(self.at)
        names = seen.select(F.regexp_extract(F.col("_metadata.file_path"), r"/v(\d+)/[^/]*$", 1).cast("int").alias("v"))
        return names.agg(F.max("v")).first()[0] or 0

    def files(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(f"{self.at}/v{self._version()}")

    def refresh(self) -> int:
        """Count files that are new or changed, drop those that are gone; returns
        how many were counted."""
        now, old = corpus_files(self.spark, self.paths), self.files()
        keys = ["path", "size", "modified"]
        same = old.join(now, keys, "left_semi")
        new = now.join(old.select(*keys), keys, "left_anti")
        n = new.count()
        if n or old.count() != same.count():
            counts = same.select(*keys, "lines", "valid")
            self._write(counts.unionByName(self._count(new)) if n else counts, self._version() + 1)
        return n

    def _lines(self, wanted: F.Column) -> DataFrame:
        """Parsed lines of the indexed files that ``wanted`` selects, with their
        physical number ``line_no`` and valid rank ``_rank`` in the corpus."""
        chosen = self.files().where(wanted)
        rows = chosen.select("path", "size", "modified").collect()  # the page's own files
        if not rows:
            empty = self.spark.createDataFrame([], "path string, line_no bigint, value string")
            return va.parse(empty).withColumn("_rank", F.lit(0).cast("bigint"))
        files = [r.path for r in rows]
        stale = chosen.select("path", "size", "modified").join(corpus_files(self.spark, files), ["path", "size", "modified"], "left_anti")
        if not stale.isEmpty():
            raise ValueError(f"the line index {self.at} is older than {stale.first().path}")
        lines = va.parse(read_lines(self.spark, files, per_file=True, with_split=True)).withColumn("path", plain_path(F.col("path")))
        valid = ~F.col("_blank") & F.col("_v").isNotNull()
        # valid rank: sums over the splits before, then inside the split (a window never spans two splits)
        per = lines.groupBy("path", "_block").agg(F.count_if(valid).alias("_n"))
        ahead = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        per = per.select("path", "_block", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
        inside = F.count_if(valid).over(Window.partitionBy("path", "_block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0))
        before = chosen.select("path", "lines_before", "valid_before")
        return (lines.withColumn("_inside", inside).join(per, ["path", "_block"]).join(F.broadcast(before), "path")
                .withColumn("line_no", F.col("line_no") + F.col("lines_before"))
                .withColumn("_rank", F.col("_inside") + F.col("_ahead") + F.col("valid_before"))
                .where(valid).drop("_block", "_inside", "_ahead", "lines_before", "valid_before"))

    def page(self, start_line: int, batch_size: int) -> DataFrame:
        """Skip ``start_line`` physical lines, take ``batch_size`` valid documents
        (the page size is the feature's own limit)."""
        files = self.files()
        first = files.where((F.col("lines_before") <= start_line) & (F.col("lines_before") + F.col("lines") > start_line)) \
                     .agg(F.max(F.col("valid_before") + F.col("valid")).alias("v")).first().v
        if first is None:
            return self._lines(F.lit(False)).drop("_rank")
        wanted = (F.col("lines_before") + F.col("lines") > start_line) & (F.col("valid_before") < first + batch_size)
        return self._lines(wanted).where(F.col("line_no") > start_line).orderBy("line_no").limit(batch_size).drop("_rank")

    def page_valid(self, start: int, batch_size: int) -> DataFrame:
        """Skip ``start`` valid documents, take the next ``batch_size``."""
        wanted = (F.col("valid_before") + F.col("valid") > start) & (F.col("valid_before") < start + batch_size)
        return self._lines(wanted).where((F.col("_rank") > start) & (F.col("_rank") <= start + batch_size)).drop("_rank")

    def head(self, max_lines: int) -> DataFrame:
        """The valid documents among the first ``max_lines`` physical lines."""
        return self._lines(F.col("lines_before") < max_lines).where(F.col("line_no") <= max_lines).drop("_rank")
