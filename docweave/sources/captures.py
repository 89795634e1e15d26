"""Raw captures: manifests on disk, verification against files, inventory with preferred captures."""

from __future__ import annotations

import io
import posixpath
import zipfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILES = T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("bytes", T.LongType()), T.StructField("sha256", T.StringType())]))
MANIFEST = T.StructType([
    T.StructField("document_id", T.StringType()), T.StructField("source_url", T.StringType()), T.StructField("document_scope", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("retrieved_at", T.StringType()), T.StructField("identity_verified", T.BooleanType()), T.StructField("content_complete", T.BooleanType()),
    T.StructField("tabs", T.MapType(T.StringType(), T.StringType())), T.StructField("files", FILES),
])


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row per manifest.json below ``root``: capture (its folder) and the manifest's fields; unreadable JSON keeps null fields and ``readable`` false."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "manifest.json").load(root)
    body = F.from_json(F.decode("content", "UTF-8"), MANIFEST, {"mode": "PERMISSIVE"})
    rows = raw.select(F.regexp_replace("path", "/manifest\\.json$", "").alias("capture"), body.alias("m"), F.try_parse_json(F.decode("content", "UTF-8")).isNotNull().alias("readable"))
    return rows.select("capture", "readable", "m.*")


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """(capture, path, bytes, sha256) of every file below ``root`` but the manifests; contents are hashed where they are read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return raw.where(name != "manifest.json").select(F.regexp_replace("path", "/[^/]+$", "").alias("capture"), name.alias("path"), F.length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify(manifests: DataFrame, files: DataFrame, host: str, required: tuple[str, ...] = ("content",)) -> DataFrame:
    """Captures with ``problems`` (an array of codes, in a fixed order) and ``usable``."""
    said = manifests.select("capture", F.explode("files").alias("f")).select("capture", "f.*")
    there = files.select("capture", "path", F.col("bytes").alias("b"), F.col("sha256").alias("h"))
    checked = said.join(there, ["capture", "path"], "full_outer").groupBy("capture").agg(
        F.count_if(F.col("sha256").isNotNull() & F.col("h").isNull()).alias("missing"), F.count_if(F.col("sha256").isNull() & F.col("h").isNotNull()).alias("extra"),
        F.count_if(F.col("bytes") != F.col("b")).alias("size"), F.count_if(F.col("sha256") != F.col("h")).alias("hash"),
    )
    x = manifests.join(checked, "capture", "left")
    names = F.transform("files", lambda f: f["path"])
    no = F.lit(False)
    rules = [
        ("unreadable_manifest", ~F.col("readable")),
        ("staged_leftover", F.col("capture").rlike(r"(^|/)\.?(staging|tmp)[^/]*$|\.(partial|tmp)$")),
        ("identity_missing", F.col("document_id").isNull() | (F.col("document_id") == "")),
        ("folder_is_not_identity", F.regexp_extract("capture", "([^/]+)$", 1) != F.col("document_id")),
        ("wrong_host", F.regexp_extract("source_url", "^https://([^/]+)", 1) != host),
        ("url_lacks_identity", ~F.contains("source_url", "document_id")),
        ("not_complete", F.col("status") != "complete"),
        ("identity_unverified", ~F.coalesce("identity_verified", no)),
        ("content_incomplete", ~F.coalesce("content_complete", no)),
        ("repeated_file_names", F.size(names) != F.size(F.array_distinct(names))),
        ("tabs_incomplete", F.size(F.array_except(F.array(*[F.lit(t) for t in required]), F.coalesce(F.map_keys("tabs"), F.array().cast("array<string>")))) > 0),
        ("tab_file_unlisted", F.size(F.array_except(F.coalesce(F.map_values("tabs"), F.array().cast("array<string>")), F.coalesce(names, F.array().cast("array<string>")))) > 0),
        ("missing_file", F.col("missing") > 0), ("unlisted_file", F.col("extra") > 0), ("size_differs", F.col("size") > 0), ("hash_differs", F.col("hash") > 0),
    ]
    problems = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True) if k == "wrong_host" else no), F.lit(k)) for k, c in rules]))
    return x.withColumn("problems", problems).withColumn("usable", F.size("problems") == 0).drop("missing", "extra", "size", "hash")


def inventory(verified: DataFrame, reviewed: DataFrame | None = None) -> DataFrame:
    """Captures with url_conflict, preferred and duplicate_of.

    A URL with several identities makes all its captures unusable; of the
    usable captures of an identity the one already reviewed is preferred, then
    the first by path, and the others point to it.
    """
    canonical = F.regexp_replace("source_url", "[?#].*$", "")
    conflict = verified.where("document_id is not null").groupBy(canonical.alias("_url")).agg(F.count_distinct("document_id").alias("_n")).where("_n > 1").select("_url", F.lit(True).alias("url_conflict"))
    x = verified.withColumn("_url", canonical).join(conflict, "_url", "left").drop("_url")
    x = x.withColumn("url_conflict", F.coalesce("url_conflict", F.lit(False))).withColumn("usable", F.col("usable") & ~F.col("url_conflict"))
    if reviewed is not None:
        x = x.join(reviewed.select("capture").distinct().withColumn("reviewed", F.lit(True)), "capture", "left").withColumn("reviewed", F.coalesce("reviewed", F.lit(False)))
    else:
        x = x.withColumn("reviewed", F.lit(False))
    best = x.where("usable").groupBy("document_id").agg(F.min(F.struct((~F.col("reviewed")).alias("r"), F.col("capture").alias("c"))).alias("_best"))
    x = x.join(best, "document_id", "left").withColumn("preferred", F.col("usable") & (F.col("_best.c") == F.col("capture")))
    return x.withColumn("duplicate_of", F.when(F.col("usable") & ~F.col("preferred"), F.col("_best.c"))).drop("_best")


def inventory_summary(inv: DataFrame) -> DataFrame:
    """One row: captures, usable ones, identities, preferred, duplicates, conflicts."""
    n = lambda c: F.count_if(F.expr(c))
    return inv.agg(F.count(F.lit(1)).alias("captures"), n("usable").alias("usable"), F.count_distinct("document_id").alias("identities"), n("preferred").alias("preferred"), n("duplicate_of is not null").alias("duplicates"), n("url_conflict").alias("conflicts"))


def breadcrumb_scope(links: DataFrame, key: str, scope: str) -> DataFrame:
    """The one scope that a document's breadcrumb links name; a problem where there is none or more than one."""
    got = links.groupBy(key).agg(F.sort_array(F.collect_set(scope)).alias("_s"))
    return got.select(key, F.when(F.size("_s") == 1, F.col("_s")[0]).alias("scope"), F.when(F.size("_s") != 1, "scope_not_unique").alias("problem"))


def read_member(locator: str, open_file=open) -> bytes:
    """Bytes of a file, or of ``archive.zip!/member``; members that climb out of the archive are refused."""
    if "!/" not in locator:
        with open_file(locator, "rb") as f:
            return f.read()
    archive, member = locator.split("!/", 1)
    if member.startswith("/") or "\\" in member or posixpath.normpath(member) != member or member.startswith(".."):
        raise ValueError("the member is not inside its archive")
    with open_file(archive, "rb") as f, zipfile.ZipFile(io.BytesIO(f.read())) as z:
        return z.read(member)


def first_reusable(attempts: DataFrame, used: DataFrame, wave: str = "wave", scope: str = "scope", order: str = "attempt") -> DataFrame:
    """For each wave and scope the first capture whose scope differed from its hint and that no one used."""
    free = attempts.where("result = 'scope_hint_mismatch'").join(used.select("capture").distinct(), "capture", "left_anti")
    w = Window.partitionBy(wave, scope).orderBy(order)
    return free.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
