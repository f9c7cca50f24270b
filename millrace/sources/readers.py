"""Sources: CSV, JSON, JSON lines, JDBC, landed pages and reference files, all with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.assertions import duplicate_keys, missing_required, require


def read_csv(spark: SparkSession, path: str, schema: str | StructType, sep: str = ";", required: tuple[str, ...] = ()) -> DataFrame:
    """CSV with a header. Columns meet the schema by name whatever their order, a byte-order mark is dropped, values are never
    inferred (identifiers keep their zeros); a required column that the header lacks is an error."""
    header = spark.read.text(path).limit(1).first()
    names = [h.strip().strip('"') for h in (header[0].lstrip("﻿").split(sep) if header else [])]
    lacking = [c for c in required if c not in names]
    if lacking:
        raise ValueError(f"{path} lacks {', '.join(lacking)}")
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = spark.read.csv(path, sep=sep, header=True, schema=StructType().add("__none", "string") if not names else ", ".join(f"`{n}` string" for n in names), enforceSchema=True)
    one = lambda f: F.col(f.name) if f.dataType.simpleString() == "string" else F.expr(f"try_cast(nullif(trim(`{f.name}`), '') as {f.dataType.simpleString()})")
    return raw.select(*[one(f).alias(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in declared.fields])


def read_json(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A JSON array of objects, or one object; anything malformed is an error."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType, key: str | None = None) -> DataFrame:
    """One object a line, blank lines skipped; with a key, a repeated or missing one is an error."""
    df = spark.read.schema(schema).json(path, mode="FAILFAST")
    if key:
        require(missing_required(df, [key], key), f"{path}: no {key}")
        require(duplicate_keys(df, key), f"{path}: {key} repeated")
    return df


def read_jdbc(spark: SparkSession, url: str, query: str, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8, **options) -> DataFrame:
    """A query over JDBC, read in ranges of a numeric key if bounds are given; nothing is written."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) AS q").options(**options)
    if key and bounds:
        r = r.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return r.load()


def snapshot_rows(offers: DataFrame) -> DataFrame:
    """The exported snapshot: six columns, rows with an id, blanks as nulls, ordered by id."""
    c = lambda n: F.nullif(F.trim(F.col(n)), F.lit(""))
    return offers.filter("id IS NOT NULL").select("id", c("title").alias("title"), c("description").alias("description"), c("company").alias("company"), c("postal_code").alias("postal_code"), c("occupation").alias("occupation")).orderBy("id")


def page(df: DataFrame, key: str, skip: int, limit: int) -> DataFrame:
    """Rows skip to skip + limit in the order of the key."""
    if skip < 0 or limit < 0:
        raise ValueError("skip and limit can't be negative")
    return df.orderBy(key).offset(skip).limit(limit)


def lookup(df: DataFrame, **keys) -> DataFrame:
    """The row with these key values."""
    for k, v in keys.items():
        df = df.filter(F.col(k).eqNullSafe(F.lit(v)))
    return df.limit(1)


def filtered(df: DataFrame, **values) -> DataFrame:
    """Equality filters for the arguments that are given; None leaves its column free."""
    for k, v in values.items():
        if v is not None:
            df = df.filter(F.col(k) == F.lit(v))
    return df


def distinct_codes(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def code_labels(df: DataFrame, code: str, label: str) -> DataFrame:
    """code to label; a code with two labels is an error when the row is read."""
    g = df.groupBy(code).agg(F.min(label).alias(label), F.count_distinct(label).alias("n"))
    return g.select(code, F.when(F.col("n") <= 1, F.col(label)).otherwise(F.raise_error(F.concat(F.lit("two labels for "), F.col(code))).cast("string")).alias(label))


def code_conflicts(df: DataFrame, code: str, label: str) -> DataFrame:
    return df.groupBy(code).agg(F.count_distinct(label).alias("labels")).filter("labels > 1")


def latest_batch(spark: SparkSession, root: str) -> str | None:
    """The folder under root that is last in name order; through Spark's file system, so any store works."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else []
    return f"{root.rstrip('/')}/{names[-1]}" if names else None


def first_matching(spark: SparkSession, pattern: str) -> str:
    """The first path in name order that a glob matches; none is an error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    names = sorted(s.getPath().toString() for s in found)
    if not names:
        raise FileNotFoundError(pattern)
    return names[0]


def matching_strategy(spark: SparkSession, path: str, manifest: str = "matching_manifest.json") -> dict:
    """What the manifest beside a file of candidates says of their strategy; without one, or with one that isn't an object, UNKNOWN."""
    beside = f"{path.rsplit('/', 1)[0]}/{manifest}"
    place = spark._jvm.org.apache.hadoop.fs.Path(beside)
    none = {"strategy": "UNKNOWN", "use_aliases": None, "manifest_found": False}
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return none
    text = spark.read.text(beside, wholetext=True).select(F.col("value").alias("v"))
    row = text.select(F.trim("v").startswith("{").alias("object"), F.get_json_object("v", "$.strategy").alias("strategy"), F.get_json_object("v", "$.use_aliases").cast("boolean").alias("aliases"), F.sha2("v", 256).alias("sha256")).first()
    if not row or not row.object:
        return none
    return {"strategy": row.strategy or "UNKNOWN", "use_aliases": row.aliases, "manifest_found": True, "manifest_path": beside, "manifest_sha256": row.sha256}


def csv_rows(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """(rows) of CSV files without their headers; line breaks within quotes are one row."""
    return spark.read.csv(path, sep=sep, header=True, multiLine=True, escape='"').agg(F.count("*").alias("rows"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


#: Schema of a landed page of offers.
SKILL = "struct<id:string,`@id`:string,name:string,slug:string,displayed:boolean>"
PAGE = f"`hydra:member` array<struct<id:string,`@id`:string,title:string,description:string,candidateProfile:string,companyDescription:string,company:struct<name:string>,location:struct<locality:string,postalCode:string,adminLevel1:string,country:string>,contracts:array<string>,skills:array<{SKILL}>,softSkills:array<{SKILL}>,remoteMode:string,experienceLevel:string,minAnnualSalary:long,maxAnnualSalary:long,minDailySalary:long,maxDailySalary:long,currency:string,publishedAt:string,updatedAt:string,expiredAt:string>>, `hydra:totalItems` long, `hydra:view` struct<`hydra:next`:string>"


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Offers of landed pages: id, the offer, and where it stood."""
    return spark.read.schema(PAGE).json(path, multiLine=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode("hydra:member").alias("pos", "offer")).select(F.col("offer.id").alias("id"), "offer", "file", "pos")
