"""Sources and sinks: delimited and Parquet files, folders, databases, buckets, cohorts, packaged datasets."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.prep import kind_of
from wardline.operators.saved import saved
from wardline.operators.typing_ops import NA_TOKENS, null_tokens, sanitize
from wardline.operators.windows import sort_globally

TRANSIENT = r"(?i)deadlock|lock (?:wait )?time-?out|lock could not be obtained|could not serialize"


def read_delimited(spark: SparkSession, path: str | list[str], *, separator: str = ",", schema: str | None = None, columns: Sequence[str] | None = None, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Delimited text (also gzip) with a header; tokens for missing values become null; columns that exist are kept."""
    reader = spark.read.option("header", True).option("sep", separator)
    df = reader.csv(path, schema=schema) if schema else reader.csv(path)
    if columns:
        df = df.select(*[c for c in columns if c in df.columns])
    return df.select(*(null_tokens(F.col(f"`{c}`"), na_tokens).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes))


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None, intersect: bool = False) -> DataFrame:
    """Parquet with requested columns, matched as they are or in sanitised form."""
    df = spark.read.parquet(path)
    if not columns:
        return df
    by = {sanitize(c): c for c in df.columns} | {c: c for c in df.columns}
    missing = [c for c in columns if c not in by]
    if missing and not intersect:
        raise ValueError(f"no such columns: {missing}")
    return df.select(*(F.col(f"`{by[c]}`").alias(c) for c in columns if c in by))


def read_many(spark: SparkSession, folder: str, *, pattern: str = "*.parquet", fmt: str = "parquet", exclude: str | None = None, tag: str | None = "source_file", **options: str) -> DataFrame:
    """All files of a folder that match, stacked by name, each row tagged with its file."""
    df = spark.read.format(fmt).options(pathGlobFilter=pattern, recursiveFileLookup="true", **options).load(folder)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    if exclude:
        df = df.where(~name.rlike(exclude))
    return df.select("*", name.alias(tag)) if tag else df


def retried[T](action: Callable[[], T], *, attempts: int, wait: float = 1.0, transient: str = TRANSIENT) -> T:
    """The action's result; an error whose text matches ``transient`` is tried again after a pause that doubles."""
    for k in range(attempts):
        try:
            return action()
        except Exception as e:
            if k == attempts - 1 or not re.search(transient, str(e)):
                raise
            time.sleep(wait * 2**k)
    raise ValueError("attempts must be positive")


def read_database(spark: SparkSession, url: str, query: str, *, partition: tuple[str, int, int, int] | None = None, attempts: int = 1, wait: float = 1.0, **options: str) -> DataFrame:
    """A query's rows over JDBC; ``partition`` (column, low, high, parts) reads in parallel.

    The bounds only cut the ranges: rows below, above or with a null column are read too. With more than one attempt the
    rows are read and written at once, so that a deadlock or lock timeout during the read is tried again as a whole.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition:
        column, low, high, parts = partition
        reader = reader.option("dbtable", f"({query}) q").option("partitionColumn", column).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
    else:
        reader = reader.option("query", query)
    return reader.load() if attempts == 1 else retried(lambda: saved(reader.load()), attempts=attempts, wait=wait)


def run_template(spark: SparkSession, text: str, names: Mapping[str, str], **parameters: object) -> DataFrame:
    """SQL with table names as IDENTIFIER(:name) and values as :parameters."""
    return spark.sql(text, args={**names, **parameters})


def query_folder(spark: SparkSession, sql: str, folder: str, tables: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """SQL over the files of a folder, each a table of its own name."""
    suffix = {"parquet": ".parquet", "csv": ".csv"}[fmt]
    for t in tables:
        spark.read.format(fmt).options(**({"header": "true", "inferSchema": "true"} if fmt == "csv" else {})).load(f"{folder}/{t}{suffix}").createOrReplaceTempView(t)
    return spark.sql(sql)


def write_table(
    df: DataFrame, path: str, *, fmt: str = "parquet", files: int | None = None, rows_per_file: int | None = None, bytes_per_file: int | None = None,
    unique: bool = False, fill: object = None, partition_by: Sequence[str] = (), mode: str = "errorifexists",
) -> None:
    """Write, in n files, of at most so many rows, or (csv and tsv) so many bytes each; without repeated rows, nulls filled, if wanted.

    A limit of bytes becomes one of rows by the longest row, header included, so no file is over it; a longer row is an error.
    """
    df = df.dropDuplicates() if unique else df
    df = df.fillna(fill) if fill is not None else df
    layout = {"csv": {"header": "true"}, "tsv": {"header": "true", "sep": "\t"}}.get(fmt, {})
    if bytes_per_file:
        if not layout:
            raise ValueError("files are cut by bytes in csv and tsv only")
        df = saved(df)
        body = [c for c in df.columns if c not in partition_by]
        # a quoted or escaped cell takes at most two bytes for each of its own, and two quotes
        longest = df.select((sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) * 2 for c in body), F.lit(0)) + 3 * len(body) + 1).alias("n")).agg(F.max("n")).first()[0] or 1
        room = bytes_per_file - sum(len(c.encode()) * 2 + 3 for c in body) - 1
        if longest > room:
            raise ValueError(f"a row takes up to {longest} bytes, a file has room for {room}")
        rows_per_file = min(rows_per_file or room, room // longest)
    df = df.repartition(files) if files else df
    writer = df.write.format("csv" if layout else fmt).mode(mode).options(**layout)
    writer = writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer.save(path)


def _fitted(columns: Sequence[str], target: Mapping[str, tuple[str, int | None, bool]], truncate: bool) -> tuple[list[Column], Column]:
    """The target's columns, and the names of those that a row does not fit."""
    good, unfit = [], []
    for c, (kind, length, nullable) in target.items():
        source = F.col(f"`{c}`") if c in columns else F.lit(None).cast("string")
        x = F.expr(f"try_cast(`{c}` AS {kind})") if c in columns else source.cast(kind)
        bad = source.isNotNull() & x.isNull()
        if length:
            bad = bad if truncate else bad | F.coalesce(F.length(x) > length, F.lit(False))
            x = F.substring(x, 1, length)
        if not nullable:
            bad = bad | x.isNull()
        good.append(x.alias(c))
        unfit.append(F.when(bad, F.lit(c)))
    return good, F.array_compact(F.array(*unfit))


def conform(df: DataFrame, target: Mapping[str, tuple[str, int | None, bool]], *, truncate: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows cast to target columns (type, length, nullable), and rows that do not fit.

    A value that does not convert, is too long (unless cut) or is null where it may not be makes a row unfit.
    """
    good, unfit = _fitted(df.columns, target, truncate)
    marked = df.withColumn("_unfit", unfit)
    return marked.where(F.size("_unfit") == 0).select(*good), marked.where(F.size("_unfit") > 0).drop("_unfit")


def append_table(df: DataFrame, target: Mapping[str, tuple[str, int | None, bool]], *, write: Callable[[DataFrame], None], review: Callable[[DataFrame], None], batch: Column | None = None, truncate: bool = False) -> None:
    """Append the rows that fit a target table; the others go to a table for review, with the columns that do not fit.

    With a ``batch``, one unfit row holds back all rows of its batch (null is a batch too); rows held back for another's
    sake go to review with no columns named. Both tables come from one reading of ``df``. ``write`` and ``review`` append
    (``to_folder``, ``to_database``); the review is written first, so a failure of the second write loses no row.
    """
    good, unfit = _fitted(df.columns, target, truncate)
    rows = saved(df.select(*(F.col(f"`{c}`") for c in df.columns), unfit.alias("_unfit"), (F.lit(None).cast("string") if batch is None else F.coalesce(F.concat(F.lit("="), batch.cast("string")), F.lit(""))).alias("_batch")))
    if batch is None:
        fits, held = rows.where(F.size("_unfit") == 0), rows.where(F.size("_unfit") > 0)
    else:
        blocked = rows.where(F.size("_unfit") > 0).select("_batch").distinct()
        fits, held = rows.join(blocked, "_batch", "left_anti"), rows.join(blocked, "_batch", "left_semi")
    review(held.select(*(F.col(f"`{c}`") for c in df.columns), F.col("_unfit").alias("unfit")))
    write(fits.select(*good))


def to_folder(path: str, fmt: str = "parquet") -> Callable[[DataFrame], None]:
    return lambda df: df.write.format(fmt).mode("append").save(path)


def to_database(url: str, table: str, **options: str) -> Callable[[DataFrame], None]:
    """Appends over JDBC, one transaction a task. A write is not tried again as a whole: parts of it may stand already."""
    return lambda df: df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode("append").save()


def bucket_by_id(df: DataFrame, key: str, n: int, known: DataFrame | None = None) -> DataFrame:
    """All rows of an id in the same of n batches; ids already in ``known`` (key, batch) keep theirs."""
    fresh = F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    if known is None:
        return df.withColumn("batch", fresh)
    return df.join(known.select(key, F.col("batch").alias("_b")), key, "left").withColumn("batch", F.coalesce("_b", fresh)).drop("_b")


def load_effective_dated(loaded: DataFrame, releases: DataFrame, codes: DataFrame, *, code: str, release: str, modifier: str) -> DataFrame:
    """New rows of reference releases: without modifier, code mapped to concept, releases already loaded left out."""
    new = releases.where(F.col(modifier).isNull() | (F.trim(modifier) == "")).join(loaded.select(release).distinct(), release, "left_anti")
    return new.join(codes, code)


def zip_ranks(frames: Sequence[DataFrame], *, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Files of several regions with other names of columns in one table, by nine-digit key, the least value of each column a key."""
    same = [f.select(*(F.col(old).alias(columns[old]) for old in f.columns if old in columns)) for f in frames]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), same)
    return rows.withColumn(key, F.regexp_extract(F.regexp_replace(key, "[^0-9]", ""), "([0-9]{9})", 1)).where(F.col(key) != "").groupBy(key).agg(*(F.min(c).alias(c) for c in rows.columns if c != key))


def package_dataset(frames: Mapping[str, DataFrame], split: DataFrame, y: DataFrame, *, key: str) -> dict[str, DataFrame]:
    """Frames on the ids that all of them, the split and y have, with the split attached; y too, as 'y'."""
    ids = reduce(lambda a, b: a.join(b.select(key).distinct(), key, "left_semi"), [*frames.values(), y], split.select(key).distinct())
    on = split.join(ids, key, "left_semi").select(key, "split")
    return {name: f.join(on, key) for name, f in {**frames, "y": y}.items()}


def _write_kinds(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """A folder for each kind of columns, missing indicators apart, and in it one for each split."""
    kinds: dict[str, list[str]] = {}
    for c, t in df.dtypes:
        if c not in keys:
            kinds.setdefault("missing" if c.endswith("_missing_ind") else kind_of(t), []).append(c)
    for kind, columns in kinds.items():
        df.select(*keys, *columns).write.partitionBy("split").parquet(f"{path}/{kind}")


def write_package(frames: Mapping[str, DataFrame], split: DataFrame, y: DataFrame, *, key: str, path: str, sequences: Mapping[str, str] | None = None) -> None:
    """Write aligned frames (``package_dataset``) for a trainer: path/name/kind/split=..., kinds as in ``columns_by_kind`` and ``missing``.

    ``sequences`` names the time column of frames with many rows an id. Their rows carry a ``position``, which runs from
    0 in each split in the order of id and time, and path/name/offsets has each id's first position (``start``) and
    ``length``. Positions come from a sort over ranges, so neither a long sequence nor a large split is one task's; rows
    with equal time are ordered by their other columns, repeated rows stay.
    """
    sequences = sequences or {}
    for name, df in package_dataset(frames, split, y, key=key).items():
        if name not in sequences:
            _write_kinds(df, f"{path}/{name}", [key, "split"])
            continue
        order = ["split", key, sequences[name]]
        ordered = sort_globally(df, [F.col(c) for c in (*order, *(c for c in df.columns if c not in order))])
        first = ordered.groupBy("split").agg(F.min("position").alias("_first"))
        placed = saved(ordered.join(first, "split").withColumn("position", F.col("position") - F.col("_first")).drop("_first"))
        _write_kinds(placed.sortWithinPartitions("split", "position"), f"{path}/{name}", [key, "split", "position"])
        offsets = placed.groupBy("split", key).agg(F.min("position").alias("start"), F.count("*").alias("length"))
        offsets.write.partitionBy("split").parquet(f"{path}/{name}/offsets")


def read_package(spark: SparkSession, path: str, name: str, kind: str, splits: Sequence[str] = ()) -> DataFrame:
    """One kind of columns of a packaged frame (or its ``offsets``), of some splits together or of all; positions run within a split."""
    df = spark.read.parquet(f"{path}/{name}/{kind}")
    return df.where(F.col("split").isin(*splits)) if splits else df


def populate_cohort(members: DataFrame, existing: DataFrame, *, definition_name: str, subject: str, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the cohort table and of its definition table, under the next free definition id."""
    if members.where(F.col(subject).isNull() | F.col(start).isNull()).limit(1).count():
        raise ValueError("subject and start must not be null")
    number = (existing.agg(F.max("cohort_definition_id")).first()[0] or 0) + 1
    rows = members.select(F.lit(number).alias("cohort_definition_id"), F.col(subject).alias("subject_id"), F.col(start).alias("cohort_start_date"), F.col(end).alias("cohort_end_date"))
    spark = members.sparkSession
    return rows, spark.createDataFrame([(number, definition_name)], "cohort_definition_id int, cohort_definition_name string")
