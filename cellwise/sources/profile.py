"""The profile of a stored dataset, and its verification."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.functions.scalar import megabytes
from cellwise.session import local_frame

PROFILE_SCHEMA = (
    "n_samples bigint, n_features bigint, n_categories bigint, x_nnz bigint, y_nnz bigint, "
    "x_path string, y_path string, x_size_mb double, y_size_mb double, "
    "download_time_s double, save_time_s double"
)


def density_pct(nnz: int, rows: int, cols: int) -> float | None:
    """Share of stored cells in percent, three decimals."""
    return round(100.0 * nnz / (rows * cols), 3) if rows and cols else None


def dataset_profile(
    x: DataFrame, y: DataFrame, n_samples: int, n_features: int, n_categories: int
) -> DataFrame:
    """One row: declared dimensions, stored entries and density of both matrices.

    Dimensions are declared, since empty rows and columns leave no entries to
    count them by.
    """
    spark = x.sparkSession
    x_nnz, y_nnz = x.count(), y.count()
    row = (
        n_samples, n_features, n_categories, x_nnz, y_nnz,
        density_pct(x_nnz, n_samples, n_features), density_pct(y_nnz, n_samples, n_categories),
    )
    schema = (
        "n_samples bigint, n_features bigint, n_categories bigint, x_nnz bigint, y_nnz bigint, "
        "x_density_pct double, y_density_pct double"
    )
    return local_frame(spark, [row], schema)


def megabytes_at(spark: SparkSession, path: str) -> float:
    """Size of the Parquet files below ``path``; lists files without reading them."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    return megabytes(float(files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]))


def profile_checks(x: DataFrame, y: DataFrame, n_samples: int, n_features: int, n_categories: int,
                   expected: DataFrame) -> DataFrame:
    """``(check, expected, actual, ok)`` for dimensions and stored entries."""
    actual = dataset_profile(x, y, n_samples, n_features, n_categories)
    names = ["n_samples", "n_features", "n_categories", "x_nnz", "y_nnz"]

    def tall(frame: DataFrame, output: str) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias(output)) for c in names])
        return frame.select(F.inline(cells))

    joined = tall(expected, "expected").join(tall(actual, "actual"), "check")
    return joined.select(
        "check", "expected", "actual", F.col("expected").eqNullSafe(F.col("actual")).alias("ok")
    )


def _key_columns(x: DataFrame, y: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    """The four dictionaries of a dataset: matrix and key column of each."""
    column = next(c for c in x.columns if c not in ("row_id", "value"))
    category = next(c for c in y.columns if c not in ("row_id", "value"))
    return {"x_rows": (x, "row_id"), "x_columns": (x, column), "y_rows": (y, "row_id"), "y_columns": (y, category)}


def _entry_counts(matrix: DataFrame, column: str) -> DataFrame:
    return matrix.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("nnz"))


def write_dictionaries(x: DataFrame, y: DataFrame, out_dir: str, declared: dict[str, DataFrame]) -> None:
    """Store ``(key, nnz, declared)`` of the rows and columns of both matrices.

    ``declared`` may name all ``rows``, ``columns`` and ``categories`` (one column each), those
    without entries included; else only keys that occur are stored.
    """
    sources = {"x_rows": "rows", "y_rows": "rows", "x_columns": "columns", "y_columns": "categories"}
    for name, (matrix, column) in _key_columns(x, y).items():
        counts, whole = _entry_counts(matrix, column), declared.get(sources[name])
        if whole is not None:
            keys = whole.select(F.col(whole.columns[0]).alias("key")).distinct()
            counts = keys.join(counts, "key", "full").select("key", F.coalesce("nnz", F.lit(0)).alias("nnz"))
        marked = counts.withColumn("declared", F.lit(whole is not None))
        marked.sortWithinPartitions("key").write.mode("overwrite").parquet(f"{out_dir}/keys/{name}")


def _dictionary_checks(matrix: DataFrame, column: str, stored: DataFrame) -> tuple[int, bool, int, int]:
    """Keys stored, whether they were declared, their end if they are numbers, and keys whose entries changed."""
    found = _entry_counts(matrix, column).withColumnRenamed("nnz", "found")
    both = stored.join(found, "key", "full")
    changed = ~F.coalesce("nnz", F.lit(0)).eqNullSafe(F.coalesce("found", F.lit(0))) | F.col("nnz").isNull()
    integral = stored.schema["key"].dataType.typeName() in ("integer", "long", "short", "byte")
    end = F.max("key").cast("bigint") + 1 if integral else F.lit(0).cast("bigint")
    row = both.agg(
        F.count("nnz"), F.coalesce(F.bool_or("declared"), F.lit(False)), F.coalesce(end, F.lit(0)), F.count_if(changed)
    ).first()
    return tuple(row)


def verification(spark: SparkSession, out_dir: str) -> DataFrame:
    """``(check, expected, actual, ok)`` of a stored dataset against its profile and dictionaries.

    Stored entries and dimensions are compared with the profile, the entries of every row and
    column with the dictionaries: ``*_changed`` counts keys that were lost, are new or have another
    number of entries.  A dataset without profile, matrices or dictionaries is an error.
    """
    try:
        profile = spark.read.schema(PROFILE_SCHEMA).json(f"{out_dir}/profile").first()
    except AnalysisException as problem:
        raise FileNotFoundError(f"no profile in {out_dir}: ingest the dataset first") from problem
    if profile is None:
        raise FileNotFoundError(f"the profile in {out_dir} is empty")

    def stored(path: str) -> DataFrame:
        try:
            return spark.read.parquet(path)
        except AnalysisException as problem:
            raise FileNotFoundError(f"missing data: {path}") from problem

    x, y = stored(profile["x_path"]), stored(profile["y_path"])
    checks = [
        (name, profile[name], n, n == profile[name]) for name, n in (("x_nnz", x.count()), ("y_nnz", y.count()))
    ]
    dimensions = {"x_rows": "n_samples", "y_rows": None, "x_columns": "n_features", "y_columns": "n_categories"}
    changes = []
    for name, (matrix, column) in _key_columns(x, y).items():
        n, declared, end, changed = _dictionary_checks(matrix, column, stored(f"{out_dir}/keys/{name}"))
        dimension = dimensions[name]
        if dimension:
            size = profile[dimension]
            # row ids need not be consecutive, ids of columns run from 0
            actual = n if declared or column == "row_id" else max(n, end)
            checks.append((dimension, size, actual, actual == size if declared else actual <= size))
        changes.append((f"{name}_changed", 0, changed, changed == 0))
    return local_frame(spark, checks + changes, "check string, expected bigint, actual bigint, ok boolean")


def verify_profile(spark: SparkSession, out_dir: str) -> DataFrame:
    """:func:`verification`, raising on the first check that fails."""
    checks = verification(spark, out_dir)
    for check, expected, actual, ok in checks.collect():
        if not ok:
            raise ValueError(f"{check} does not match the profile: recorded {expected}, found {actual}")
    return checks
