"""Data-quality reports, scores, gates and profiles (batch)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir import schema
from clickweir.functions.columns import ratio, seconds_between
from clickweir.operators.joins import lookup_join
from clickweir.workspace import materialise


def _counts(critical: Sequence[str], amount: str, ts: str) -> list[Column]:
    """Everything one pass can say about a set of rows."""
    return [
        F.count("*").alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in critical],
        F.max(ts).alias("latest_timestamp"),
        F.avg(amount).alias("amount_mean"),
        F.stddev_samp(amount).alias("amount_std"),
        F.min(amount).alias("amount_min"),
        F.max(amount).alias("amount_max"),
    ]


def outside(value: Column, mean: Column, std: Column, sigmas: float = 3.0) -> Column:
    """True when ``value`` lies more than ``sigmas`` deviations from the mean."""
    return (value > mean + sigmas * std) | (value < mean - sigmas * std)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_count, null_share)`` per column, from one pass."""
    names = list(columns or df.columns)
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("null_count")
            )
            for c in names
        ]
    )
    long = df.agg(F.count("*").alias("rows"), entries.alias("entries")).select(
        "rows", F.inline("entries")
    )
    return long.select(
        "column_name",
        "null_count",
        ratio(F.col("null_count"), F.col("rows")).alias("null_share"),
    )


def duplicate_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key; null keys form one key.

    Only the key columns are read, and they are counted in the map tasks
    before they move.
    """
    copies = df.groupBy(*key).agg(F.count("*").alias("copies"))
    return copies.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_records")
    )


def amount_moments(df: DataFrame, amount: str = "amount") -> DataFrame:
    """Mean, sample deviation, minimum and maximum of the non-null amounts."""
    return df.agg(
        F.avg(amount).alias("amount_mean"),
        F.stddev_samp(amount).alias("amount_std"),
        F.min(amount).alias("amount_min"),
        F.max(amount).alias("amount_max"),
    )


def outlier_count(df: DataFrame, amount: str = "amount", sigmas: float = 3.0) -> DataFrame:
    """Rows whose amount lies outside mean ± ``sigmas`` deviations."""
    stats = df.agg(
        F.struct(F.avg(amount).alias("mean"), F.stddev_samp(amount).alias("std"))
    ).scalar()
    out = outside(F.col(amount), stats.getField("mean"), stats.getField("std"), sigmas)
    return df.agg(F.count_if(out).alias("outlier_records"))


def quality_score(
    nulls: Column, duplicates: Column, outliers: Column, total: Column
) -> Column:
    """0 to 100: 100 less 30, 20 and 10 points times the share of each defect."""
    penalty = nulls * 30 / total + duplicates * 20 / total + outliers * 10 / total
    score = F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100 - penalty))
    return F.when(total > 0, score).otherwise(0.0)


def _finish(report: DataFrame, critical: Sequence[str], as_of: datetime | None) -> DataFrame:
    """Shares, staleness and score from the counted columns."""
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    latest = F.col("latest_timestamp").cast("timestamp")
    nulls = sum((F.col(f"null_{c}") for c in critical), F.lit(0))
    total = F.col("total_records")
    return report.withColumns(
        {
            "duplicate_share": ratio(F.col("duplicate_records"), total),
            "staleness_hours": seconds_between(latest, now) / 3600,
            "quality_score": quality_score(
                nulls, F.col("duplicate_records"), F.col("outlier_records"), total
            ),
        }
    )


def quality_report(
    df: DataFrame,
    *,
    critical: Sequence[str] = schema.CRITICAL_COLUMNS,
    key: Sequence[str] = ("event_id",),
    amount: str = "amount",
    ts: str = "timestamp",
    as_of: datetime | None = None,
) -> DataFrame:
    """One row with every check of the table.

    Three narrow passes in one plan: all counts and moments together, the key
    column alone for duplicates, the amount column alone for outliers against
    the moments of the first pass. An empty table gives score 0.
    """
    first = df.agg(F.struct(*_counts(critical, amount, ts))).scalar()
    out = outside(F.col(amount), first.getField("amount_mean"), first.getField("amount_std"))
    names = [
        "total_records",
        *[f"null_{c}" for c in critical],
        "latest_timestamp",
        "amount_mean",
        "amount_std",
        "amount_min",
        "amount_max",
    ]
    report = df.agg(F.count_if(out).alias("outlier_records")).select(
        *[first.getField(n).alias(n) for n in names],
        duplicate_count(df, key).scalar().alias("duplicate_records"),
        "outlier_records",
    )
    return _finish(report, critical, as_of)


def score_history(
    df: DataFrame,
    by: Sequence[str],
    *,
    critical: Sequence[str] = schema.CRITICAL_COLUMNS,
    key: Sequence[str] = ("event_id",),
    amount: str = "amount",
    ts: str = "timestamp",
    as_of: datetime | None = None,
) -> DataFrame:
    """The quality report per group of ``by``, for example per day.

    The per-group counts are written once and joined back to the amounts for
    the outlier pass; that side has one row per group and its size is checked
    before it is broadcast.
    """
    groups = list(by)
    counts = materialise(df.groupBy(*groups).agg(*_counts(critical, amount, ts)))
    copies = df.groupBy(*groups, *[k for k in key if k not in groups]).agg(
        F.count("*").alias("copies")
    )
    duplicates = copies.groupBy(*groups).agg(
        F.sum(F.col("copies") - 1).alias("duplicate_records")
    )
    judged = lookup_join(
        df.select(*groups, F.col(amount).alias("_amount")).where("_amount is not null"),
        counts.select(*groups, "amount_mean", "amount_std"),
        groups,
    )
    out = outside(F.col("_amount"), F.col("amount_mean"), F.col("amount_std"))
    outliers = judged.groupBy(*groups).agg(F.count_if(out).alias("outlier_records"))
    report = (
        counts.join(duplicates, groups, "left")
        .join(outliers, groups, "left")
        .fillna(0, ["duplicate_records", "outlier_records"])
    )
    return _finish(report, critical, as_of)


def quality_gate(
    report: DataFrame,
    *,
    critical: Sequence[str] = schema.CRITICAL_COLUMNS,
    null_threshold: float = 0.1,
    duplicate_threshold: float = 0.05,
    min_rows: int = 1,
) -> DataFrame:
    """``(check_name, value, threshold, passed)`` for a quality report.

    One null check per critical column, one duplicate check, and one that there
    are ``min_rows`` rows at all (an empty table has no nulls to find).
    """
    total = F.col("total_records")
    checks = [
        (f"null_share_{c}", ratio(F.col(f"null_{c}"), total), null_threshold)
        for c in critical
    ]
    checks.append(("duplicate_share", F.col("duplicate_share"), duplicate_threshold))
    enough = F.struct(
        F.lit("min_rows").alias("check_name"),
        total.cast("double").alias("value"),
        F.lit(float(min_rows)).alias("threshold"),
        (total >= min_rows).alias("passed"),
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                value.alias("value"),
                F.lit(float(limit)).alias("threshold"),
                (value <= limit).alias("passed"),
            )
            for name, value, limit in checks
        ],
        enough,
    )
    return report.select(F.inline(rows))


def split_rows(
    df: DataFrame, rules: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with the names of the rules they break.

    ``rules`` maps a name to the condition a good row meets; an unknown (null)
    outcome counts as broken. Row-wise only, so it works on streams as well.
    """
    broken = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(condition, F.lit(False)), F.lit(name))
                for name, condition in rules.items()
            ]
        )
    )
    judged = df.withColumn("broken_rules", broken)
    good = judged.where(F.size("broken_rules") == 0).drop("broken_rules")
    return good, judged.where(F.size("broken_rules") > 0)


def schema_compliance(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Per column: expected and actual type, what is wrong, and its null count.

    ``df`` must be read with the schema of its own files: a reader given
    ``expected`` would add missing columns as nulls and hide the gap.
    ``issue`` is ``missing``, ``extra``, ``type`` or null.
    """
    spark = df.sparkSession
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for name in [*wanted, *[c for c in found if c not in wanted]]:
        if name not in found:
            issue = "missing"
        elif name not in wanted:
            issue = "extra"
        else:
            issue = None if wanted[name] == found[name] else "type"
        rows.append((name, wanted.get(name), found.get(name), issue))
    verdict = spark.createDataFrame(
        rows, "column_name string, expected_type string, actual_type string, issue string"
    )
    nulls = null_counts(df).select("column_name", "null_count")
    return verdict.join(nulls, "column_name", "left")


# Types that hold every value of those before them, by family.
_WIDER = (("tinyint", "smallint", "int", "bigint"), ("float", "double"))


def _type_change(wanted: T.DataType, found: T.DataType) -> str:
    """``widened`` if every expected value fits the found type, ``narrowed`` if the reverse."""

    def fits(a: T.DataType, b: T.DataType) -> bool:
        small, large = a.simpleString(), b.simpleString()
        if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
            return a.scale <= b.scale and a.precision - a.scale <= b.precision - b.scale
        if isinstance(a, T.IntegralType) and isinstance(b, T.DoubleType):
            return small != "bigint"
        if isinstance(a, T.DateType) and isinstance(b, (T.TimestampType, T.TimestampNTZType)):
            return True
        return any(
            small in order and large in order and order.index(small) < order.index(large)
            for order in _WIDER
        )

    if fits(wanted, found):
        return "widened"
    return "narrowed" if fits(found, wanted) else "type"


def _walk(
    path: str, wanted: T.DataType | None, found: T.DataType | None
) -> list[tuple[str, str | None, str | None, str | None]]:
    """(path, expected, actual, issue) of a type and of all types inside it."""

    def text(kind: T.DataType | None) -> str | None:
        return None if kind is None else kind.simpleString()

    if wanted is None or found is None:
        return [(path, text(wanted), text(found), "missing" if found is None else "extra")]
    if type(wanted) is not type(found):
        return [(path, text(wanted), text(found), _type_change(wanted, found))]
    inside: list[tuple[str, T.DataType | None, T.DataType | None]] = []
    if isinstance(wanted, T.StructType):
        names = [*wanted.names, *[n for n in found.names if n not in wanted.names]]
        inside = [
            (
                f"{path}.{n}" if path else n,
                wanted[n].dataType if n in wanted.names else None,
                found[n].dataType if n in found.names else None,
            )
            for n in names
        ]
    elif isinstance(wanted, T.ArrayType):
        inside = [(f"{path}[]", wanted.elementType, found.elementType)]
    elif isinstance(wanted, T.MapType):
        inside = [
            (f"{path}.key", wanted.keyType, found.keyType),
            (f"{path}.value", wanted.valueType, found.valueType),
        ]
    elif wanted != found:
        return [(path, text(wanted), text(found), _type_change(wanted, found))]
    rows = [(path, text(wanted), text(found), None)] if path and not inside else []
    for step in inside:
        rows += _walk(*step)
    return rows


def nested_compliance(df: DataFrame, expected: T.StructType) -> DataFrame:
    """As ``schema_compliance``, down to the fields of structs, arrays and maps.

    One row per innermost path: ``a.b`` for a field of a struct, ``a[]`` for the
    elements of an array, ``a.key`` and ``a.value`` for those of a map. ``issue``
    is ``missing``, ``extra``, ``widened`` (every expected value fits the type
    found), ``narrowed`` (the reverse), ``type`` or null. ``null_count`` has the
    rows in which a field is null or lies in a null struct; it is null for what
    is missing or inside arrays and maps. One pass counts all of them.
    """
    rows = _walk("", expected, df.schema)
    counted = [
        path for path, _, actual, _ in rows if actual is not None and _column_of(df.schema, path)
    ]
    quoted = [".".join(f"`{part}`" for part in path.split(".")) for path in counted]
    counts = [F.count_if(F.col(q).isNull()).alias(f"n{i}") for i, q in enumerate(quoted)]
    listed = F.array(
        *[
            F.struct(F.lit(path).alias("path"), F.col(f"n{i}").alias("null_count"))
            for i, path in enumerate(counted)
        ]
    )
    verdict = df.sparkSession.createDataFrame(
        rows, "path string, expected_type string, actual_type string, issue string"
    )
    if not counted:
        return verdict.withColumn("null_count", F.lit(None).cast("long"))
    return verdict.join(df.agg(*counts).select(F.inline(listed)), "path", "left")


def _column_of(schema: T.StructType, path: str) -> bool:
    """Whether ``path`` is a column or a field of structs only."""
    kind: T.DataType = schema
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return False
        kind = kind[part].dataType
    return True


def is_compliant(verdict: DataFrame) -> DataFrame:
    """One row: missing and extra columns, and whether none is missing or mistyped."""
    return verdict.agg(
        F.sort_array(F.collect_list(F.when(F.col("issue") == "missing", F.col("column_name"))))
        .alias("missing_columns"),
        F.sort_array(F.collect_list(F.when(F.col("issue") == "extra", F.col("column_name"))))
        .alias("extra_columns"),
        (F.count_if(F.col("issue").isin("missing", "type")) == 0).alias("is_compliant"),
    )


def profile(df: DataFrame) -> DataFrame:
    """One row: row count, column count, column names and schema as JSON."""
    return df.agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(df.columns)).alias("column_names"),
        F.lit(df.schema.json()).alias("schema_json"),
    )


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, *, exact: bool = False
) -> DataFrame:
    """``(column_name, column_type, null_count, distinct_count)``; a null is one more value.

    One pass without a shuffle of values estimates the distinct counts. Exact
    ones (``exact=True``) move every distinct value once per column.
    """
    names = list(columns or df.columns)
    distinct = F.count_distinct if exact else F.approx_count_distinct
    wide = df.agg(
        *[
            F.struct(
                F.count_if(F.col(c).isNull()).alias("null_count"),
                (distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int"))).alias(
                    "distinct_count"
                ),
            ).alias(c)
            for c in names
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(df.schema[c].dataType.simpleString()).alias("column_type"),
                F.col(c)["null_count"].alias("null_count"),
                F.coalesce(F.col(c)["distinct_count"], F.lit(0)).cast("long").alias(
                    "distinct_count"
                ),
            )
            for c in names
        ]
    )
    return wide.select(F.inline(rows))
