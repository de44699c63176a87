"""Column profile of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.operators.dedup import ranked
from ledgermill.operators.ranking import first_values
from ledgermill.sources.tables import in_sample


def rendered_type(data_type: T.DataType) -> str:
    """Type name as catalog listings print it."""
    if isinstance(data_type, T.DecimalType):
        return f"NUMBER({data_type.precision},{data_type.scale})"
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "NUMBER(38,0)"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "FLOAT"
    if isinstance(data_type, T.VarcharType):
        return f"TEXT({data_type.length})"
    if isinstance(data_type, T.StringType):
        return "TEXT"
    return data_type.simpleString().upper()


def metadata(df: DataFrame) -> DataFrame:
    """Ordinal, name and type per column, from the schema alone."""
    rows = [
        (i, f.name, rendered_type(f.dataType), "YES" if f.nullable else "NO")
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, column_name string, data_type string, is_nullable string"
    )


def _sort_key(value: Column, data_type: T.DataType) -> Column:
    """The place of a value, given as text, among those of its type: an exact number, which combines in any order."""
    exact = "decimal(38,18)"
    if isinstance(data_type, T.BooleanType):
        return F.when(value == "true", 1).otherwise(0).cast(exact)
    if isinstance(data_type, T.DateType):
        return F.unix_date(value.try_cast("date")).cast(exact)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.try_cast("timestamp")).cast(exact)
    return value.try_cast(exact)


def _shown(key: Column, data_type: T.DataType) -> Column:
    """The text of the value that has a sort key."""
    if isinstance(data_type, T.BooleanType):
        return (key == 1).cast("string")
    if isinstance(data_type, T.DateType):
        return F.date_add(F.lit("1970-01-01").cast("date"), key.cast("int")).cast("string")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(key.cast("bigint")).cast(data_type).cast("string")
    return key.cast(data_type).cast("string")


def profile(
    df: DataFrame, sample_pct: float | None = None, sample_keys: Sequence[str] | None = None, k: int = 5, few: int = 5
) -> DataFrame:
    """One row per column: range, lengths, distinct count, null share, samples, composition.

    Blank text counts as null.  The table is read once: values are counted per
    column, combined before the shuffle, and all else is read off these counts by two
    branches of one exchange.  Ranges are taken over numbers (days, microseconds) that stand
    for the values.  Samples are the ``k`` values smallest by md5; a column with fewer
    than ``few`` values has all of them among the first ``few``, so its composition comes
    from the same rows.  A sample (by a hash of its keys, all columns by default) applies
    to samples and compositions only.
    """
    fields = list(enumerate(df.schema.fields, 1))
    text = [i for i, f in fields if isinstance(f.dataType, (T.StringType, T.VarcharType))]
    floats = [i for i, f in fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    plain = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.FloatType, T.DoubleType, T.StringType, T.VarcharType)
    exact = [(i, f.dataType) for i, f in fields if not isinstance(f.dataType, plain)]

    def by_column(cases: Sequence[tuple[int, Column]], kind: str) -> Column:
        chosen = F.lit(None).cast(kind)
        for i, column in cases:
            chosen = F.when(F.col("ordinal") == i, column).otherwise(chosen)
        return chosen

    sampled = F.lit(1) if sample_pct is None else F.when(in_sample(sample_pct, sample_keys or df.columns), 1).otherwise(0)
    marked = df.withColumn("__sampled", sampled)
    cells = F.array(*(F.struct(F.lit(i).alias("ordinal"), F.col(f"`{f.name}`").cast("string").alias("value")) for i, f in fields))
    rows = marked.select("__sampled", F.inline(cells)).withColumn("value", F.when(F.trim("value") != "", F.col("value")))
    counts = rows.groupBy("ordinal", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("__sampled").alias("n_sampled"))
    counts = counts.where((F.col("n") > 0) & (F.col("n_sampled") >= 0))  # both branches need both, so they share one exchange

    value, present = F.col("value"), F.col("value").isNotNull()
    number = by_column([(i, _sort_key(value, kind)) for i, kind in exact], "decimal(38,18)")
    real = F.when(F.col("ordinal").isin(*floats), value.try_cast("double")) if floats else F.lit(None).cast("double")
    size = F.when(F.col("ordinal").isin(*text), F.length(value)) if text else F.lit(None).cast("int")
    keyed = counts.select("ordinal", "value", "n", "n_sampled", number.alias("number"), real.alias("real"), size.alias("size"))
    spread = keyed.groupBy("ordinal").agg(
        F.count("value").alias("distinct_count"), F.sum("n").alias("total"),
        F.sum(F.when(present, F.col("n")).otherwise(0)).alias("filled"),
        F.sum(F.when(present, F.col("n_sampled")).otherwise(0)).alias("sampled_filled"),
        F.min("size").alias("min_length"), F.max("size").alias("max_length"),
        F.min("number").alias("low"), F.max("number").alias("high"), F.min("real").alias("low_real"), F.max("real").alias("high_real"),
    )

    def edge(end: str) -> Column:
        cases = [(i, _shown(F.col(end), kind)) for i, kind in exact]
        return by_column(cases + [(i, F.col(f"{end}_real").cast("string")) for i in floats], "string")

    seen = present & (F.col("n_sampled") > 0)
    first = ranked(counts, ["ordinal"], [F.when(seen, 0).otherwise(1), F.md5("value")], "place").where(F.col("place") <= max(k, few))
    share = F.round(F.col("n_sampled") * 100.0 / F.col("sampled_filled"), 2).cast("string")
    stat = F.concat("value", F.lit(" ("), F.col("n_sampled").cast("string"), F.lit(", "), share, F.lit("%)"))
    shown = first.join(F.broadcast(spread.select("ordinal", "distinct_count", "sampled_filled")), "ordinal").select(
        "ordinal", "value",
        F.when(seen & (F.col("place") <= k), F.col("value")).alias("sample"),
        F.when(seen & (F.col("distinct_count") < few), stat).alias("stat"),
    )
    lists = shown.groupBy("ordinal").agg(
        F.sort_array(F.collect_list("sample")).alias("samples"),
        F.array_sort(F.collect_list(F.when(F.col("stat").isNotNull(), F.struct("value", "stat")))).alias("stats"),
    )

    def joined(column: Column, between: str) -> Column:
        return F.when(F.size(column) > 0, F.array_join(column, between))

    return (
        metadata(df)
        .join(F.broadcast(spread), "ordinal", "left")
        .join(F.broadcast(lists), "ordinal", "left")
        .select(
            "ordinal", "column_name", "data_type", "is_nullable", edge("low").alias("min_value"), edge("high").alias("max_value"),
            "min_length", "max_length", "distinct_count",
            F.round((F.col("total") - F.col("filled")) * 100.0 / F.col("total"), 2).alias("null_pct"),
            joined(F.col("samples"), ", ").alias("sample_values"), joined(F.col("stats")["stat"], " | ").alias("value_composition"),
        )
    )


def sample_values(df: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` non-null values of each column with its type."""
    return first_values(df, k).join(F.broadcast(metadata(df).select("ordinal", "data_type")), "ordinal").select(
        "ordinal", "column_name", "data_type", F.col("value").alias("sample_value")
    )
