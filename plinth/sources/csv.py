"""CSV scan with pandas-style missing tokens, and CSV sinks.

Spark's CSV reader knows one ``nullValue``; a table written by other tools
marks gaps with several tokens.  The scan reads every column as text,
turns the tokens into NULL and then casts to the declared schema (ANSI
cast: a bad value fails loudly instead of silently becoming NULL).  With
no schema, the types are inferred in one aggregate over all columns:
integer if every value is a whole number, double if every value is a
number, else string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default missing-value tokens of pandas.read_csv.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             na_tokens: tuple = NA_TOKENS, multiline: bool = False) -> DataFrame:
    """A quote inside a quoted value is doubled.  ``multiline`` also reads line breaks inside
    quotes; a file is then one task, so leave it off for large files without such values."""
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multiline}
    header = spark.read.options(**options).csv(path).columns
    text_schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
    raw = (spark.read.schema(text_schema).options(**options)
           .option("nullValue", "\u0000").option("emptyValue", "").csv(path))
    tokens = list(na_tokens)
    cleaned = raw.select([F.when(F.col(f"`{c}`").isin(tokens), None).otherwise(F.col(f"`{c}`")).alias(c)
                          for c in header])
    if schema is None:
        schema = infer_schema(cleaned)
    return cleaned.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def infer_schema(text_df: DataFrame) -> T.StructType:
    """Column types from one aggregate over all text columns."""
    aggs = []
    for c in text_df.columns:
        col = F.col(f"`{c}`")
        as_double = F.expr(f"try_cast(`{c}` AS DOUBLE)")
        as_long = F.expr(f"try_cast(`{c}` AS BIGINT)")
        aggs += [F.count(col).alias(f"n|{c}"),
                 F.count(as_double).alias(f"d|{c}"),
                 F.count(F.when(as_long.isNotNull() & ~col.contains("."), 1)).alias(f"l|{c}")]
    row = text_df.agg(*aggs).first().asDict()
    fields = []
    for c in text_df.columns:
        n, nd, nl = row[f"n|{c}"], row[f"d|{c}"], row[f"l|{c}"]
        if n > 0 and nl == n:
            dtype = T.LongType()
        elif n > 0 and nd == n:
            dtype = T.DoubleType()
        elif n == 0:
            dtype = T.DoubleType()      # an all-missing column reads as float, like pandas
        else:
            dtype = T.StringType()
        fields.append(T.StructField(c, dtype, True))
    return T.StructType(fields)


def write_csv(df: DataFrame, path: str, na_token: str = "") -> str:
    """Header CSV folder (one file per task, no index column); inner quotes are doubled."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", na_token)
     .option("emptyValue", na_token).csv(path))
    return path
