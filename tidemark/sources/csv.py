"""The raw CSV format: header, comma, quoted fields that may hold line breaks and doubled quotes.

Spark reads such a file whole, in one task, because a line break may be inside a field. Where a file's
content proves that the cuts are right, it is read in one of two other ways, which give the same rows:

* ``LINES``: every line is a whole record, so the file can be cut at any line;
* ``STITCHED``: some records span lines; a splittable text scan finds where records start.

The proof (``layout``) looks at every line, whatever the size of the file or of a split: fields are plain
without quotes, or quoted from their first to their last character with doubled quotes inside. A file with
anything else in it, such as a stray quote, is read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

WHOLE, LINES, STITCHED = "whole", "lines", "stitched"

FORMAT = {"quote": '"', "escape": '"'}

# A text that is one record: fields are plain, or quoted with doubled quotes inside. The
# possessive quantifiers keep the match linear in the length of the text.
OPEN = '"[^"]*+(?:""[^"]*+)*+'
QUOTED = OPEN + '"'
FIELD = f'(?:{QUOTED}|[^",\\r\\n]*+)'
RECORD = rf"\A{FIELD}(?:,{FIELD})*+\z"
# A line that begins outside or inside of quotes, and may end inside.
FROM_OUTSIDE = rf"\A(?:{FIELD},)*+(?:{FIELD}|{OPEN})\z"
FROM_INSIDE = rf'\A[^"]*+(?:""[^"]*+)*+(?:"(?:,{FIELD}(?=,|\z))*+(?:,{OPEN})?+)?+\z'


class UnclosedQuoteError(Exception):
    """A quoted field reaches to the end of its file."""


class HeaderError(Exception):
    """A file's header differs from the declared columns."""


def read_csv(
    spark: SparkSession, paths: str | list[str], schema: StructType | None, mode: str = WHOLE
) -> DataFrame:
    """All columns as strings, plus ``_file_path``; without a schema the header names them.

    With a schema, a header that differs from it is an error.
    """
    if mode == STITCHED:
        return stitched(spark, paths, schema)
    reader = spark.read.options(
        **FORMAT, header="true", multiLine=str(mode == WHOLE).lower(), recursiveFileLookup="true"
    )
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", "false")
    return reader.csv(paths).select("*", file_path().alias("_file_path"))


def records(spark: SparkSession, paths: list[str], mode: str = WHOLE) -> DataFrame:
    """``_file_path`` once per record, for counting files of any layout."""
    if mode == STITCHED:
        return record_texts(spark, paths).select("_file_path")
    reader = spark.read.options(
        **FORMAT, header="true", multiLine=str(mode == WHOLE).lower(), recursiveFileLookup="true"
    )
    return (
        reader.schema("record string")
        .csv(paths)
        .select(file_path().alias("_file_path"))
    )


def file_path() -> Column:
    """The row's file, as it is named: a plus sign is one, and not a blank."""
    return F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.options(recursiveFileLookup="true", lineSep="\n").text(paths)


def layout(spark: SparkSession, paths: str | list[str]) -> str:
    """How these files may be read; every line is looked at. Raises on a quote that is never closed."""
    value = F.col("value")
    bare = F.when(value.endswith("\r"), F.left(value, F.length(value) - 1)).otherwise(value)
    seen = text_lines(spark, paths).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(value.endswith("\r")).alias("returns"),
        F.count_if(bare.contains("\r")).alias("inner_returns"),
        # the readers differ on lines of blanks
        F.count_if((F.trim(bare) == "") & (bare != "")).alias("blank"),
        # without a quote any line is a record, but for returns, which are counted above
        F.count_if(value.contains('"') & ~bare.rlike(RECORD)).alias("parts"),
    ).first()
    if seen["inner_returns"] or seen["blank"] or seen["returns"] not in (0, seen["lines"]):
        return WHOLE
    if not seen["parts"]:
        return LINES
    if seen["returns"]:
        return WHOLE
    lines = entered_lines(spark, paths)
    fits = F.when(F.col("inside"), value.rlike(FROM_INSIDE)).otherwise(value.rlike(FROM_OUTSIDE))
    blank = ~F.col("inside") & (F.trim(value) == "") & (value != "")
    if not lines.filter(~fits | blank).isEmpty():
        return WHOLE
    ends = text_lines(spark, paths).select(file_path().alias("_file_path"), quotes().alias("odd"))
    open_files = ends.groupBy("_file_path").agg((F.sum("odd") % 2).alias("odd")).filter("odd = 1")
    if found := open_files.orderBy("_file_path").limit(10).collect():
        raise UnclosedQuoteError("unclosed quote in " + ", ".join(r["_file_path"] for r in found))
    return STITCHED


def quotes() -> Column:
    return F.regexp_count("value", F.lit('"')) % 2


def entered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every line with ``inside``: whether it begins inside of quotes (see ``record_texts``)."""
    lines, splits = numbered_lines(spark, paths)
    inside = (F.col("odd_before") + F.col("entered")) % 2 == 1
    return lines.join(splits, ["_file_path", "split"]).withColumn("inside", inside)


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Lines with the quotes before them in their split; one row per split with the state it is
    entered in (1: inside of quotes) and where the record that is open there began."""
    lines = text_lines(spark, paths).select(
        "value",
        file_path().alias("_file_path"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("pos"),
        quotes().alias("odd"),
    )
    in_split = Window.partitionBy("_file_path", "split").orderBy("pos")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("odd_before", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)

    # one row per split: does it flip the state, and where does its last record start if it is
    # entered outside (0) or inside (1) of quotes?
    splits = lines.groupBy("_file_path", "split").agg(
        (F.sum("odd") % 2).alias("flips"),
        *(
            F.max(F.when(F.col("odd_before") == s, F.struct("split", "pos"))).alias(f"last_{s}")
            for s in (0, 1)
        ),
    )
    earlier = (
        Window.partitionBy("_file_path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    )
    entered = F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2
    splits = splits.withColumn("entered", entered)
    last = F.when(F.col("entered") == 0, F.col("last_0")).otherwise(F.col("last_1"))
    splits = splits.withColumn("last_start", last).select(
        "_file_path",
        "split",
        "entered",
        F.last("last_start", ignorenulls=True).over(earlier).alias("open_record"),
    )
    return lines, splits


def record_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(_file_path, record)`` for every record but the header, found in parallel.

    Outside of quotes an even number of quotes has gone by. So a line starts a record when the
    quotes before it in its file are even: those before it in its split, plus those of earlier
    splits, which a small table with one row per split provides. Only lines of records that span
    lines are grouped again; a group is one record.
    """
    lines = entered_lines(spark, paths)
    in_split = Window.partitionBy("_file_path", "split").orderBy("pos")
    lines = lines.withColumn("starts", ~F.col("inside"))
    own_start = F.last(F.when(F.col("starts"), F.struct("split", "pos")), ignorenulls=True)
    lines = lines.select(
        "_file_path",
        "value",
        "split",
        "pos",
        (F.col("starts") & (F.col("odd") == 0)).alias("whole"),
        F.coalesce(own_start.over(in_split), F.col("open_record")).alias("start"),
        ((F.col("split") == 0) & (F.row_number().over(in_split) == 1)).alias("first"),
    )
    single = lines.filter("whole AND NOT first AND value <> ''")
    piece = F.struct("split", "pos", "value", "first")
    spanning = (
        lines.filter("NOT whole")
        .groupBy("_file_path", "start")
        .agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
        .filter("NOT pieces[0].first")
        .select("_file_path", F.array_join("pieces.value", "\n").alias("record"))
    )
    return single.select("_file_path", F.col("value").alias("record")).unionByName(spanning)


def stitched(
    spark: SparkSession, paths: str | list[str], schema: StructType | None
) -> DataFrame:
    """Parse the records of ``record_texts``; a text that is not exactly one record is an error."""
    found = spark.read.options(
        **FORMAT, header="true", multiLine="true", recursiveFileLookup="true"
    ).csv(paths)
    if schema is None:
        schema = StructType([StructField(name, StringType()) for name in found.columns])
    if found.columns != schema.fieldNames():
        raise HeaderError(f"expected {schema.fieldNames()}, found {found.columns}")
    broken = F.raise_error(F.concat(F.lit("not a CSV record: "), F.substring("record", 1, 200)))
    text = F.when(F.col("record").rlike(RECORD), F.col("record")).otherwise(broken)
    names = ", ".join("`" + name.replace("`", "``") + "` string" for name in schema.fieldNames())
    parsed = F.from_csv(text, names, FORMAT)
    return (
        record_texts(spark, paths)
        .select("_file_path", parsed.alias("row"))
        .select("row.*", "_file_path")
    )
