"""Play-log sources (S1, S2) and adapters from the driver tables.

A *plays* frame has the six columns of the listening log::

    userid, timestamp, musicbrainz_artist_id, artist_name,
    musicbrainz_track_id, track_name

all STRING except ``timestamp`` (TIMESTAMP once parsed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PLAY_COLUMNS = (
    "userid",
    "timestamp",
    "musicbrainz_artist_id",
    "artist_name",
    "musicbrainz_track_id",
    "track_name",
)

# Fixed schema of the raw log: six nullable strings, never inferred.
RAW_PLAYS_SCHEMA = StructType([StructField(c, StringType(), True) for c in PLAY_COLUMNS])

# Text form used when plays are written back to TSV (ISO-8601, UTC marker).
TSV_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (Parquet) from a scale-factor folder, as it is now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Escapes of the exact text form: backslash, tab, line feed, carriage return
#: and the marks of NULL and of nothing, so that any text survives a round trip.
NULL_MARK, EMPTY_MARK = "\\N", "\\E"
_ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


def escaped(c: Column) -> Column:
    """A text as one TSV field: its backslashes, tabs and line breaks escaped,
    NULL as ``\\N`` and the empty text as ``\\E``."""
    out = c
    for plain, mark in _ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(mark))
    return F.when(c == "", F.lit(EMPTY_MARK)).otherwise(F.coalesce(out, F.lit(NULL_MARK)))


def unescaped(c: Column) -> Column:
    """The inverse of ``escaped``: escapes are read left to right."""
    parts = F.transform(
        F.split(c, r"\\\\"),  # at escaped backslashes; what is left has no other double one
        lambda p: F.replace(
            F.replace(F.replace(p, F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")
        ),
    )
    return F.when(c == EMPTY_MARK, F.lit("")).when(c != NULL_MARK, F.array_join(parts, "\\"))


def write_exact_tsv(df: DataFrame, path: str, header: bool) -> None:
    """Every column as escaped text, one line per row and one field per column."""
    fields = [escaped(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns]
    writer = df.select(*fields).write.mode("overwrite").option("sep", "\t").option("header", str(header).lower())
    writer.option("quote", "").option("escape", "").option("ignoreLeadingWhiteSpace", "false").option(
        "ignoreTrailingWhiteSpace", "false"
    ).csv(path)


def read_exact_tsv(spark: SparkSession, path: str, schema: StructType, header: bool) -> DataFrame:
    """What ``write_exact_tsv`` wrote; absent and empty fields are NULL."""
    text = StructType([StructField(f.name, StringType(), True) for f in schema.fields])
    reader = spark.read.schema(text).option("sep", "\t").option("header", str(header).lower()).option("quote", "")
    raw = reader.option("escape", "").csv(path)
    return raw.select(*[unescaped(F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_raw_tsv(spark: SparkSession, path: str, quoting: bool = True, exact: bool = False) -> DataFrame:
    """Scan a headerless, tab-separated play log with the fixed schema.

    ``exact=True`` reads the escaped form of ``write_raw_tsv(exact=True)``.

    ``quoting=True`` keeps Spark's default CSV quoting (``"`` quotes, ``\\``
    escapes) as the reference does; ``quoting=False`` reads every field
    verbatim, so titles such as ``"Heroes"`` keep their quote marks.
    Empty fields and missing trailing fields are NULL (PERMISSIVE mode).
    """
    if exact:
        return read_exact_tsv(spark, path, RAW_PLAYS_SCHEMA, header=False)
    reader = (
        spark.read.schema(RAW_PLAYS_SCHEMA)
        .option("sep", "\t")
        .option("header", "false")
        .option("mode", "PERMISSIVE")
    )
    if not quoting:
        reader = reader.option("quote", "")
    return reader.csv(path)


def parse_timestamps(raw: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """STRING -> TIMESTAMP (S2); unparsable text becomes NULL instead of failing."""
    return raw.withColumn(ts_col, F.try_to_timestamp(F.col(ts_col)))


def load_track_data(spark: SparkSession, path: str, quoting: bool = True, exact: bool = False) -> DataFrame:
    """S1 + S2: the typed plays frame from a TSV log."""
    return parse_timestamps(read_raw_tsv(spark, path, quoting=quoting, exact=exact))


#: Why a line of the log is rejected.
BLANK_LINE, WRONG_FIELDS, BAD_TIMESTAMP = "blank", "fields", "timestamp"


def scan_lines(spark: SparkSession, path: str, quoting: bool = True) -> DataFrame:
    """S1 + S2 with every line of the log kept: the six columns, ``line`` (the
    text as it stands in the file) and ``reason``, NULL for a good line.

    A line is rejected if it is blank, has not exactly six fields, or its
    timestamp is given but can't be parsed; its columns hold what could be read.
    Good and rejected rows together are the lines of the file.
    """
    options = {"sep": "\t", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    if not quoting:
        options["quote"] = ""
    schema = StructType([*RAW_PLAYS_SCHEMA.fields, StructField("_bad", StringType(), True)])
    fields = F.from_csv("value", ", ".join(f"{f.name} string" for f in schema), options)
    out = spark.read.text(path).select(F.col("value").alias("line"), fields.alias("_f")).select("line", "_f.*")
    out = parse_timestamps(out.withColumn("_given", F.col("timestamp")))
    reason = (
        F.when(F.trim("line") == "", F.lit(BLANK_LINE))
        .when(F.col("_bad").isNotNull(), F.lit(WRONG_FIELDS))
        .when(F.col("_given").isNotNull() & F.col("timestamp").isNull(), F.lit(BAD_TIMESTAMP))
    )
    return out.select(*PLAY_COLUMNS, "line", reason.alias("reason"))


def good_plays(scanned: DataFrame) -> DataFrame:
    """The typed plays of the lines that are not rejected."""
    return scanned.where("reason IS NULL").select(*PLAY_COLUMNS)


def plays_to_raw(plays: DataFrame) -> DataFrame:
    """Typed plays -> the six-string TSV layout (inverse of S2)."""
    return plays.select(
        *[
            F.date_format(F.col(c), TSV_TIMESTAMP_FORMAT).alias(c) if c == "timestamp" else F.col(c)
            for c in PLAY_COLUMNS
        ]
    )


def write_raw_tsv(plays: DataFrame, path: str, quoting: bool = True, exact: bool = False) -> None:
    """Write plays in the log layout (headerless TSV). Partition-parallel write.

    The log layout has no escape for line breaks or tabs inside a text;
    ``exact=True`` writes every text escaped, so that nothing is lost."""
    if exact:
        return write_exact_tsv(plays_to_raw(plays), path, header=False)
    writer = plays_to_raw(plays).write.mode("overwrite").option("sep", "\t").option("header", "false")
    if not quoting:
        writer = writer.option("quote", "")
    writer.csv(path)


# ---------------------------------------------------------------------------
# Adapters: the driver's tables viewed as play logs (FIXTURES.md §3).
# ---------------------------------------------------------------------------


def events_to_plays(events: DataFrame) -> DataFrame:
    """``events`` as plays: user, time, event type as artist, props as track."""
    return events.select(
        F.col("user_id").cast("string").alias("userid"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("event_type") != F.lit("error"), F.col("event_type")).alias("musicbrainz_artist_id"),
        F.col("event_type").alias("artist_name"),
        F.col("event_id").cast("string").alias("musicbrainz_track_id"),
        F.col("props").alias("track_name"),
    )


def orders_to_plays(orders: DataFrame) -> DataFrame:
    """``orders`` as plays: customer, order date, priority as artist, status as track."""
    return orders.select(
        F.col("o_custkey").cast("string").alias("userid"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("string").alias("musicbrainz_artist_id"),
        F.col("o_orderpriority").alias("artist_name"),
        F.col("o_orderkey").cast("string").alias("musicbrainz_track_id"),
        F.col("o_orderstatus").alias("track_name"),
    )


def _canonical_int(text: str) -> bool:
    try:
        return str(int(text)) == text
    except ValueError:
        return False


def event_plays(spark: SparkSession, sf_dir: str, userid: str | None = None) -> DataFrame:
    """``events`` as plays; ``userid`` keeps one user's plays.

    ``userid`` is a STRING in the plays layout but a BIGINT in ``events``: a
    comparison on the cast string cannot reach the Parquet reader, so when
    the id is a canonical integer the equality is also applied to the native
    column, where it becomes a pushed filter (row-group skipping). The string
    equality stays on top, so the result is the same for any input.
    """
    ev = table(spark, sf_dir, "events")
    if userid is None:
        return events_to_plays(ev)
    if _canonical_int(userid):
        ev = ev.filter(F.col("user_id") == F.lit(int(userid)))
    return events_to_plays(ev).filter(F.col("userid") == F.lit(userid))


def order_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_to_plays(table(spark, sf_dir, "orders"))
