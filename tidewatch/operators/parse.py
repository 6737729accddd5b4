"""Wire format: topic rows -> CSV lines -> 40 typed fields, and back.

All row-wise; each works on batch and streaming DataFrames alike (no Python).
The split stands behind a one-row generator, so the line and its split are computed once
and shared by the width filter, later filters and the 40 projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import once, to_double, to_int
from ..schema import LABEL_COLUMN, PREDICTION_SCHEMA, TRAFFIC_FIELDS, TRAFFIC_WIDTH

# which record of the traffic topic a prediction is of, and which model made it
ORIGIN_FIELDS = ("source_topic", "source_partition", "source_offset")
PUBLISHED_SCHEMA = T.StructType(
    [
        *PREDICTION_SCHEMA.fields,
        T.StructField("source_topic", T.StringType()),
        T.StructField("source_partition", T.IntegerType()),
        T.StructField("source_offset", T.LongType()),
        T.StructField("model_version", T.StringType()),
    ]
)

JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def decode_topic(df: DataFrame, keep_key: bool = False) -> DataFrame:
    """Kafka rows to ``(kafka_timestamp, csv_line)`` text (``key`` too if asked)."""
    cols = [F.col("timestamp").alias("kafka_timestamp")]
    if keep_key:
        cols.append(F.col("key").cast("string").alias("key"))
    cols.append(F.col("value").cast("string").alias("csv_line"))
    return df.select(*cols)


def split_line(df: DataFrame, col: str = "csv_line", out: str = "values") -> DataFrame:
    """Split on commas, keeping trailing empty fields (``a,b,,`` is 4 wide)."""
    return once(df, out, F.split(F.col(col), ",", -1))


def width(values: str | Column = "values") -> Column:
    v = F.col(values) if isinstance(values, str) else values
    return F.size(v)


def valid_width(df: DataFrame, n: int = TRAFFIC_WIDTH, values: str = "values") -> DataFrame:
    """Keep records with exactly ``n`` fields and a non-null first field: the
    first field of a split line is never NULL and a NULL line has a NULL
    size, so the width test alone decides."""
    return df.filter(F.size(values) == n)


def check_width(df: DataFrame, col: str = "csv_line", n: int = TRAFFIC_WIDTH) -> DataFrame:
    """Data-quality rows: every line whose field count is not ``n``."""
    w = F.size(F.split(F.col(col), ",", -1))
    return df.withColumn("width", w).filter(F.col("width") != n)


def width_summary(df: DataFrame, col: str = "csv_line", n: int = TRAFFIC_WIDTH) -> DataFrame:
    """One row: lines checked, lines of the wrong width, and an all-good flag."""
    line = F.col(col)
    w = F.length(line) - F.length(F.replace(line, F.lit(","), F.lit(""))) + 1  # one field more than commas
    return df.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(w != n).alias("bad_lines"),
    ).withColumn("all_good", F.col("bad_lines") == 0)


def parse_traffic(
    df: DataFrame,
    values: str = "values",
    keep: tuple[str, ...] = ("kafka_timestamp",),
    wide_counts: bool = False,
    rate_value: bool = True,
) -> DataFrame:
    """Typed positional projection of the 40 fields.

    Doubles parse leniently (bad text -> NULL, ``inf`` kept); int fields are
    truncated through double (``0.500000`` -> 0) unless ``wide_counts`` keeps
    them as doubles. ``Rate`` keeps its raw text; ``rate_value`` adds it as a
    double.
    """
    arr = F.col(values)
    cols: list[Column] = [F.col(k) for k in keep if k in df.columns]
    for i, (name, kind) in enumerate(TRAFFIC_FIELDS):
        item = F.get(arr, i)
        if kind == "double" or (kind == "int" and wide_counts):
            cols.append(to_double(item).alias(name))
        elif kind == "int":
            cols.append(to_int(item).alias(name))
        else:
            cols.append(item.alias(name))
    if rate_value:
        cols.append(to_double(F.get(arr, 3)).alias("rate_value"))
    return df.select(*cols)


def parse_lines(
    df: DataFrame,
    col: str = "csv_line",
    keep: tuple[str, ...] = ("kafka_timestamp",),
    complete: bool = False,
    rate_numeric: bool = True,
    **kw,
) -> DataFrame:
    """split + width filter (+ optional completeness filter) + typed projection."""
    rows = valid_width(split_line(df, col))
    if not complete:
        return parse_traffic(rows, keep=keep, **kw)
    if kw.get("wide_counts"):  # whether a count is an int is known from its text alone
        return parse_traffic(rows.filter(complete_values("values", rate_numeric)), keep=keep, **kw)
    parsed = parse_traffic(rows, keep=keep, **{**kw, "rate_value": True})
    # all fields stand behind one generator, so the filter reads the parsed values (a loop over the texts is interpreted)
    fields = [c for c in parsed.columns if c not in keep]
    row = F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in fields])))
    parsed = parsed.select(*[F.col(f"`{c}`") for c in parsed.columns if c in keep], row)
    feats = [name for name, kind in TRAFFIC_FIELDS if kind != "string"] + ["rate_value" if rate_numeric else "Rate"]
    whole = complete_rows(parsed, feats)
    return whole if kw.get("rate_value", True) else whole.drop("rate_value")


def complete_values(values: str = "values", rate_numeric: bool = True) -> Column:
    """True when every feature field of a split line parses: doubles not NULL
    or NaN, ints not NULL, ``Rate`` a number (or, with ``rate_numeric=False``
    for the categorical-rate model, merely present). The label is not a
    feature.

    One expression over the whole array, so a pushed-down filter holds a
    single copy of the line expression rather than one per field.
    """
    rate_kind = "double" if rate_numeric else "string"
    kinds = F.array(
        *[
            F.lit("skip" if name == LABEL_COLUMN else (rate_kind if name == "Rate" else kind))
            for name, kind in TRAFFIC_FIELDS
        ]
    )

    def ok(z):
        v, k = z["v"], z["k"]
        d = v.try_cast("double")
        return (
            F.when(k == "double", d.isNotNull() & ~F.isnan(d))
            .when(k == "int", d.try_cast("int").isNotNull())
            .when(k == "string", v.isNotNull())
            .otherwise(F.lit(True))
        )

    zipped = F.arrays_zip(F.col(values).alias("v"), kinds.alias("k"))
    return F.forall(zipped, ok)


def string_features(df: DataFrame, label: str = LABEL_COLUMN, exclude: tuple[str, ...] = ("kafka_timestamp",)) -> list[str]:
    """String columns other than the label (and excluded ones)."""
    return [c for c, t in df.dtypes if t == "string" and c != label and c not in exclude]


def feature_columns(
    df: DataFrame,
    label: str = LABEL_COLUMN,
    exclude: tuple[str, ...] = ("kafka_timestamp",),
    indexed_suffix: str = "_indexed",
) -> list[str]:
    """Feature list: string columns replaced by their indexed column, label and
    excluded columns dropped, each feature once (no duplicates)."""
    strings = set(string_features(df, label, exclude))
    out: list[str] = []
    for c in df.columns:
        if c == label or c in exclude or c.endswith(indexed_suffix):
            continue
        name = f"{c}{indexed_suffix}" if c in strings else c
        if name not in out:
            out.append(name)
    return out


def complete_rows(df: DataFrame, features: list[str]) -> DataFrame:
    """Drop rows with a NULL or NaN in any feature (infinities are kept),
    the rows a skipping vector assembler drops."""
    cond = None
    for c in features:
        ok = F.col(c).isNotNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(F.col(c))
        cond = ok if cond is None else (cond & ok)
    return df.filter(cond) if cond is not None else df


def require_column(df: DataFrame, name: str) -> None:
    if name not in df.columns:
        raise ValueError(f"column {name!r} not found; available: {df.columns}")


def prediction_struct(df: DataFrame, prediction_time: Column | None = None, extra: tuple[str, ...] = ()) -> Column:
    """The 7-field prediction envelope as a struct column, and the columns ``extra`` of ``df`` behind them."""
    now = F.current_timestamp() if prediction_time is None else prediction_time
    return F.struct(
        F.col("kafka_timestamp").alias("original_timestamp"),
        F.col(LABEL_COLUMN).alias("actual_label"),
        F.col("prediction").alias("predicted_label"),
        F.col("Rate").alias("rate"),
        F.col("Header_Length").alias("header_length"),
        F.col("Protocol Type").alias("protocol_type"),
        now.alias("prediction_timestamp"),
        *extra,
    )


def encode_predictions(
    df: DataFrame, prediction_time: Column | None = None, keep: tuple[str, ...] = (), extra: tuple[str, ...] = ()
) -> DataFrame:
    """Scored traffic rows to the JSON ``value`` published per prediction.
    NULL fields are omitted from the JSON. ``extra`` columns become further fields (``ORIGIN_FIELDS``, ``model_version``)."""
    return df.select(*keep, F.to_json(prediction_struct(df, prediction_time, extra), JSON_OPTIONS).alias("value"))


def one_object(text: Column) -> Column:
    """Whether a text whose first JSON value is a valid object holds nothing else: strings are emptied, then
    the innermost objects become ``0``, once for each opening brace, and only ``0`` may be left."""
    bare = F.regexp_replace(F.btrim(text, F.lit(" \t\n\r")), r'"(?:[^"\\]|\\.)*"', "")
    depth = F.length(bare) - F.length(F.replace(bare, F.lit("{"), F.lit("")))
    inner = r"\{[^{}]*\}"
    nested = F.aggregate(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), bare, lambda t, _: F.regexp_replace(t, inner, "0"))
    return F.when(depth == 1, F.regexp_replace(bare, inner, "0")).otherwise(nested) == "0"


def read_predictions(df: DataFrame, value: str = "value", schema: T.StructType = PREDICTION_SCHEMA) -> DataFrame:
    """Parse prediction JSON; what is not one JSON object (empty and blank lines, NULL, ``null``, single quotes,
    a second object or other text behind the first included) is dropped.

    Fields are read as text and cast leniently, so a field of another JSON type
    (``"10"`` for a label, ``"x"`` for a length) gives its value or NULL and the message stays.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    full = T.StructType(texts.fields + [T.StructField("_bad", T.StringType(), True)])
    opts = {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    others = [c for c in df.columns if c != value]
    text = F.col(value).cast("string")
    parsed = df.select(*others, text.alias("_text"), F.from_json(text, full, opts).alias("_p"))
    is_object = F.btrim("_text", F.lit(" \t\n\r")).startswith("{") & F.col("_p").isNotNull() & F.col("_p._bad").isNull() & one_object(F.col("_text"))

    def typed(f: T.StructField) -> Column:
        c = F.col(f"_p.`{f.name}`")
        if isinstance(f.dataType, T.IntegerType):
            return to_int(c)
        if isinstance(f.dataType, T.LongType):
            return c.try_cast("decimal(38,0)").try_cast("bigint")
        return c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)

    return parsed.filter(is_object).select(*others, *[typed(f).alias(f.name) for f in schema.fields])


def predictions_ntz_schema() -> T.StructType:
    """Prediction schema with wall-clock (time-zone free) timestamps."""
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType, True)
            for f in PREDICTION_SCHEMA.fields
        ]
    )
