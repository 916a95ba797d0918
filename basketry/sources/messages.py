"""Messages to typed rows: strict, safe with a dead-letter side, and change-data parsing.

Scalars are read from JSON as text and cast afterwards, so ``"5.5"`` is a fine double and ``"abc"``
is not. Unknown fields are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rows import with_computed
from ..schemas import CDC_ORDER, CDC_PRODUCT, CONTRACTS

# --- fixed values -----------------------------------------------------------------------------
ERROR_MALFORMED = "Malformed record"
ERROR_MISSING = "Missing required fields: userId or orderId"
OP_SNAPSHOT = "r"
OP_ERROR = "error"
OP_LABELS = {"c": "create", "u": "update", "d": "delete"}
TRUE_TEXTS = ("true", "True", "TRUE")
FALSE_TEXTS = ("false", "False", "FALSE")
# ----------------------------------------------------------------------------------------------

_CORRUPT = "_corrupt"


def _as_text(t: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_as_text(t.elementType))
    return T.StringType()


def _value(text: Column, t: T.DataType) -> Column:
    """A scalar from its JSON text, null where it does not fit. Whole numbers may be written as fractions or with
    an exponent, and are then truncated; booleans have three spellings each, or are numbers."""
    text = F.nullif(F.trim(text), F.lit(""))
    if isinstance(t, T.IntegralType):
        return F.coalesce(text.try_cast(t), text.try_cast("double").try_cast(t))
    if isinstance(t, T.BooleanType):
        return F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False).otherwise(
            text.try_cast("bigint") != 0)
    return text.try_cast(t)


def _typed(raw: Column, t: T.DataType) -> Column:
    if isinstance(t, T.StructType):
        fields = F.struct(*[_typed(raw[f.name], f.dataType).alias(f.name) for f in t.fields])
        return F.when(raw.isNotNull(), fields)
    if isinstance(t, T.ArrayType):
        return F.transform(raw, lambda x: _typed(x, t.elementType))
    return raw if isinstance(t, T.StringType) else _value(raw, t)


def _miscast(raw: Column, t: T.DataType) -> Column:
    """True where a present value does not have the wanted type. A text field must not hold an object or a list:
    its value then is one in JSON again."""
    if isinstance(t, T.StructType):
        parts = [_miscast(raw[f.name], f.dataType) for f in t.fields]
        return reduce(lambda a, b: a | b, parts)
    if isinstance(t, T.ArrayType):
        return F.coalesce(F.exists(raw, lambda x: _miscast(x, t.elementType)), F.lit(False))
    if isinstance(t, T.StringType):
        return F.coalesce(raw.rlike(r"^\s*[\[{]") & F.try_parse_json(raw).isNotNull(), F.lit(False))
    text = F.nullif(F.trim(raw), F.lit(""))
    return text.isNotNull() & _value(raw, t).isNull()


def _never_closed(text: Column) -> Column:
    """An object without any closing brace, which no parser can read: a message that was cut off. Told so, it does not cost
    the parser's exception, many times the time of a sound message. All other text is the parser's to judge."""
    return text.startswith("{") & ~text.contains("}")


def parse_safe(messages: DataFrame, schema: T.StructType, required: list[str]) -> DataFrame:
    """Add ``row`` (typed struct) and ``error`` (null for good rows) to messages in column ``value``,
    ready to be split into accepted rows and dead letters."""
    wire = T.StructType(_as_text(schema).fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.when(~F.coalesce(_never_closed(F.col("value")), F.lit(False)), F.from_json(
        "value", wire, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    raw = F.col("raw")
    malformed = raw.isNull() | raw[_CORRUPT].isNotNull() | _miscast(raw, schema)
    missing = reduce(lambda a, b: a | b, [raw[name].isNull() for name in required], F.lit(False))
    error = F.when(F.coalesce(malformed, F.lit(True)), ERROR_MALFORMED).when(missing, ERROR_MISSING)
    judged = with_computed(with_computed(messages, "raw", parsed), "error", error)
    return judged.select(*messages.columns, _typed(raw, schema).alias("row"), "error")


def parse_strict(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed rows; a malformed message fails the query."""
    message = F.concat(F.col("error"), F.lit(": "), F.coalesce("value", F.lit("null")))
    sound = F.when(F.col("error").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)
    return parse_safe(messages, schema, []).filter(sound).select("row.*")


def parse_events(messages: DataFrame, name: str) -> DataFrame:
    """``parse_safe`` for the events of a named schema, with its required fields."""
    if name not in CONTRACTS:
        raise ValueError(f"unknown schema {name!r}; choose one of {', '.join(CONTRACTS)}")
    contract = CONTRACTS[name]
    return parse_safe(messages, contract.schema, contract.required)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).select("row.*")


def rejected(parsed: DataFrame, at: Column | None = None) -> DataFrame:
    """Dead letters: time, error and the whole original message, unchanged."""
    return parsed.filter(F.col("error").isNotNull()).select(
        (F.current_timestamp() if at is None else at).alias("timestamp"),
        F.regexp_replace("error", '"', "'").alias("error"),
        F.col("value").alias("original"),
    )


def envelope(dead_letters: DataFrame) -> DataFrame:
    """Dead letters as JSON messages. The original is a JSON string, so the envelope always parses."""
    return dead_letters.select(
        F.to_json(F.struct("timestamp", "error", "original"), {"ignoreNullFields": "false"}).alias("value")
    )


# --- change data ------------------------------------------------------------------------------


def read_envelopes(changes: DataFrame, row: T.StructType) -> DataFrame:
    """Add the change envelope ``c`` (before, after, op, source) and ``error``, null where it can be read; tombstones
    (null messages) are dropped."""
    schema = T.StructType([
        T.StructField("before", row),
        T.StructField("after", row),
        T.StructField("op", T.StringType()),
        T.StructField("source", T.StructType([
            T.StructField("table", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ])),
        T.StructField(_CORRUPT, T.StringType()),
    ])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    present = with_computed(changes.filter(F.col("value").isNotNull()), "c", parsed)
    broken = F.col("c").isNull() | F.col(f"c.{_CORRUPT}").isNotNull() | F.col("c.op").isNull()
    return present.withColumn("error", F.when(broken, ERROR_MALFORMED))


def unwrap(changes: DataFrame, row: T.StructType) -> DataFrame:
    """Flatten change envelopes. Deletes keep their last image and are flagged; unreadable envelopes are left to
    ``rejected(read_envelopes(...))``."""
    image = F.coalesce("c.after", "c.before")
    return read_envelopes(changes, row).filter(F.col("error").isNull()).select(
        *[image[f.name].alias(f.name) for f in row.fields],
        F.col("c.op").alias("__op"),
        F.col("c.source.table").alias("__table"),
        F.col("c.source.ts_ms").alias("__source_ts_ms"),
        (F.col("c.op") == "d").alias("__deleted"),
    )


def _tolerant(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Change rows that never fail: a missing or unreadable field gets its type's empty value, a
    missing operation counts as snapshot, and an unreadable message becomes an ``error`` row."""
    names = {f.name: "__op" if f.name == "operation" else f.name for f in schema.fields}
    wire = T.StructType([T.StructField(n, T.StringType()) for n in (*names.values(), _CORRUPT)])
    parsed = F.from_json("value", wire, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    raw = F.col("raw")
    broken = raw.isNull() | raw[_CORRUPT].isNotNull()

    def field(f: T.StructField) -> Column:
        text = F.when(~broken, raw[names[f.name]])
        if f.name == "operation":
            value = F.when(broken, OP_ERROR).otherwise(F.coalesce(text, F.lit(OP_SNAPSHOT)))
        elif isinstance(f.dataType, T.StringType):
            value = F.coalesce(text, F.lit(""))
        else:
            number = text.try_cast("double").try_cast(f.dataType)
            value = F.coalesce(number, F.lit(0).cast(f.dataType))
        return value.alias(f.name)

    return with_computed(messages, "raw", parsed).select(*[field(f) for f in schema.fields])


def parse_product_changes(messages: DataFrame) -> DataFrame:
    return _tolerant(messages, CDC_PRODUCT)


def parse_order_changes(messages: DataFrame) -> DataFrame:
    return _tolerant(messages, CDC_ORDER)


def op_label(operation: Column) -> Column:
    label = F.lit("other")
    for code, name in OP_LABELS.items():
        label = F.when(operation == code, name).otherwise(label)
    return label


def flatten_json(flat: DataFrame) -> DataFrame:
    """Unwrapped change rows as the flat messages a change topic carries."""
    return with_computed(flat, "value", F.to_json(F.struct("*"))).select("value")
