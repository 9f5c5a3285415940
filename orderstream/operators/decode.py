"""Decode order messages: bytes -> text -> typed columns (DEC-1..13).

One JSON parse per message (``from_json`` with a corrupt-record column). Further
parses run only for rare records: ``json_object_keys`` where the first parse
complained (a broken document or a broken field?) or a filled number is NULL
(absent or an explicit null?), and a check of the whole text where it is not
plainly one flat object. A message is one document: text before or after it, a
second object or single-quoted strings make it malformed (several orders per
message are read with ``split_rows``). Everything stays in JVM expressions.

Modes, one per behaviour found among the reference's pipelines:

``drop_malformed``
    A record that is not a JSON object, or has a field that does not convert,
    is dropped; the stream goes on. Absent fields are NULL (or filled).
``null_fields``
    A record that is not a JSON object is dropped; a field that does not
    convert becomes NULL and the record survives.
``permissive``
    Nothing is dropped: an undecodable message becomes an all-NULL row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codec import ISO_MICROS
from ..functions.time import to_millis
from ..schemas import RAW_ORDER

MODES = ("drop_malformed", "null_fields", "permissive")
TS_FORMATS = ("iso", "micros")

NULL_NUMBERS = ("drop", "fill")

_PLAIN_NUMBER = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
_TEXT = "_text"
_DOC = "_doc"
_ALONE = "_alone"
_CORRUPT = "_corrupt"
DOC_OK = "_doc_ok"
FIELD_FAILED = "_field_failed"

_NUMERIC = (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType, T.DoubleType, T.FloatType)


def decode_utf8(df: DataFrame, value: str = "value") -> DataFrame:
    """UTF-8 message bytes to a string column of the same name."""
    return df.withColumn(value, F.col(value).cast("string"))


def split_rows(df: DataFrame, value: str = "value", sep: str = "\n", position: str = "line") -> DataFrame:
    """Several newline-delimited JSON rows in one message -> one row each.

    Blank lines are skipped; ``position`` numbers the rows within their
    message so arrival order stays total. A NULL message gives no row.
    """
    text = F.col(value).cast("string")
    # ``split`` takes a pattern; quote the separator so it is matched literally.
    lines = F.filter(F.split(text, "\\Q" + sep + "\\E"), lambda x: x.rlike(r"\S"))
    keep = [c for c in df.columns if c != value]
    return df.select(*keep, F.posexplode(lines).alias(position, value))


def _parse_schema(schema: T.StructType, coerce_numbers: bool) -> T.StructType:
    fields = []
    for f in schema.fields:
        if coerce_numbers and isinstance(f.dataType, _NUMERIC):
            fields.append(T.StructField(f.name, T.StringType()))
        else:
            fields.append(f)
    fields.append(T.StructField(_CORRUPT, T.StringType()))
    return T.StructType(fields)


def _coerce(text: Column, target: T.DataType) -> Column:
    """A number given as a JSON number or string. A string must be a whole
    integer for an integer field (``"3"`` -> 3, ``"2.7"`` and ``"3d"`` -> NULL);
    a number loses its fraction, as an integer conversion does. The parser hands
    both over as text; ``annotate`` tells them apart where there is a fraction."""
    if isinstance(target, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        # decimal(38,6), not double: no digit of a bigint is lost.
        return F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("decimal(38,6)").try_cast(target))
    return F.when(text.rlike(_PLAIN_NUMBER), text.try_cast(target))


def _quoted(doc: Column, name: str) -> Column:
    """Whether the field's value is a JSON string. Looked at only for text with
    a fraction, so the pattern rarely runs."""
    return doc.rlike('"' + name + r'"\s*:\s*"')


def is_one_document(text: Column) -> Column:
    """Whether the text is one JSON object and nothing else. Most messages are
    one flat object, which a pattern tells; only for others the text is parsed as
    the first of two elements of an array, so that anything beside it shows."""
    flat = text.rlike(r"^\s*\{[^{}']*\}\s*$")
    end = "end of the message"
    probe = F.from_json(
        F.concat(F.lit("["), text, F.lit(f',"{end}"]')), T.ArrayType(T.StringType()), {"allowSingleQuotes": "false"}
    )
    alone = (F.size(probe) == 2) & (F.get(probe, 1) == end) & text.rlike(r"^\s*\{")
    return F.coalesce(F.when(flat, F.lit(True)).otherwise(alone), F.lit(False))


def annotate(
    df: DataFrame,
    *,
    schema: T.StructType = RAW_ORDER,
    value: str = "value",
    keep: Sequence[str] = (),
    fill_missing: Mapping[str, object] | None = None,
    coerce_numbers: bool = False,
    ts_format: str = "iso",
    ts_precision: str = "us",
    null_numbers: str = "drop",
) -> DataFrame:
    """Decode without dropping: typed fields plus ``_doc_ok`` (one JSON object)
    and ``_field_failed`` (some present field did not convert).

    ``fill_missing`` gives absent fields a value. An explicit null in such a
    field fails to convert (``null_numbers="drop"``) or is filled like an absent
    one (``"fill"``)."""
    if ts_format not in TS_FORMATS:
        raise ValueError(f"ts_format must be one of {TS_FORMATS}")
    if null_numbers not in NULL_NUMBERS:
        raise ValueError(f"null_numbers must be one of {NULL_NUMBERS}")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}
    if ts_format == "micros":
        options["timestampNTZFormat"] = ISO_MICROS
        options["timestampFormat"] = ISO_MICROS
    text = F.col(value).cast("string")
    doc = F.from_json(F.col(_TEXT), _parse_schema(schema, coerce_numbers), options)
    # The parse and the whole-text check sit behind a one-element explode:
    # predicate pushdown cannot move the mode's filter below a generator, so
    # Catalyst does not inline (and repeat) them inside the filter.
    parsed = df.select(
        *[F.col(c) for c in keep],
        text.alias(_TEXT),
    ).select(
        *[F.col(c) for c in keep],
        F.col(_TEXT),
        F.explode(F.array(F.struct(doc.alias("fields"), is_one_document(F.col(_TEXT)).alias("alone")))).alias(_DOC),
    ).withColumn(_ALONE, F.col(_DOC)["alone"]).withColumn(_DOC, F.col(_DOC)["fields"])
    corrupt = F.col(f"{_DOC}.{_CORRUPT}")
    # Second parse only where the first one complained.
    doc_ok = (
        F.col(_DOC).isNotNull()
        & (corrupt.isNull() | F.json_object_keys(F.col(_TEXT)).isNotNull())
        & F.col(_ALONE)
    )
    failed = corrupt.isNotNull()
    fill = dict(fill_missing or {})
    out = []
    for f in schema.fields:
        raw = F.col(f"{_DOC}.{f.name}")
        if coerce_numbers and isinstance(f.dataType, _NUMERIC):
            typed = _coerce(raw, f.dataType)
            if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
                fraction = raw.rlike("[.eE]")
                typed = F.when(fraction & _quoted(F.col(_TEXT), f.name), F.lit(None).cast(f.dataType)).otherwise(typed)
            failed = failed | (raw.isNotNull() & typed.isNull())
            absent = raw.isNull()
        else:
            typed = raw
            # In typed decoding a failed field is indistinguishable from an
            # absent one; fill only records that decoded cleanly.
            absent = raw.isNull() & corrupt.isNull()
        if f.name in fill:
            if null_numbers == "drop":
                named = F.coalesce(F.array_contains(F.json_object_keys(F.col(_TEXT)), f.name), F.lit(False))
                failed = failed | F.when(F.col(_DOC).isNotNull() & absent, named).otherwise(F.lit(False))
                absent = absent & ~F.when(absent, named).otherwise(F.lit(False))
            typed = F.when(F.col(_DOC).isNotNull() & absent, F.lit(fill[f.name]).cast(f.dataType)).otherwise(typed)
        if f.name == "order_timestamp" and ts_precision == "ms":
            typed = to_millis(typed)
        out.append(typed.alias(f.name))
    return parsed.select(
        *[F.col(c) for c in keep],
        *out,
        doc_ok.alias(DOC_OK),
        (F.col(_DOC).isNotNull() & failed).alias(FIELD_FAILED),
    )


def decode_with(
    df: DataFrame,
    decoder: Callable[[Column], Column],
    *,
    value: str = "value",
    keep: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A pluggable decoder: ``decoder`` maps the message text column to a
    struct column (built from Spark expressions); a NULL result means "no
    record" and the message is dropped, as a deserializer returning null.
    Prefer expression-built decoders; a Python UDF here is the slow path."""
    doc = decoder(F.col(value).cast("string"))
    out = df.select(*[F.col(c) for c in keep], F.explode(F.array(doc)).alias(_DOC)).filter(F.col(_DOC).isNotNull())
    if columns is None:
        return out.select(*[F.col(c) for c in keep], f"{_DOC}.*")
    return out.select(*[F.col(c) for c in keep], *[F.col(f"{_DOC}.{c}").alias(c) for c in columns])


def decode_json(
    df: DataFrame,
    mode: str = "drop_malformed",
    *,
    schema: T.StructType = RAW_ORDER,
    value: str = "value",
    keep: Sequence[str] = (),
    fill_missing: Mapping[str, object] | None = None,
    coerce_numbers: bool = False,
    ts_format: str = "iso",
    ts_precision: str = "us",
    null_numbers: str = "drop",
) -> DataFrame:
    """Decode the JSON message in ``value`` into the columns of ``schema``
    (plus the ``keep`` pass-through columns), applying ``mode``'s policy."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    a = annotate(
        df,
        schema=schema,
        value=value,
        keep=keep,
        fill_missing=fill_missing,
        coerce_numbers=coerce_numbers,
        ts_format=ts_format,
        ts_precision=ts_precision,
        null_numbers=null_numbers,
    )
    return apply_mode(a, mode)


def accepted(mode: str) -> Column:
    """Whether ``mode`` keeps a row of an ``annotate`` result; never NULL."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "drop_malformed":
        return F.col(DOC_OK) & ~F.col(FIELD_FAILED)
    return F.col(DOC_OK) if mode == "null_fields" else F.lit(True)


def apply_mode(annotated: DataFrame, mode: str) -> DataFrame:
    """Keep the records ``mode`` accepts from an ``annotate`` result."""
    return annotated.filter(accepted(mode)).drop(DOC_OK, FIELD_FAILED)


def rejected_by_mode(annotated: DataFrame, mode: str, *, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The complement of ``apply_mode``: dropped messages with a reason."""
    reason = F.when(~F.col(DOC_OK), F.lit("malformed_document")).otherwise(F.lit("field_conversion"))
    return annotated.filter(~accepted(mode)).select(*keep, F.col(value).cast("string").alias("message"), reason.alias("reason"))


def malformed(df: DataFrame, mode: str = "drop_malformed", *, value: str = "value", keep: Sequence[str] = (), **kw) -> DataFrame:
    """The records ``decode_json(df, mode)`` drops, with the message text and
    a reason, for a dead-letter table (the reference printed and lost them)."""
    a = annotate(df, value=value, keep=(*keep, value), **kw)
    return rejected_by_mode(a, mode, value=value, keep=keep)
