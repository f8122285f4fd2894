"""JSON message parsing with VARIANT columns: envelopes, nested or flat payloads, field aliases, coercion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.functions.lists import code_list

# One cast per object reads all keys that matter. VARIANT members keep "absent" (null) and "JSON null" apart, and the cast
# of anything but an object is null.
_MESSAGE = "struct<Type variant, Message variant, sensors variant, timestamp string, device_id string, version string>"
_SCORER_KEYS = [*K.FIELD_ALIASES, *K.FIELD_ALIASES.values()]


def _as(variant: Column, as_type: str) -> Column:
    return F.try_variant_get(variant, "$", as_type)


def _read_json(text: Column) -> Column:
    """Variant of a JSON text, null when unreadable. The bare numbers NaN and Infinity are read as well.

    Only a text that fails as plain JSON is looked at a second time.
    """
    quoted = F.regexp_replace(text, r"([:\[,]\s*)(-?Infinity|NaN)(?=\s*[,}\]])", '$1"$2"')
    return F.coalesce(F.try_parse_json(text), F.when(text.rlike("NaN|Infinity"), F.try_parse_json(quoted)))


def _is_text(variant: Column) -> Column:
    """The variant is a JSON string."""
    return F.coalesce(F.schema_of_variant(variant) == "STRING", F.lit(False))


def _hold(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once.

    Each parsing step refers to the previous one several times. As plain projections the optimizer would substitute them
    into filters, where the expression grows with every step; a generator of exactly one row keeps the steps apart.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def _members(names: Sequence[str], as_type: str) -> str:
    return "struct<" + ", ".join(f"{name} {as_type}" for name in names) + ">"


def _number(numbers: Column, texts: Column, name: str) -> Column:
    """Double from a number, numeric string or boolean; null when it cannot be read.

    The cast also reads the spellings ``1.5d`` and ``1.5f``, which are no numbers here; ``texts`` is null when the
    message holds nothing of that kind.
    """
    ending = F.lower(F.right(F.rtrim(texts[name]), F.lit(3)))
    suffixed = (ending.endswith("d") | ending.endswith("f")) & (ending != "inf")
    return F.when(~F.coalesce(suffixed, F.lit(False)), numbers[name])


def _suspect_texts(variant: Column, names: Sequence[str], body: Column) -> Column:
    """The members as texts, only where the message has a digit, a letter d or f, and a quote in a row."""
    return F.when(body.rlike(r'(?i)[0-9.][df]\s*\\?"'), _as(variant, _members(names, "string")))


def _open_envelope(df: DataFrame, body: str) -> DataFrame:
    """Adds envelope, _doc (variant) and _d (the keys of the document, null when it is no object)."""
    v, top = F.col("_v"), F.col("_top")
    read = _hold(df, _v=_read_json(F.col(body)))
    read = _hold(read, _top=_as(v, _MESSAGE))
    inner = top["Message"]
    notification = F.coalesce(_as(top["Type"], "string") == "Notification", F.lit(False)) & _is_text(top["Type"])
    opened = _read_json(F.when(inner.isNotNull() & _is_text(inner), _as(inner, "string")))
    text = F.ltrim(F.col(body)).startswith('"')
    read = _hold(
        read,
        _notification=notification,
        _opened=F.when(top.isNotNull(), opened).when(v.isNotNull() & text, _read_json(_as(v, "string"))),
    )
    opened = F.col("_opened")
    envelope = (
        F.when(v.isNull(), "unreadable")
        .when(F.col("_notification"), F.when(inner.isNull(), "plain").otherwise("notification"))
        .when(top.isNotNull(), F.when(opened.isNotNull(), "message").otherwise("plain"))
        .when(text, "text")
        .otherwise("plain")
    )
    read = _hold(read, envelope=envelope)
    plain = F.col("envelope") == "plain"
    read = _hold(
        read,
        _doc=F.when(plain, v).otherwise(opened),
        _d=F.when(plain, top).otherwise(_as(opened, _MESSAGE)),
    )
    return read.drop("_v", "_top", "_notification", "_opened")


def unwrap_envelope(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``doc`` (variant) and ``envelope``: one level of wrapping is removed, in a fixed order of forms.

    A notification must hold readable JSON text, or nothing at all; any other object with a text ``Message`` is opened
    when the text is JSON and kept when it is not; a JSON text is decoded again.
    """
    return _open_envelope(df, body).withColumnRenamed("_doc", "doc").drop("_d")


def parse_messages(df: DataFrame, body: str = "body") -> DataFrame:
    """One row per message with sensor doubles, metadata, ``missing`` (array) and ``invalid_reason`` (null = valid)."""
    doc, nested = F.col("_d"), F.col("_d.sensors")
    read = _hold(_open_envelope(df, body), _reading=F.coalesce(nested, F.col("_doc")))
    reading = F.col("_reading")
    read = _hold(
        read,
        _payload=_as(reading, _members(K.SENSOR_COLUMNS, "variant")),
        _numbers=_as(reading, _members(K.SENSOR_COLUMNS, "double")),
        _texts=_suspect_texts(reading, K.SENSOR_COLUMNS, F.col(body)),
    )
    payload = F.col("_payload")
    read = _hold(read, **{c: _number(F.col("_numbers"), F.col("_texts"), c) for c in K.SENSOR_COLUMNS})
    layout = F.when(nested.isNotNull(), "nested").otherwise("flat").alias("layout")
    absent = [F.when(payload[c].isNull() | F.is_variant_null(payload[c]), F.lit(c)) for c in K.SENSOR_COLUMNS]
    unread = F.lit(False)
    for c in K.SENSOR_COLUMNS:
        unread = unread | F.col(c).isNull()
    read = _hold(read, missing=code_list(*absent), _unread=unread)
    reason = (
        F.when(F.col("_doc").isNull(), "bad_json")
        .when(doc.isNull(), "not_object")
        .when(payload.isNull(), "bad_sensors")
        .when(F.size("missing") > 0, "missing_fields")
        .when(F.col("_unread"), "bad_number")
    )
    # a literal NaN is a valid number on the wire and a null afterwards
    numbers = [F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) for c in K.SENSOR_COLUMNS]
    about = [doc[c].alias(c) for c in ("timestamp", "device_id", "version")]
    return read.select(
        *df.columns, "envelope", layout, *about, "missing", *numbers, reason.alias("invalid_reason")
    )


def parse_aliases(df: DataFrame, body: str = "body") -> DataFrame:
    """Scorer input: full field name first, one-letter name second; key presence decides.

    ``status`` is 200, 400 (field missing, or a text that is no number, or a body that is no JSON) or 500 (a value that
    has no numeric reading at all: null, array, object; or a body that is a bare number, boolean or null).
    """
    event, raw, doc = F.col("_event"), F.col("_raw"), F.col("_doc")
    read = _hold(df, _event=_read_json(F.col(body)))
    read = _hold(read, _raw=F.coalesce(F.try_variant_get(event, "$.body", "variant"), event))
    read = _hold(read, _doc=F.when(_is_text(raw), _read_json(_as(raw, "string"))).otherwise(raw))
    read = _hold(
        read,
        _d=_as(doc, _members(_SCORER_KEYS, "variant")),
        _numbers=_as(doc, _members(_SCORER_KEYS, "double")),
        _texts=_suspect_texts(doc, _SCORER_KEYS, F.col(body)),
    )
    steps = {}
    for name, letter in K.FIELD_ALIASES.items():
        full, numbers, texts = F.col("_d")[name], F.col("_numbers"), F.col("_texts")
        steps[f"_{name}"] = F.coalesce(full, F.col("_d")[letter])
        steps[name] = F.when(full.isNotNull(), _number(numbers, texts, name)).otherwise(_number(numbers, texts, letter))
    read = _hold(read, **steps)
    # a text or a list contains no key, any other non-object cannot be searched at all
    searchable = _is_text(doc) | _as(doc, "array<variant>").isNotNull()
    status = F.when(doc.isNull(), 400).when(F.col("_d").isNull(), F.when(searchable, 400).otherwise(500))
    # fields are read in order, so the first bad one decides between 400 and 500
    for name in K.FIELD_ALIASES:
        variant = F.col(f"_{name}")
        bad_value = F.when(_is_text(variant), 400).otherwise(500)
        status = status.when(variant.isNull(), 400).when(F.col(name).isNull(), bad_value)
    return read.select(*df.columns, status.otherwise(200).alias("status"), *K.FIELD_ALIASES)
