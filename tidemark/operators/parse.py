"""Decode topic messages into typed event bodies, with a reason for every message that cannot be decoded.

Messages take one of two ways to the same result. A message that one pattern knows as a flat JSON object with
values of the right types is read by the few plain fields of its event type, and if it is complete it is taken as
read. Any other message is read field by field as VARIANT, which finds out what exactly is missing or wrong; on the
first way those expressions see null and cost nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import json_text as J

_ZERO = {"string": "''", "int": "0L", "double": "0D", "time": f"timestamp'{S.ZERO_TIME}'"}
_PLAIN_TYPES = {
    "string": "STRING",
    "int": "BIGINT",
    "double": "DOUBLE",
    "time": "STRING",
    "items": "ARRAY<STRUCT<sku: STRING, quantity: BIGINT, price: DOUBLE>>",
}
_ITEM_VARIANTS = "array<struct<sku variant, quantity variant, price variant>>"


def wire_fields() -> list[str]:
    """Every JSON field name an event may carry, once each."""
    specs = [S.ENVELOPE_FIELDS, *S.BODY_FIELDS.values(), S.ITEM_FIELDS]
    return list(dict.fromkeys(name for spec in specs for name, _, _ in spec))


def _or_zero(expr: str, kind: str) -> str:
    return f"coalesce({expr}, {_ZERO[kind]})"


def _named_struct(pairs) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {expr}" for name, expr in pairs) + ")"


def _wrong_names(checks) -> str:
    """Comma-separated names of the fields that fail their check; empty when all pass."""
    return "concat_ws(', ', " + ", ".join(f"if({check}, '{name}', NULL)" for name, check in checks) + ")"


def _plain_item() -> str:
    return _named_struct((col, _or_zero(J.decode(f"i.{name}", kind), kind)) for name, col, kind in S.ITEM_FIELDS)


def _wrong_item() -> str:
    return " OR ".join(J.is_wrong(f"i.{name}", J.decode(f"i.{name}", kind)) for name, _, kind in S.ITEM_FIELDS)


def _items() -> dict[str, str]:
    """Helper columns for the nested item array of an order message.

    A repeated key inside an item has no VARIANT form and leaves the field empty; the typed reading of
    the text then takes the last value, as it does for repeated keys elsewhere.
    """
    repeated = """_fields.items IS NULL AND _text RLIKE r'"items"\\s*:'"""
    return {
        "_items": f"if({repeated}, from_json(_text, 'items {_ITEM_VARIANTS}').items, "
        f"try_variant_get(_fields.items, '$', '{_ITEM_VARIANTS}'))",
        "_elements": "try_variant_get(_fields.items, '$', 'array<variant>')",
    }


def _items_wrong() -> str:
    not_array = J.is_wrong("_fields.items", "_items")
    not_object = "exists(_elements, e -> NOT schema_of_variant(e) RLIKE '^(OBJECT|VOID)')"
    return f"{not_array} OR coalesce({not_object}, false) OR coalesce(exists(_items, i -> {_wrong_item()}), false)"


def _body(event_type: str) -> tuple[str, str]:
    """The decoded struct of one event type and the names of its wrong fields, read as VARIANT."""
    values, checks = [], []
    for name, col, kind in S.BODY_FIELDS[event_type]:
        if kind == "items":
            values.append((col, f"transform(coalesce(_items, array()), i -> {_plain_item()})"))
            checks.append((name, _items_wrong()))
        else:
            decoded = J.decode(f"_fields.{name}", kind)
            values.append((col, _or_zero(decoded, kind)))
            checks.append((name, J.is_wrong(f"_fields.{name}", decoded)))
    return _named_struct(values), _wrong_names(checks)


def _specs() -> list[tuple[str, str, str]]:
    return [field for spec in (S.ENVELOPE_FIELDS, *S.BODY_FIELDS.values()) for field in spec]


def _quick_names() -> dict[str, str]:
    """Per event type the column that holds its quick reading."""
    return {event_type: f"_quick_{column}" for event_type, column in S.BODY_COLUMNS.items()}


def _quick_read(event_type: str) -> str:
    """The envelope and body fields of one event type, read as plain types from messages of that type."""
    fields = {name: _PLAIN_TYPES[kind] for name, _, kind in (*S.ENVELOPE_FIELDS, *S.BODY_FIELDS[event_type])}
    return J.plain_parse(f"if(_kind = '{event_type}', value, NULL)", fields)


def _quick_body(event_type: str) -> str:
    """The struct of one event type straight from the quick reading."""
    quick = _quick_names()[event_type]
    return _named_struct(
        (col, f"_q_{name}" if kind == "time" else f"{quick}.{name}") for name, col, kind in S.BODY_FIELDS[event_type]
    )


def _quick_complete(event_type: str) -> str:
    """True when the quick reading has every field of the type."""
    quick, tests = _quick_names()[event_type], []
    for name, _, kind in S.BODY_FIELDS[event_type]:
        tests.append(f"_q_{name} IS NOT NULL" if kind == "time" else f"{quick}.{name} IS NOT NULL")
        if kind == "double":
            tests.append(f"abs({quick}.{name}) < double('Infinity')")
        if kind == "items":
            item = " OR ".join(f"i.{n} IS NULL" for n, _, _ in S.ITEM_FIELDS)
            tests.append(f"NOT exists({quick}.items, i -> {item} OR abs(i.price) = double('Infinity'))")
    return " AND ".join(tests)


def _quick_envelope(name: str) -> str:
    """An envelope field of the quick reading, whatever the event type."""
    return "coalesce(" + ", ".join(f"{quick}.{name}" for quick in _quick_names().values()) + ")"


def _plain_message() -> str:
    """Pattern of the messages that the quick reading may take: the type captured, every value of its field's JSON type."""
    item = J.plain_object({name: J.PLAIN_FORMS[kind] for name, _, kind in S.ITEM_FIELDS if kind in J.PLAIN_FORMS})
    forms = {**J.PLAIN_FORMS, "items": J.plain_array(item)}
    special = {name: forms[kind] for name, _, kind in _specs() if kind in forms}
    special["eventType"] = '"(' + "|".join(S.EVENT_TYPES) + ')"'
    return J.whole(J.plain_object(special))


def _careful_row() -> str:
    """The outcome of a message read field by field. Every step is evaluated once, and only for messages that need it."""
    names = wire_fields()
    envelope = {name: J.decode(f"_fields.{name}", kind) for name, _, kind in S.ENVELOPE_FIELDS}
    steps = {
        "_digest": "sha2(value, 256)",
        "_text": J.fold_keys("value", names),
        "_parsed": J.framed_parse("_text", "_digest", dict.fromkeys(names, "VARIANT")),
        "_valid": J.framed_is_intact("_parsed", "_digest", as_variant=True),
        "_fields": "if(_valid, map_values(_parsed)[0], NULL)",
        "_id": _or_zero(envelope["eventId"], "string"),
        "_type": _or_zero(envelope["eventType"], "string"),
        "_wrong": _wrong_names((name, J.is_wrong(f"_fields.{name}", envelope[name])) for name, _, _ in S.ENVELOPE_FIELDS),
        "_readable": "_valid AND _wrong = ''",
        **{k: f"if(_type = '{S.ORDER_PLACED}', {v}, NULL)" for k, v in _items().items()},
    }
    known = "_type IN (" + ", ".join(f"'{t}'" for t in S.EVENT_TYPES) + ")"
    bodies, wrong_bodies = {}, {}
    for event_type, column in S.BODY_COLUMNS.items():
        body, wrong = _body(event_type)
        bodies[column] = f"if(_readable AND _type = '{event_type}', {body}, NULL)"
        wrong_bodies[event_type] = wrong
    cases = " ".join(f"WHEN '{t}' THEN {wrong}" for t, wrong in wrong_bodies.items())
    steps["_wrong_body"] = f"if(_readable, CASE _type {cases} ELSE '' END, '')"

    # The beginnings of the errors.
    row = {
        "event_id": "_id",
        "event_type": "_type",
        "event_time": envelope["timestamp"],
        "error": f"""CASE
            WHEN NOT _valid THEN 'Failed to parse base event: not a single JSON object'
            WHEN _wrong <> '' THEN concat('Failed to parse base event: cannot decode ', _wrong)
            WHEN NOT {known} THEN concat('unknown event type: ', _type)
            WHEN _wrong_body <> ''
                THEN concat('failed to unmarshal ', _type, ' event: cannot decode ', _wrong_body) END""",
        "error_class": f"""CASE WHEN NOT _readable THEN 'parse'
            WHEN NOT {known} THEN 'unknown_type' WHEN _wrong_body <> '' THEN 'decode' END""",
        "counted": "_readable",
        **bodies,
    }
    found = _named_struct(row.items())
    for name, step in reversed(steps.items()):
        found = f"transform(array({step}), {name} -> {found})[0]"
    return found


def parse_events(log: DataFrame) -> DataFrame:
    """Add envelope, typed bodies and decode errors to a topic log with a ``value`` column.

    Adds ``event_id, event_type, event_time, user_body, order_body, payment_body, stock_body, error,
    error_class, counted``. Exactly one body is set on rows without error. ``counted`` is false for
    messages whose envelope cannot be read; those are dead letters but no processed events.
    """
    quick = _quick_names()
    times = [(name, f"{quick[t]}.{name}") for t, fields in S.BODY_FIELDS.items() for name, _, kind in fields if kind == "time"]
    complete = " ".join(f"WHEN '{t}' THEN {_quick_complete(t)}" for t in S.EVENT_TYPES)
    steps = [
        {"value": "coalesce(string(value), '')"},
        {"_kind": f"regexp_extract(value, r'{_plain_message()}', 1)"},
        {column: _quick_read(t) for t, column in quick.items()},
        {f"_q_{name}": J.plain_time(text) for name, text in [("timestamp", _quick_envelope("timestamp")), *times]},
        {
            "_plain": f"""coalesce({_quick_envelope('eventId')} IS NOT NULL AND _q_timestamp IS NOT NULL
                AND CASE _kind {complete} ELSE false END, false)"""
        },
    ]
    bodies = {column: f"if(_kind = '{t}', {_quick_body(t)}, NULL)" for t, column in S.BODY_COLUMNS.items()}
    quick_row = {
        "event_id": _quick_envelope("eventId"),
        "event_type": "_kind",
        "event_time": "_q_timestamp",
        "error": "string(NULL)",
        "error_class": "string(NULL)",
        "counted": "true",
        **bodies,
    }
    steps.append({"_read": f"if(_plain, {_named_struct(quick_row.items())}, NULL)"})
    outcome = f"if(_plain, _read, {_careful_row()})"
    decoded = log
    for step in steps:
        decoded = decoded.withColumns({name: F.expr(sql) for name, sql in step.items()})
    # One generated row per message: later filters on the outcome stay above the parse instead of
    # being rewritten into a second parse below it.
    return decoded.select(*log.columns, F.expr(f"inline(array({outcome}))"))


def with_lane(parsed: DataFrame) -> DataFrame:
    """Add ``lane``: the event type of decodable events, ``rejected`` for the rest.

    In a columnar copy each lane then reads its own body columns; those of other lanes are all null.
    """
    return parsed.withColumn("lane", F.when(F.col("error").isNull(), F.col("event_type")).otherwise(F.lit("rejected")))


#: Columns of the message itself that stay with a routed event, for the dead-letter table.
MESSAGE_COLUMNS = ("seq", "partition", "offset", "event_id", "value")


def judged_columns(parsed: DataFrame) -> DataFrame:
    """What settling reads of parsed messages; key, topic and times of the message itself need no copy."""
    outcome = ["event_type", *S.BODY_COLUMNS.values(), "error", "error_class", "counted", "lane"]
    return parsed.select(*[c for c in (*MESSAGE_COLUMNS, *outcome) if c in parsed.columns])


def route(parsed: DataFrame, event_type: str) -> DataFrame:
    """Decodable events of one type: the message's own columns and the body fields, flattened."""
    body = S.BODY_COLUMNS[event_type]
    carried = [c for c in MESSAGE_COLUMNS if c in parsed.columns]
    if "lane" in parsed.columns:
        mine = F.col("lane") == event_type
    else:
        mine = (F.col("event_type") == event_type) & F.col("error").isNull()
    return parsed.filter(mine).select(*carried, f"{body}.*")


def unroutable(parsed: DataFrame) -> DataFrame:
    """Messages that reached no handler, with their reason."""
    return parsed.filter(F.col("lane") == "rejected" if "lane" in parsed.columns else F.col("error").isNotNull())
