"""Strict JSON decoding as native SQL expressions.

``from_json`` alone is more lenient than the wire contract: it ignores text after the object, reads
numbers into string fields and accepts quotes other than ``"``. :func:`framed_parse` closes those
gaps in a single pass. The message becomes the first entry of a map whose second entry carries the
message's own digest; the parse is accepted only if exactly these two entries come back, so anything
that ends the object early or adds to it shows. Read as VARIANT, fields keep the JSON type of each
value for the checks in :func:`decode`. Reading plain types is several times cheaper; :func:`plain_object` gives the
pattern of texts of which that reading hides nothing.

Functions take and return SQL expression text, so a whole message costs one parse call.
"""

from __future__ import annotations

from collections.abc import Iterable

# Fixed value: RFC 3339 date-time.
RFC3339 = (
    r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?"
    r"(Z|[+-]([01]\d|2[0-3]):[0-5]\d)$"
)

#: Field of the closing entry that holds the digest; any string field of the message type will do.
DIGEST_FIELD = "eventId"


def fold_keys(text: str, names: Iterable[str]) -> str:
    """Rewrite known keys that differ only in letter case; other messages pass through untouched."""
    names = list(names)
    exact = "|".join(names)
    listed = ", ".join(f"'{name}'" for name in names)
    # One fold over the names: written out, the replacements would make a method too long to compile.
    folded = rf"""aggregate(array({listed}), {text}, (t, n) ->
        regexp_replace(t, concat(r'(?<!\\)"(?i:', n, r')"(\s*:)'), concat('"', n, r'"$1')))"""
    return rf"""if({text} RLIKE r'(?<!\\)"(?!(?:{exact})")(?i:{exact})"\s*:', {folded}, {text})"""


def framed_parse(text: str, digest: str, fields: dict[str, str]) -> str:
    """Two-entry map of the message and the closing entry; ``fields`` gives the SQL type of each field.

    The digest travels as a value: JSON readers keep every distinct key they meet in a symbol table.
    """
    spec = ", ".join(f"{name} {sql_type}" for name, sql_type in fields.items())
    framed = f"""concat('{{"message":', {text}, ',"end":{{"{DIGEST_FIELD}":"', {digest}, '"}}}}')"""
    options = "map('mode', 'PERMISSIVE', 'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"
    return f"from_json({framed}, 'MAP<STRING, STRUCT<{spec}>>', {options})"


def framed_is_intact(parsed: str, digest: str, as_variant: bool = False) -> str:
    """True when the text inside the frame was one JSON object or null and nothing else."""
    found = f"map_values({parsed})[1].{DIGEST_FIELD}"
    if as_variant:
        found = f"try_variant_get({found}, '$', 'string')"
    return f"coalesce(map_keys({parsed}) = array('message', 'end') AND {found} = {digest}, false)"


def decode(value: str, kind: str) -> str:
    """Typed value of a VARIANT, null when absent or of another JSON type."""
    if kind == "string":
        return f"if(schema_of_variant({value}) = 'STRING', try_variant_get({value}, '$', 'string'), NULL)"
    if kind == "int":
        return f"if(schema_of_variant({value}) = 'BIGINT', try_variant_get({value}, '$', 'bigint'), NULL)"
    if kind == "double":
        number = f"try_variant_get({value}, '$', 'double')"
        return (
            f"if(schema_of_variant({value}) RLIKE '^(BIGINT|DECIMAL|DOUBLE)' "
            f"AND abs({number}) < double('Infinity'), {number}, NULL)"
        )
    if kind == "time":
        return time_value(decode(value, "string"))
    raise ValueError(f"unknown kind {kind!r}")


def is_wrong(value: str, decoded: str) -> str:
    """True when a field is present, not null, and of the wrong JSON type."""
    return f"coalesce(schema_of_variant({value}) <> 'VOID' AND {decoded} IS NULL, false)"


_SPACE = r"[ \t\n\r]*+"
_CHARS = r'[^"\\]*+'
_STRING = rf'"{_CHARS}(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{{4}}){_CHARS})*+"'
#: Patterns of the values that a typed reading takes as they are; integers of up to 18 digits fit 64 bits.
PLAIN_FORMS = {
    "int": r"-?+(?:0|[1-9][0-9]{0,17}+)",
    "double": r"-?+(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][-+]?+[0-9]++)?+",
    "time": '"' + RFC3339.strip("^$").replace("(", "(?:") + '"',
}


def _listed(opening: str, member: str, closing: str) -> str:
    """Members between brackets, with commas between them. Nothing is tried twice, so long texts need no deep stack."""
    return rf"{opening}{_SPACE}(?:{member}{_SPACE}(?:,{_SPACE}(?!{closing})|(?={closing})))*+{closing}"


def plain_object(special: dict[str, str]) -> str:
    """Pattern of an object whose values are strings, but for the keys in ``special``, whose values have their own pattern.

    Control characters in strings are left to the JSON reader, which refuses them.
    """
    # The opening quote is matched once, before the key is told.
    others = rf'(?!(?:{"|".join(special)})"){_CHARS}"{_SPACE}:{_SPACE}{_STRING}'
    members = [others, *(rf'{name}"{_SPACE}:{_SPACE}{value}' for name, value in special.items())]
    return _listed(r"\{", f'"(?:{"|".join(members)})', r"\}")


def plain_array(element: str) -> str:
    return _listed(r"\[", element, r"\]")


def whole(pattern: str) -> str:
    return rf"\A{_SPACE}{pattern}{_SPACE}\z"


def plain_parse(text: str, fields: dict[str, str]) -> str:
    """Struct of a message that is known to be one JSON object; ``fields`` gives the SQL type of each field."""
    return f"from_json({text}, '{', '.join(f'{name} {sql_type}' for name, sql_type in fields.items())}')"


def plain_time(text: str) -> str:
    """Timestamp of a text that is known to look like RFC 3339, null if there is no such time."""
    return f"try_to_timestamp({text})"


def time_value(text: str) -> str:
    """Timestamp of an RFC 3339 text, null for any other text."""
    return f"if({text} RLIKE r'{RFC3339}', {plain_time(text)}, NULL)"
