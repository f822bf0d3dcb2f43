"""Reading message payloads: JSON validity, shape detection, link keys."""

from __future__ import annotations

from goldweft import schemas as S
from goldweft.functions.text import normalize_key, strip, text

_STRICT = "map('allowSingleQuotes', 'false')"

# Fixed value: JSON values that count as no payload at all (with '{}', tested apart).
_NOTHING = r"^(|null|false|\"\"|\\[\\s*\\]|-?0(\\.0+)?([eE][+-]?\\d+)?)$"


# Fixed value: texts that a number, a flag, a list or an object without content leaves in a map.
_FALSY = r"^(false|\\[\\s*\\]|\\{\\s*\\}|-?0(\\.0+)?([eE][+-]?\\d+)?)$"


def payload_map(data: str) -> str:
    """The object in ``data`` as a map of texts; null where ``data`` is no object.

    A map, not a struct: a key that is present with a null value must stay
    distinguishable from an absent key.  See :func:`last_wins` for repeated keys.
    """
    return f"from_json({data}, 'map<string,string>', {_STRICT})"


def last_wins(doc: str) -> str:
    """Keep the last of repeated keys, as JSON readers usually do; cheap where none repeats."""
    keys = f"map_keys({doc})"
    later = f"slice({keys}, i + 2, size({keys}))"
    return (
        f"CASE WHEN size(array_distinct({keys})) < size({keys}) THEN map_from_entries("
        f"filter(map_entries({doc}), (e, i) -> NOT array_contains({later}, e.key)))"
        f" ELSE {doc} END"
    )


def is_one_json_value(value: str) -> str:
    """True where the text is exactly one JSON value with nothing after it.

    The parser stops at the end of the first value, so the text is checked inside
    an array and inside an object: text that closes one of them early breaks the
    other.
    """
    in_array = f"from_json(concat('[', {value}, ']'), 'array<string>', {_STRICT})"
    in_object = f"""from_json(concat('{{"v":', {value}, '}}'), 'map<string,string>', {_STRICT})"""
    return f"coalesce(size({in_array}) = 1 AND size({in_object}) = 1, false)"


def is_empty_payload(doc: str, data: str) -> str:
    """Absent, null, or an empty/zero/false JSON value."""
    nothing = f"coalesce({strip(data)} RLIKE '{_NOTHING}', true)"
    return f"CASE WHEN {doc} IS NOT NULL THEN size({doc}) = 0 ELSE {nothing} END"


def detect_shape(doc: str) -> str:
    """Shape of a payload by the keys it carries; the first rule that holds wins."""

    # The keys that make up each shape, and the order of the rules.
    def has(*keys):
        return " AND ".join(f"map_contains_key({doc}, '{k}')" for k in keys)

    return f"""CASE
        WHEN {has("passport", "name", "last_name", "sex")} THEN '{S.PERSONAL}'
        WHEN {has("passport", "IBAN", "salary")} THEN '{S.BANK}'
        WHEN {has("fullname", "city", "address")} AND NOT {has("company")} THEN '{S.LOCATION}'
        WHEN {has("fullname", "company", "job")} THEN '{S.PROFESSIONAL}'
        WHEN {has("IPv4", "address")} AND NOT {has("fullname")} THEN '{S.NETWORK}'
        ELSE '{S.UNKNOWN}' END"""


def shape_of(doc: str, data: str) -> str:
    """:func:`detect_shape`, with ``empty`` and ``non_object`` for other payloads."""
    return (
        f"CASE WHEN {is_empty_payload(doc, data)} THEN '{S.EMPTY}'"
        f" WHEN {doc} IS NULL THEN '{S.NON_OBJECT}' ELSE {detect_shape(doc)} END"
    )


def _by_domain(shape: str, passport: str, fullname: str, address: str) -> str:
    """One of three SQL texts, by the field that links a shape; null for other shapes."""
    return f"""CASE
        WHEN {shape} IN ('{S.PERSONAL}', '{S.BANK}') THEN {passport}
        WHEN {shape} IN ('{S.LOCATION}', '{S.PROFESSIONAL}') THEN {fullname}
        WHEN {shape} = '{S.NETWORK}' THEN {address} END"""


def link_domain(shape: str) -> str:
    """Name of the field that links a message of the given shape."""
    return _by_domain(shape, "'passport'", "'fullname'", "'address'")


def link_value(doc: str, shape: str) -> str:
    """That field's raw value."""
    return _by_domain(shape, f"{doc}['passport']", f"{doc}['fullname']", f"{doc}['address']")


def is_json_text(data: str, domain: str) -> str:
    """True where the field named by ``domain`` is a JSON text (quoted), or cannot be told
    because the object repeats a key."""
    field = f"try_variant_get(try_parse_json({data}), concat('$.', {domain}), 'variant')"
    return f"coalesce(schema_of_variant({field}) = 'STRING', true)"


def link_key(value: str, shape: str, data: str = "data") -> str:
    """Passports link as they are, full names and addresses in normalised form.

    No key: null, '', and 0, false, [] and {} that are not quoted.  The message is parsed again
    only where the value looks like one of these.
    """
    normal = normalize_key(value)
    key = _by_domain(shape, value, normal, normal)
    return (
        f"CASE WHEN {text(value)} = '' THEN NULL WHEN {value} RLIKE '{_FALSY}'"
        f" AND NOT {is_json_text(data, link_domain(shape))} THEN NULL ELSE {key} END"
    )


def sex_values(value: str) -> str:
    """The ``sex`` field as a list; plain text becomes a one-element list."""
    return (
        f"coalesce(CASE WHEN startswith({value}, '[') THEN from_json({value}, 'array<string>')"
        f" END, CASE WHEN {value} IS NOT NULL THEN array({value}) END)"
    )


def sex_is_scalar(value: str) -> str:
    return f"NOT startswith({value}, '[')"


def sex_scalar(sex: str = "sex", is_scalar: str = "sex_is_scalar", mode: str = "bulk") -> str:
    """One text for ``sex``.

    ``bulk``: first list item, or the first character of plain text, or ''.
    ``strict``: first list item or the whole text; null where there is none.
    """
    if mode == "strict":
        return f"nullif(get({sex}, 0), '')"
    if mode != "bulk":
        raise ValueError(f"unknown mode {mode!r}")
    return text(
        f"CASE WHEN coalesce({is_scalar}, false) THEN substring(get({sex}, 0), 1, 1)"
        f" ELSE get({sex}, 0) END"
    )
