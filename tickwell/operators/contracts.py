"""Contract validation of raw payloads, as Column expressions.

A contract (``schemas.CONTRACTS``) is a table of fields.  ``validate`` parses each
payload once and lists what breaks its contract as (loc, msg, type); one error makes
the whole payload invalid.  Everything happens inside the row with higher-order
functions: no shuffle, no exploded rows, no Python.

Values are taken as leniently as the usual validators do: numbers may come as text or
booleans, whole decimals are integers, times may be ISO text or epoch seconds or
milliseconds.  Text must be text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.functions.scalars import drop_empty, to_bigint
from tickwell.schemas import CONTRACTS, Field, ListOf, MapOf, Record, RecordList, Rows, Scalar
from tickwell.session import materialize

ERRORS_TYPE = "array<struct<loc:string,msg:string,type:string>>"
LOC_SEPARATOR = " -> "

# Error type -> message.
MESSAGES = {
    "json_invalid": "payload is not valid JSON",
    "json_too_large": "a field beside its texts is too large to be checked",
    "missing": "a required field is absent",
    "string_type": "a text value is needed",
    "float_type": "a number is needed",
    "float_parsing": "the text is no number",
    "int_type": "an integer is needed",
    "int_parsing": "the text is no integer",
    "int_parsing_size": "the number is beyond the integer range",
    "int_from_float": "the number has a fractional part",
    "finite_number": "a finite number is needed",
    "datetime_type": "a time is needed",
    "datetime_parsing": "the time is out of range",
    "datetime_from_date_parsing": "the text is no time or date",
    "list_type": "a list is needed",
    "dict_type": "an object is needed",
    "model_type": "an object with named fields is needed",
    "value_error": "a row has the wrong number of values",
}

# Text forms taken as numbers and times.
FLOAT_TEXT = r"(?i)^[+-]?(inf|infinity|nan|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)$"
INT_TEXT = r"^[+-]?\d+(_\d+)*(\.0+)?$"
EPOCH_TEXT = r"^[+-]?(\d{1,18}|\d+\.\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)$"
ISO_TEXT = (
    r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])"
    r"([Tt _]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d([.,]\d+)?)?"
    r"([Zz]|[+\-−]([01]\d|2[0-3]):?[0-5]\d)?)?$"
)
MILLIS_ABOVE = 2e10  # an epoch number beyond this counts milliseconds
MIN_EPOCH, MAX_EPOCH = -62135596800, 253402300800  # years 1 to 9999, in seconds
INT64_LIMIT = float(2**63)
PARSE_LIMIT = 16 * 1024 * 1024  # bytes of text any document of which can be parsed at once
LONG_TEXT = 1 << 20  # of a larger document, texts beyond so many characters are set aside while it is parsed
_ASIDE = "\uffff"  # what stands for such a text, with its place; it is no number, no time and not blank


class ContractError(ValueError):
    """Raised when payloads break their contract and the caller asked for strictness."""


def _get(doc: Column, target: str, key: str | None = None) -> Column:
    return F.try_variant_get(doc, f"$.{key}" if key else "$", target)


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once however often it is referred to."""
    return F.get(F.transform(F.array(value), use), 0)


def _error(loc: Column, kind: Column) -> Column:
    """A place and a kind of error, or NULL when there is no kind."""
    return _bind(
        kind, lambda k: F.when(k.isNotNull(), F.struct(loc.alias("loc"), k.alias("type")))
    )


def _worded(errors: Column) -> Column:
    """Errors with their messages."""
    messages = F.expr("map(" + ", ".join(f"'{k}', '{v}'" for k, v in MESSAGES.items()) + ")")
    return F.transform(
        errors,
        lambda e: F.struct(e["loc"], F.try_element_at(messages, e["type"]).alias("msg"), e["type"]),
    ).cast(ERRORS_TYPE)


def _errors(*entries: Column) -> Column:
    return F.filter(F.array(*entries), lambda e: e.isNotNull())


def _none() -> Column:
    return F.expr("cast(array() as array<struct<loc:string,type:string>>)")


def _at(loc: Column | None, child: Column) -> Column:
    child = child.cast("string")
    return child if loc is None else F.concat(loc, F.lit(LOC_SEPARATOR), child)


def _root(loc: Column | None) -> Column:
    return F.lit("") if loc is None else loc


# ------------------------------------------------------------------------ scalars


def _is_number(json_type: Column) -> Column:
    return json_type.isin("BIGINT", "DOUBLE") | json_type.startswith("DECIMAL")


def _stripped(text: Column) -> Column:
    """Text without surrounding white space of any kind."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _plain_number(text: Column) -> Column:
    """Numeric text without surrounding space and digit separators; NULL if misplaced."""
    stripped = _stripped(text)
    misplaced = stripped.rlike("^_|_$|__")
    return F.when(~misplaced, F.replace(stripped, F.lit("_"), F.lit("")))


def _float_fault(v: Column, json_type: Column) -> Column:
    parses = F.coalesce(_plain_number(_get(v, "string")).rlike(FLOAT_TEXT), F.lit(False))
    return F.when(_is_number(json_type) | (json_type == "BOOLEAN"), None).otherwise(
        F.when(json_type != "STRING", "float_type").when(~parses, "float_parsing")
    )


def _int_fault(v: Column, json_type: Column) -> Column:
    number = _get(v, "double")
    text = _stripped(_get(v, "string"))
    whole = json_type.isin("BIGINT", "BOOLEAN") | json_type.endswith(",0)")
    return F.when(whole, None).otherwise(
        F.when(
            json_type == "STRING", F.when(~text.rlike(INT_TEXT), "int_parsing")
        ).otherwise(
            F.when(~_is_number(json_type), "int_type")
            .when(F.abs(number) == float("inf"), "finite_number")
            .when(F.rint(number) != number, "int_from_float")
            .when(F.abs(number) >= INT64_LIMIT, "int_parsing_size")
        )
    )


def _epoch_seconds(number: Column) -> Column:
    return F.when(F.abs(number) > MILLIS_ABOVE, number / 1000).otherwise(number)


def _is_iso(text: Column) -> Column:
    """Whether text is an ISO time or date of an existing day."""
    real_day = F.substring(text, 1, 10).try_cast("date").isNotNull()
    return text.rlike(ISO_TEXT) & real_day & ~text.startswith("0000")


def _datetime_fault(v: Column, json_type: Column) -> Column:
    text = _get(v, "string")
    in_text = (json_type == "STRING") & text.rlike(EPOCH_TEXT)
    epoch = F.when(in_text, text.try_cast("double")).when(_is_number(json_type), _get(v, "double"))
    seconds = _epoch_seconds(epoch)
    year_0 = F.concat(F.lit("0004"), F.substring(text, 5, 99))
    return (
        F.when(
            epoch.isNotNull(),
            F.when((seconds < MIN_EPOCH) | (seconds >= MAX_EPOCH), "datetime_parsing"),
        )
        .when(json_type != "STRING", "datetime_type")
        .when(_is_iso(text), None)
        .when(text.startswith("0000") & _is_iso(year_0), "datetime_parsing")
        .otherwise("datetime_from_date_parsing")
    )


_FAULT = {
    "str": lambda v, t: F.when(t != "STRING", "string_type"),
    "float": _float_fault,
    "int": _int_fault,
    "datetime": _datetime_fault,
}


def _scalar_fault(spec: Scalar, v: Column, nullable: bool) -> Column:
    """Error type of one present value, NULL when it is fine."""
    return _bind(F.schema_of_variant(v), lambda t: _typed_fault(spec, v, t, nullable))


def _typed_fault(spec: Scalar, v: Column, json_type: Column, nullable: bool) -> Column:
    fault = _FAULT[spec.kind](v, json_type)
    return F.when(json_type != "VOID", fault) if nullable else fault


def _number_in_text(text: Column, kind: str) -> Column:
    """The number that a text stands for."""
    if kind == "int":
        return F.regexp_replace(_stripped(text), r"_|\.0+$|^\+", "").try_cast("bigint")
    plain = _plain_number(text)
    return F.when(plain.rlike("(?i)nan"), F.lit(float("nan"))).otherwise(plain.try_cast("double"))


def _float_value(v: Column) -> Column:
    parsed = _number_in_text(_get(v, "string"), "float")
    return F.when(F.schema_of_variant(v) == "STRING", parsed).otherwise(_get(v, "double"))


def _int_value(v: Column) -> Column:
    json_type = F.schema_of_variant(v)
    exact = _get(v, "bigint")
    return (
        F.when(json_type == "STRING", _number_in_text(_get(v, "string"), "int"))
        .when(json_type == "DOUBLE", F.when(F.abs(_get(v, "double")) < INT64_LIMIT, exact))
        .otherwise(exact)
    )


def _iso_value(text: Column) -> Column:
    """Time of an ISO text, read as UTC when it names no zone."""
    usual = text.try_cast("timestamp")
    iso = F.regexp_replace(F.upper(text), "^(.{10})[ _]", "$1T")
    iso = F.replace(F.replace(iso, F.lit(","), F.lit(".")), F.lit("−"), F.lit("-"))
    iso = F.regexp_replace(iso, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.coalesce(usual, iso.try_cast("timestamp"))


def _datetime_value(v: Column) -> Column:
    text = _get(v, "string")
    epoch = F.when(
        F.schema_of_variant(v) == "STRING",
        F.when(text.rlike(EPOCH_TEXT), text.try_cast("double")),
    ).otherwise(_get(v, "double"))
    seconds = _epoch_seconds(epoch)
    in_range = (seconds >= MIN_EPOCH) & (seconds < MAX_EPOCH)
    micros = F.when(in_range, to_bigint(seconds * 1_000_000))
    return F.coalesce(F.timestamp_micros(micros), _iso_value(text))


_VALUE = {
    "str": lambda v: _whole(_get(v, "string")),
    "float": _float_value,
    "int": _int_value,
    "datetime": _datetime_value,
}
_SQL_TYPE = {"str": "string", "float": "double", "int": "bigint", "datetime": "timestamp"}


# ------------------------------------------------------------------------- errors


def _fields_of_scalars(fields: list[Field], doc: Column, loc: Column | None) -> Column:
    """Errors of neighbouring scalar fields, one lambda per kind of value.

    The fields go through as data, so the plan holds each rule once per kind and
    nullability instead of once per field.
    """
    rules = {(f.spec.kind, f.nullable): i for i, f in enumerate(fields)}
    terms = {rules[f.spec.kind, f.nullable]: f for f in fields}
    known = ", ".join(
        f"named_struct('name', '{f.name}', 'rule', {rules[f.spec.kind, f.nullable]}, "
        f"'required', {str(f.required).lower()})"
        for f in fields
    )
    typed = F.zip_with(
        F.expr(f"array({known})"),
        F.array(*[_get(doc, "variant", f.name) for f in fields]),
        lambda p, v: F.struct(p.alias("p"), v.alias("v"), F.schema_of_variant(v).alias("t")),
    )

    def fault_of(x: Column) -> Column:
        p = x["p"]
        fault = F.lit(None).cast("string")
        for rule, f in terms.items():
            of_rule = _typed_fault(f.spec, x["v"], x["t"], f.nullable)
            fault = F.when(p["rule"] == rule, of_rule).otherwise(fault)
        absent = F.when(p["required"], "missing")
        kind = F.when(x["t"].isNull(), absent).otherwise(fault)
        return F.struct(p["name"].alias("name"), kind.alias("kind"))

    found = F.filter(F.transform(typed, fault_of), lambda x: x["kind"].isNotNull())
    return F.transform(found, lambda x: _error(_at(loc, x["name"]), x["kind"]))


def _record_errors(spec: Record, doc: Column, loc: Column | None) -> Column:
    pieces: list[Column] = []
    scalars: list[Field] = []
    for f in spec.fields:
        if isinstance(f.spec, Scalar):
            scalars.append(f)
            continue
        if scalars:
            pieces.append(_fields_of_scalars(scalars, doc, loc))
            scalars = []
        pieces.append(_composite_field(f, doc, loc))
    if scalars:
        pieces.append(_fields_of_scalars(scalars, doc, loc))
    inside = F.concat(*pieces) if len(pieces) > 1 else pieces[0]
    is_object = F.schema_of_variant(doc).startswith("OBJECT")
    return F.when(is_object, inside).otherwise(_errors(_error(_root(loc), F.lit("model_type"))))


def _composite_field(f: Field, doc: Column, loc: Column | None) -> Column:
    here = _at(loc, F.lit(f.name))
    # Bind the field's value once; its errors refer to it many times.
    bound = F.transform(
        F.array(_get(doc, "variant", f.name)), lambda v: _value_errors(f, v, here)
    )
    return F.get(bound, 0)


def _value_errors(f: Field, v: Column, here: Column) -> Column:
    absent = _errors(_error(here, F.lit("missing"))) if f.required else _none()
    present = _errors_of(f.spec, v, here)
    if f.nullable:
        present = F.when(F.is_variant_null(v), _none()).otherwise(present)
    return F.when(v.isNull(), absent).otherwise(present)


def _list_errors(spec: ListOf, v: Column, loc: Column | None) -> Column:
    found = F.transform(
        _get(v, "array<variant>"),
        lambda x, i: _error(_at(loc, i), _scalar_fault(spec.item, x, spec.item_nullable)),
    )
    wrong = _errors(_error(_root(loc), F.lit("list_type")))
    return F.coalesce(F.filter(found, lambda e: e.isNotNull()), wrong)


def _map_errors(spec: MapOf, v: Column, loc: Column | None) -> Column:
    found = F.transform(
        F.map_entries(_get(v, "map<string,variant>")),
        lambda e: _error(_at(loc, e["key"]), _scalar_fault(spec.value, e["value"], spec.value_nullable)),
    )
    wrong = _errors(_error(_root(loc), F.lit("dict_type")))
    return F.coalesce(F.filter(found, lambda e: e.isNotNull()), wrong)


def _off(rows: Column, width: int) -> Column:
    """Whether a row of doubles is missing, has a hole or the wrong width."""
    return F.exists(
        rows, lambda p: p.isNull() | (F.size(p) != width) | F.exists(p, lambda x: x.isNull())
    )


def _rows_walk(spec: Rows, items: Column, loc: Column | None) -> Column:
    """Errors of the rows of a series, value by value; NULL rows are no list."""

    def row(x: Column, i: Column) -> Column:
        values = F.transform(
            _get(x, "array<variant>"),
            lambda y, j: _error(_at(_at(loc, i), j), _scalar_fault(Scalar("float"), y, False)),
        )
        wrong = _errors(_error(_at(loc, i), F.lit("list_type")))
        return F.coalesce(F.filter(values, lambda e: e.isNotNull()), wrong)

    detail = F.flatten(F.transform(items, row))
    uneven = F.exists(items, lambda x: F.size(_get(x, "array<variant>")) != spec.width)
    width = F.when(uneven, _errors(_error(_root(loc), F.lit("value_error")))).otherwise(_none())
    return F.when(items.isNull(), _errors(_error(_root(loc), F.lit("list_type")))).otherwise(
        F.get(F.transform(F.array(detail), lambda d: F.when(F.size(d) > 0, d).otherwise(width)), 0)
    )


def _rows_errors(spec: Rows, v: Column, loc: Column | None) -> Column:
    """Errors of a series: first its values, and only if those are fine its widths."""
    # One look at the merged type and one pass over the decoded doubles settle a series
    # of plain numbers; the detailed walk below runs only for the others.
    number = r"(VOID|BIGINT|DOUBLE|BOOLEAN|DECIMAL\(\d+,\d+\))"
    plain = F.schema_of_variant(v).rlike(f"^ARRAY<(VOID|ARRAY<{number}>)>$")
    sound = plain & ~F.coalesce(_off(_get(v, "array<array<double>>"), spec.width), F.lit(True))

    return F.when(sound, _none()).otherwise(_rows_walk(spec, _get(v, "array<variant>"), loc))


# JSON types of a whole column of values that may be fine without a walk, by kind ...
_PLAIN = {
    "str": "STRING",
    "float": r"BIGINT|DOUBLE|BOOLEAN|DECIMAL\(|STRING",
    "int": r"BIGINT|BOOLEAN|DOUBLE|DECIMAL\(|STRING",
    "datetime": "STRING",
}
# ... and those of them whose values have to be looked at one by one.
_LOOSE = {"float": "STRING", "int": r"STRING|DOUBLE|DECIMAL\("}


def _numbers(spec: RecordList) -> list[Field]:
    return [f for f in spec.record.fields if f.spec.kind in _LOOSE]


def _any_loose(spec: RecordList, merged: Column) -> Column:
    """Whether some numbers are written as text, or integers as decimals."""
    found = [f"[< ]({'|'.join(f.name for f in _numbers(spec) if f.spec.kind == k)}): ({t})" for k, t in _LOOSE.items()]
    return merged.rlike("|".join(found)) if _numbers(spec) else F.lit(False)


def _written_as(types: str, f: Field, merged: Column) -> Column:
    """Whether a number is written in such a way by all records that have it; values of mixed types have no such type."""
    return merged.rlike(f"[< ]{f.name}: ({types})")


def _typed_items(fields: list[Field], v: Column, types: Callable[[Field], str]) -> Column:
    """The named fields of all records, in one typed access."""
    return _get(v, f"array<struct<{','.join(f'{f.name}:{types(f)}' for f in fields)}>>")


def _numbers_off(spec: RecordList, v: Column, merged: Column) -> Column:
    """Whether some number in text does not parse, or some integer written as a decimal may not be one.

    Each such number is read on its own, if the merged type says that it is there.
    """
    def any_off(f: Field, target: str, off: Callable[[Column], Column]) -> Column:
        values = F.transform(_typed_items([f], v, lambda _: target), lambda x: x[f.name])
        return F.coalesce(F.exists(values, lambda x: x.isNotNull() & off(x)), F.lit(True))

    def text_off(kind: str) -> Callable[[Column], Column]:
        parses = (lambda x: _stripped(x).rlike(INT_TEXT)) if kind == "int" else (lambda x: _plain_number(x).rlike(FLOAT_TEXT))
        return lambda x: ~F.coalesce(parses(x), F.lit(False))

    def number_off(x: Column) -> Column:
        return ~((F.rint(x) == x) & (F.abs(x) < INT64_LIMIT))

    found = F.lit(False)
    for f in _numbers(spec):
        found = found | (_written_as("STRING", f, merged) & any_off(f, "string", text_off(f.spec.kind)))
        if f.spec.kind == "int":
            found = found | (_written_as(r"DOUBLE|DECIMAL\(", f, merged) & any_off(f, "double", number_off))
    return found


def _plain_list(spec: RecordList, v: Column, valid: bool = False) -> Column:
    """Whether a list of flat records is fine by its merged type and the values that does not tell.

    Of a valid list only times are looked at, which may be epochs in text.

    The merged type of all items comes from one look at the document; what it cannot
    show (a null or absent required value, the text of a time or number, whether a decimal
    is whole) is read in a few typed accesses.  False only means that the detailed walk has to decide.
    """
    fields = spec.record.fields
    by_types: dict[str, list[str]] = {}
    for f in fields:
        allowed = _PLAIN[f.spec.kind] + ("|VOID" if f.nullable else "")
        by_types.setdefault(allowed, []).append(f.name)
    wrong = "|".join(f"[< ]({'|'.join(names)}): (?!{allowed})" for allowed, names in by_types.items())
    merged = F.schema_of_variant(v)
    seen = [f for f in fields if (f.required and not valid) or f.spec.kind == "datetime"]

    def suspect(x: Column) -> Column:
        doubt = x.isNull()
        for f in seen:
            value = x[f.name]
            if f.required:
                doubt = doubt | value.isNull()
            if f.spec.kind == "datetime":
                doubt = doubt | (value.isNotNull() & ~_is_iso(value))
        return doubt

    def settle(m: Column) -> Column:
        typed = m.startswith("ARRAY<OBJECT<") & ~m.rlike(wrong)
        sound = ~F.coalesce(F.exists(_typed_items(seen, v, lambda f: "string"), suspect), F.lit(True)) if seen else F.lit(True)
        settled = typed & sound
        return settled if valid else settled & (~_any_loose(spec, m) | ~_numbers_off(spec, v, m))

    return _bind(merged, settle)


def _records_walk(spec: RecordList, items: Column, loc: Column | None) -> Column:
    """Errors of a list of records, one by one; NULL items are no list."""
    found = F.transform(items, lambda x, i: _record_errors(spec.record, x, _at(loc, i)))
    return F.coalesce(F.flatten(found), _errors(_error(_root(loc), F.lit("list_type"))))


def _flat(spec: object) -> bool:
    return isinstance(spec, RecordList) and all(isinstance(f.spec, Scalar) for f in spec.record.fields)


def _errors_of(spec: object, v: Column, loc: Column | None) -> Column:
    if isinstance(spec, Record):
        return _record_errors(spec, v, loc)
    if isinstance(spec, RecordList):
        walked = _records_walk(spec, _get(v, "array<variant>"), loc)
        return F.when(_plain_list(spec, v), _none()).otherwise(walked) if _flat(spec) else walked
    if isinstance(spec, Rows):
        return _rows_errors(spec, v, loc)
    if isinstance(spec, MapOf):
        return _map_errors(spec, v, loc)
    return _list_errors(spec, v, loc)


# --------------------------------------------------- documents of numeric rows only

# Reader options that keep to the letter of JSON, as the VARIANT parser does.
_STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _series_of(spec: object) -> dict[str, int] | None:
    """Names and widths of the series, when a contract holds nothing but numeric rows.

    The name is '' where the document itself is the series.
    """
    if isinstance(spec, Rows):
        return {"": spec.width}
    if isinstance(spec, Record) and all(isinstance(f.spec, Rows) and f.required for f in spec.fields):
        return {f.name: f.spec.width for f in spec.fields}
    return None


def _in_list(text: Column) -> Column:
    """The text as first of two list items.

    A JSON reader stops after the first document and ignores what follows; inside a list
    anything but exactly one document breaks the list or its length.
    """
    return F.concat(F.lit("["), text, F.lit(",null]"))


def _decoded(series: dict[str, int], text: Column) -> Column:
    """The document's series as doubles, as first of two items when it is one document."""
    rows = "array<array<double>>"
    whole = rows if "" in series else f"struct<{','.join(f'{n}:{rows}' for n in series)}>"
    return F.from_json(_in_list(text), f"array<{whole}>", _STRICT_JSON)


def _if_sound(series: dict[str, int], text: Column, use) -> Column:
    """``use`` of the decoded document if that keeps the contract for sure, else NULL."""

    def settle(doc: Column) -> Column:
        sound = F.lit(True)
        for name, width in series.items():
            off = _off(doc[name] if name else doc, width)
            sound = sound & ~F.coalesce(off, F.lit(True))
        return F.when(sound, use(doc))

    return _bind(
        _decoded(series, text),
        lambda items: F.when(F.size(items) == 2, _bind(F.get(items, 0), settle)),
    )


def _contract(contract: object) -> object:
    return CONTRACTS[contract] if isinstance(contract, str) else contract


def _parsed(text: Column) -> Column:
    items = _get(F.try_parse_json(_in_list(text)), "array<variant>")
    return _bind(items, lambda x: F.when(F.size(x) == 2, F.get(x, 0)))


# The parser of VARIANT takes texts of 20 million characters and values of 128 MB.  Documents beyond that
# are read by the plain JSON reader, which can be told to take texts of any length.
_ANY_LENGTH = {**_STRICT_JSON, "maxStringLen": str(2**31 - 1)}


def _quoted(text: Column) -> Column:
    """A JSON document cut at its quotes: what stands in quotes has the odd places."""
    plain = F.replace(text, F.lit("\\\\"), F.lit("\\u005c"))
    return F.split(F.replace(plain, F.lit('\\"'), F.lit("\\u0022")), '"')


def _shortened(text: Column) -> Column:
    """A JSON document whose very long texts are set aside; NULL when it is not exactly one document."""
    one = F.size(F.from_json(_in_list(text), "array<string>", _ANY_LENGTH)) == 2
    short = F.transform(
        _quoted(text),
        lambda x, i: F.when((i % 2 == 1) & (F.length(x) > LONG_TEXT), F.concat(F.lit(_ASIDE), i.cast("string"))).otherwise(x),
    )
    return F.when(one, F.array_join(short, '"'))


def _whole(text: Column) -> Column:
    """A text of a document, or the one that was set aside for it, from the column ``_quoted``."""
    place = F.substring(text, 2, 10).try_cast("int")
    aside = F.get(F.from_json(F.concat(F.lit('["'), F.get(F.col("_quoted"), place), F.lit('"]')), "array<string>", _ANY_LENGTH), 0)
    return F.when(text.startswith(_ASIDE), F.coalesce(aside, text)).otherwise(text)


def _is_large(text: Column) -> Column:
    return F.octet_length(text) > PARSE_LIMIT


def _document(text: Column) -> Column:
    """The payload as VARIANT, very long texts set aside; NULL when it is not exactly one JSON document or too large."""
    return F.coalesce(_parsed(text), F.when(_is_large(text), _bind(_shortened(text), _parsed)))


def _piecewise(spec: object, text: Column) -> Column | None:
    """Errors and number of items of a valid document too large for one VARIANT, its lists read item by item."""
    if isinstance(spec, (Rows, RecordList)):
        walk = _rows_walk if isinstance(spec, Rows) else _records_walk
        items = F.from_json(text, "array<variant>", _ANY_LENGTH)
        return _bind(items, lambda x: F.struct(_worded(walk(spec, x, None)).alias("errors"), F.size(x).alias("n")))
    if not _series_of(spec):
        return None
    names = [f.name for f in spec.fields]
    read = F.struct(
        *[F.from_json(text, f"struct<{','.join(f'{n}:{t}' for n in names)}>", _ANY_LENGTH).alias(k) for k, t in (("v", "variant"), ("a", "array<variant>"))]
    )

    def walked(r: Column) -> Column:
        found, lists = [], []
        for f in spec.fields:
            here = _at(None, F.lit(f.name))
            value, items = r["v"][f.name], F.coalesce(_get(r["v"][f.name], "array<variant>"), r["a"][f.name])
            absent = value.isNull() & items.isNull()
            missing = _errors(_error(here, F.lit("missing")))
            found.append(_bind(items, lambda x: F.when(absent, missing).otherwise(_rows_walk(f.spec, x, here))))
            lists.append(items)
        return F.struct(_worded(F.concat(*found)).alias("errors"), F.size(lists[0]).alias("n"))

    wrong = F.struct(_worded(_errors(_error(F.lit(""), F.lit("model_type")))).alias("errors"), F.lit(None).cast("int").alias("n"))
    return F.when(F.ltrim(text, F.lit(" \t\r\n")).startswith("{"), _bind(read, walked)).otherwise(wrong)


def _items_in(spec: object, doc: Column) -> Column:
    """Number of entries of the list a payload is about."""
    if isinstance(spec, (Rows, RecordList)):
        return F.size(_get(doc, "array<variant>"))
    if _series_of(spec):
        return F.size(_get(doc, "array<variant>", spec.fields[0].name))
    return F.lit(None).cast("int")


_COLUMNS: dict = {}


def _built(what: str, spec: object, payload: str, build: Callable[[], Column]) -> Column:
    """A contract's expression, put together once per application; it depends on no data."""
    key = (SparkContext.getOrCreate().applicationId, what, spec, payload)
    if key not in _COLUMNS:
        _COLUMNS[key] = build()
    return _COLUMNS[key]


def _check(spec: object, payload: str) -> Column:
    """Errors and number of items of a payload; ``doc`` is the payload as VARIANT."""
    text = F.col(payload)

    def walk(doc: Column) -> Column:
        def broken(kind: str) -> Column:
            return F.struct(_worded(_errors(_error(F.lit(""), F.lit(kind)))).alias("errors"), F.lit(None).cast("int").alias("n"))

        def in_pieces(short: Column) -> Column:
            pieces = _piecewise(spec, short)
            return F.when(short.isNull(), broken("json_invalid")).otherwise(broken("json_too_large") if pieces is None else pieces)

        whole = F.struct(_worded(_errors_of(spec, doc, None)).alias("errors"), _items_in(spec, doc).alias("n"))
        large = F.when(_is_large(text), _bind(_shortened(text), in_pieces)).otherwise(broken("json_invalid"))
        return F.when(doc.isNull(), large).otherwise(whole)

    series = _series_of(spec)
    if not series:
        return walk(F.col("doc"))

    # Plain doubles decode several times faster than VARIANT, which is parsed only for
    # documents that do not pass as such.  (``doc`` costs nothing unless it is used.)
    first = next(iter(series))

    def fine(doc: Column) -> Column:
        rows = doc[first] if first else doc
        none = F.expr(f"cast(array() as {ERRORS_TYPE})")
        return F.struct(none.alias("errors"), F.size(rows).alias("n"))

    return F.coalesce(_if_sound(series, text, fine), _bind(_document(text), walk))


def _record(spec: object, payload: str) -> Column:
    """The typed record of a valid payload."""
    record = _typed(spec, F.col("doc"))
    series = _series_of(spec)
    if series:
        # Read the variant only where the doubles do not tell the whole record.
        text = F.col(payload)
        walked = _bind(_document(text), lambda doc: _typed(spec, doc))
        record = F.coalesce(_if_sound(series, text, lambda doc: doc), walked)
    if isinstance(spec, Record) and [f.name for f in spec.fields] == ["data"]:
        record = record["data"]
    return record


def validate(
    df: DataFrame,
    contract: object,
    payload: str = "payload",
    raise_on_invalid: bool = False,
) -> DataFrame:
    """Add ``doc`` (the payload as VARIANT), ``errors``, ``n_items`` (entries of the payload's
    list, for the kinds that have one) and ``status`` ('valid' / 'invalid').

    ``contract`` is a payload kind or a contract term.  With ``raise_on_invalid`` the
    payloads are checked at once and the result is written to the scratch folder, where
    invalid ones are counted and any makes the call raise; what is returned reads it from there.
    """
    spec = _contract(contract)
    parsed = df.withColumn("doc", _document(F.col(payload)))
    check = _built("check", spec, payload, lambda: _check(spec, payload))
    errors = F.col("_check.errors")
    checked = parsed.select("*", check.alias("_check")).select(
        *parsed.columns,
        errors.alias("errors"),
        F.col("_check.n").cast("bigint").alias("n_items"),
        F.when(F.size(errors) == 0, "valid").otherwise("invalid").alias("status"),
    )
    if raise_on_invalid:
        checked = materialize(checked, "validated")
        bad = checked.agg(F.count_if(F.col("status") == "invalid").alias("n")).first()["n"]
        if bad:
            raise ContractError(f"{bad} payloads break their contract")
    return checked


# ------------------------------------------------------------------- typed records


def _plain_records(spec: RecordList, v: Column) -> Column:
    """Records of a plain list, all fields in one typed access; a number in text in one of its own."""
    fields = spec.record.fields
    items = _typed_items(fields, v, lambda f: "string" if f.spec.kind == "datetime" else _SQL_TYPE[f.spec.kind])

    def value(x: Column, f: Field) -> Column:
        if f.spec.kind == "datetime":
            return _iso_value(x[f.name])
        return _whole(x[f.name]) if f.spec.kind == "str" else x[f.name]

    def record(x: Column) -> Column:
        return F.struct(*[value(x, f).alias(f.name) for f in fields])

    def loose(texts: Column) -> Column:
        def number(x: Column, i: Column, f: Field) -> Column:
            text = F.get(texts[f.name], i)[f.name]
            return F.when(texts[f.name].isNotNull(), _number_in_text(text, f.spec.kind)).otherwise(x[f.name])

        return F.transform(
            items,
            lambda x, i: F.struct(*[(number(x, i, f) if f.spec.kind in _LOOSE else value(x, f)).alias(f.name) for f in fields]),
        )

    def read(m: Column) -> Column:
        in_text = [F.when(_written_as("STRING", f, m), _typed_items([f], v, lambda f: "string")).alias(f.name) for f in _numbers(spec)]
        return F.when(_any_loose(spec, m), _bind(F.struct(*in_text), loose)).otherwise(F.transform(items, record))

    return _bind(F.schema_of_variant(v), read) if _numbers(spec) else F.transform(items, record)


def _typed(spec: object, v: Column) -> Column:
    if isinstance(spec, Scalar):
        return _VALUE[spec.kind](v)
    if isinstance(spec, Rows):
        rows = _get(v, "array<variant>")
        return F.transform(rows, lambda r: F.transform(_get(r, "array<variant>"), _float_value))
    if isinstance(spec, RecordList):
        walked = F.transform(_get(v, "array<variant>"), lambda x: _typed(spec.record, x))
        return F.when(_plain_list(spec, v, valid=True), _plain_records(spec, v)).otherwise(walked) if _flat(spec) else walked
    if isinstance(spec, ListOf):
        items = F.transform(_get(v, "array<variant>"), lambda x: _typed(spec.item, x))
        return items if spec.keep_empty else drop_empty(items)
    if isinstance(spec, MapOf):
        return F.transform_values(_get(v, "map<string,variant>"), lambda _, x: _typed(spec.value, x))
    return _typed_record(spec, v)


def _typed_record(spec: Record, doc: Column) -> Column:
    """A record with typed fields; scalars of one kind go through one lambda together."""
    kinds = list(dict.fromkeys(f.spec.kind for f in spec.fields if isinstance(f.spec, Scalar)))
    of_kind = {k: [f for f in spec.fields if f.spec == Scalar(k)] for k in kinds}
    scalars = [
        F.transform(
            F.array(*[_get(doc, "variant", f.name) for f in of_kind[k]]), _VALUE[k]
        ).alias(k)
        for k in kinds
    ]

    def build(values: Column) -> Column:
        fields = []
        for f in spec.fields:
            if isinstance(f.spec, Scalar):
                value = F.get(values[f.spec.kind], of_kind[f.spec.kind].index(f))
            else:
                value = _composite_value(f, doc)
            fields.append(value.alias(f.name))
        return F.struct(*fields)

    return _bind(F.struct(*scalars), build) if scalars else build(F.lit(None))


def _composite_value(f: Field, doc: Column) -> Column:
    return _bind(_get(doc, "variant", f.name), lambda v: _typed_field(f, v))


def _typed_field(f: Field, v: Column) -> Column:
    value = _typed(f.spec, v)
    if isinstance(f.spec, ListOf):
        return value if f.nullable and f.spec.keep_empty else F.coalesce(value, F.array().cast("array<string>"))
    if isinstance(f.spec, MapOf):
        empty = F.create_map().cast(f"map<string,{_SQL_TYPE[f.spec.value.kind]}>")
        return F.coalesce(value, empty)
    if isinstance(f.spec, Record):
        return F.when(F.schema_of_variant(v).startswith("OBJECT"), value)
    return value


def conform(validated: DataFrame, contract: object, payload: str = "payload") -> DataFrame:
    """Valid payloads only, with their typed ``record``: values coerced, defaults filled in,
    empty links dropped, and for the global kind the object inside the envelope."""
    spec = _contract(contract)
    record = _built("record", spec, payload, lambda: _record(spec, payload))
    # A generator over zero or one record rather than a filter: the optimizer would
    # copy the whole check into a filter and run it a second time.
    kept = F.when(F.size("errors") == 0, F.array(record))
    carried = [c for c in validated.columns if c not in ("doc", "errors", "n_items", "status")]
    aside = F.when(_is_large(F.col(payload)), _quoted(F.col(payload)))
    return validated.withColumn("_quoted", aside).select(*carried, F.explode(kept).alias("record"))


def report(validated: DataFrame, *keys: str) -> DataFrame:
    """Readable result per document: keys, PASS or FAIL, number of errors, their text."""
    line = F.transform(
        "errors",
        lambda e: F.concat(F.lit("field: "), e["loc"], F.lit(" | "), e["msg"], F.lit(" ("), e["type"], F.lit(")")),
    )
    return validated.select(
        *keys,
        F.when(F.col("status") == "valid", "PASS").otherwise("FAIL").alias("status"),
        F.size("errors").cast("bigint").alias("n_errors"),
        F.array_join(line, "\n").alias("errors"),
    )
