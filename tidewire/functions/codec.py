"""JSON wire format of events: no type header, camelCase names, UTC instants.

``decode`` never fails a job. A value that cannot be read as the expected type
keeps its envelope and carries a reason in ``decode_error``. A text field takes any
single value, as numbers and truth values have a text form, but no object or list.
"""

from pyspark.sql import DataFrame

from tidewire import schemas
from tidewire.functions.constraints import outside_domain
from tidewire.functions.instants import instant_text, parse_instant
from tidewire.functions.sql import cases, computed_once, literal
from tidewire.functions.text import is_uuid

NULL_PAYLOAD = "null payload"
UNDECODABLE = "undecodable value"


def encode(category: str) -> str:
    """JSON text of an event of the given category; absent values are written as null."""
    fields = ", ".join(
        f"{literal(name)}, {instant_text(column) if column == 'occurred_at' else column}"
        for name, column in schemas.WIRE_FIELDS[category].items()
    )
    return f"to_json(named_struct({fields}), map('ignoreNullFields', 'false'))"


def encode_any(*categories: str) -> str:
    """JSON text of a wide event row, by its category."""
    return cases({f"category = {literal(name)}": encode(name) for name in categories or schemas.CATEGORIES})


def _nested(value: str, fields: dict[str, str]) -> str:
    """Whether a field that should hold a single value holds an object or a list; null if it cannot be told.

    The reader gives both as their JSON text, so a text that begins like one is looked up in the value itself. Few
    texts do, and only their values are parsed again.
    """
    tests = []
    for name, column in fields.items():
        found = f"try_variant_get(try_parse_json({value}), '$.{name}'"
        if column == "metadata":
            begins = rf"exists(map_values(r.json.{name}), v -> rlike(v, r'^[{{\[]'))"
            kinds = f"exists(map_values({found}, 'map<string, variant>')), v -> rlike(schema_of_variant(v), '^(OBJECT|ARRAY)'))"
        else:
            begins = rf"rlike(r.json.{name}, r'^[{{\[]')"
            kinds = f"rlike(schema_of_variant({found}, 'variant')), '^(OBJECT|ARRAY)')"
        if column != "occurred_at":
            tests.append(f"({begins} AND {kinds})")
    return " OR ".join(tests)


def decode(records: DataFrame, *categories: str, value: str = "value") -> DataFrame:
    """Replace ``value`` by typed event columns and ``decode_error``.

    The reader names the expected categories, since the wire carries no type.
    With several categories the union of their fields is read in one pass.
    """
    fields: dict[str, str] = {}
    for category in categories or schemas.CATEGORIES:
        fields.update(schemas.WIRE_FIELDS[category])
    kept = [f"`{name}`" for name in records.columns if name != value]

    # Ids and enum constants are read as text, so that a bad one can be reported instead
    # of silently becoming null. The time may be text or a number, and only a variant
    # keeps all the digits of a number.
    types = {"metadata": "MAP<STRING, STRING>", "occurred_at": "VARIANT"}
    wire = ", ".join(f"{name} {types.get(column, 'STRING')}" for name, column in fields.items())
    parsed = f"from_json({value}, '{wire}, _corrupt STRING', map('columnNameOfCorruptRecord', '_corrupt'))"
    # Text, then time, each taken once from what came before.
    texts = f"transform(array({parsed}), j -> struct(j, try_variant_get(j.occurredAt, '$', 'string') AS text))"
    times = f"transform({texts}, r -> struct(r.j AS json, r.text AS text, {parse_instant('r.text')} AS time))"
    judged = f"transform({times}, r -> struct(r.json, r.text, r.time, {_nested(value, fields)} AS nested))"
    raw = computed_once(records, f"named_struct('absent', {value} IS NULL, 'read', {judged}[0])", "_raw").selectExpr(
        *kept, "_raw.absent AS _absent", "_raw.read AS _raw"
    )

    columns, broken = [], ["_raw.json IS NULL", "_raw.json._corrupt IS NOT NULL", "_raw.nested"]
    for name, column in fields.items():
        if column == "occurred_at":
            columns.append("_raw.time AS occurred_at")
            broken.append("_raw.text IS NOT NULL AND _raw.time IS NULL")
            continue
        columns.append(f"_raw.json.{name} AS {column}")
        if column == "event_id":
            broken.append(f"NOT coalesce({is_uuid(f'_raw.json.{name}')}, true)")
        elif column in schemas.ENUM_DOMAINS:
            broken.append(outside_domain(f"_raw.json.{name}", schemas.ENUM_DOMAINS[column]))
    error = cases({"_absent": literal(NULL_PAYLOAD), " OR ".join(f"({t})" for t in broken): literal(UNDECODABLE)})
    return raw.selectExpr(*kept, *columns, f"{error} AS decode_error")
