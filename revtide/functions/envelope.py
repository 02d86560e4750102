"""SQL expressions over change envelopes and their JSON values.

Every function takes SQL expressions as text and gives one back: a projection
over many columns is then one text for Spark to parse. Values inside an image
are variants, so the JSON type of each value is known and decides how it
converts.
"""

from __future__ import annotations

STRICT = "map('allowSingleQuotes', 'false')"
OPS = ("c", "u", "d", "r")
MILLIS_ABOVE = 10_000_000_000
# Largest distance from 1970 that stays within the calendar, in microseconds.
EPOCH_RANGE = 253_402_300_800_000_000

# The shapes of an ISO-8601 date or timestamp and of its zone.
TIME_SHAPE = r"\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
ZONE_SHAPE = r"(Z|[+-]\d{2}(:?\d{2})?)"
ISO_SHAPE = rf"^\d{{4}}-\d{{2}}-\d{{2}}([T ]{TIME_SHAPE}{ZONE_SHAPE}?)?$"
ZONED_SHAPE = rf"{TIME_SHAPE}{ZONE_SHAPE}$"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(texts) -> str:
    return ", ".join(quoted(t) for t in texts)


def parse_one(text: str, schema: str) -> str:
    """Parse a text that holds exactly one JSON value; null otherwise.

    The text is read as the only item of an array. A text that closes the
    bracket itself would pass, so one with a "]" is also read as a field.
    """
    items = f"from_json(concat('[', {text}, ']'), 'array<{schema}>', {STRICT})"
    inside = f"""from_json(concat('{{"x":', {text}, '}}'), 'x string', {STRICT}).x"""
    return (f"case when size({items}) = 1 and (not contains({text}, ']') or {inside} is not null) "
            f"then get({items}, 0) end")


def fields_of(value: str) -> str:
    """Fields of a variant object as a map; null for any other value."""
    return f"try_cast({value} as map<string,variant>)"


def text_at(image: str, name: str) -> str:
    """Text of a field; null only when the field is missing or null."""
    return f"try_variant_get({image}, '$.{name}', 'string')"


def kind_at(image: str, name: str) -> str:
    return f"schema_of_variant(variant_get({image}, '$.{name}', 'variant'))"


# Conversions take the image, the name of a field and the field's text (`text_at`).
# The JSON type is looked up only where the text does not settle the result.


def text_of(image: str, name: str, text: str) -> str:
    """Text of a JSON value; booleans read True and False, nested values stay JSON."""
    return (f"if({text} in ('true', 'false') and {kind_at(image, name)} = 'BOOLEAN', "
            f"initcap({text}), {text})")


def bigint_of(image: str, name: str, text: str) -> str:
    """Numbers lose their fraction; text counts only when it is a whole number."""
    return f"try_variant_get({image}, '$.{name}', 'bigint')"


def bool_of(image: str, name: str, text: str) -> str:
    """Strings are true only for true, t and 1; other values when not empty or zero."""
    kind = kind_at(image, name)
    return (f"case when {text} is null then null "
            f"when {kind} in ('BOOLEAN', 'STRING') then lower({text}) in ('true', 't', '1') "
            f"when {kind} like 'OBJECT%' or {kind} like 'ARRAY%' then {text} not in ('{{}}', '[]') "
            f"else try_cast({text} as double) <> 0 end")


def ntz_from_micros(micros: str) -> str:
    """Zone-free UTC timestamp, whatever the session time zone is."""
    seconds = f"cast(cast({micros} as decimal(20,0)) / 1000000 as decimal(18,6))"
    return f"timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, {seconds})"


def epoch_to_ts(number: str) -> str:
    """Epoch number to UTC; above ten billion it counts milliseconds, else seconds."""
    exact = f"try_cast({number} as decimal(28,9))"
    micros = (f"round({exact} * case when abs({exact}) > {MILLIS_ABOVE} then 1000 "
              "else 1000000 end, 0)")
    return (f"case when abs({micros}) < {EPOCH_RANGE} "
            f"then {ntz_from_micros(f'try_cast({micros} as bigint)')} end")


def iso_to_ts(text: str) -> str:
    """ISO-8601 text to naive UTC; an offset is applied, no offset means UTC."""
    # An offset needs seconds before it to be read.
    full = rf"regexp_replace({text}, r'^(.{{10}}[T ]\d{{2}}:\d{{2}})(Z|[+-])', '$1:00$2')"
    zoned = ntz_from_micros(f"unix_micros(try_cast({full} as timestamp))")
    return (f"case when not {text} rlike r'{ISO_SHAPE}' then null "
            f"when {text} rlike r'{ZONED_SHAPE}' then {zoned} "
            f"else try_cast({text} as timestamp_ntz) end")


def ts_of(image: str, name: str, text: str) -> str:
    """ISO text or an epoch number; no number reads like an ISO text."""
    kind = kind_at(image, name)
    return (f"case when {text} rlike r'{ISO_SHAPE}' then {iso_to_ts(text)} "
            f"when {text} is not null and "
            f"({kind} in ('BIGINT', 'DOUBLE') or {kind} like 'DECIMAL%') "
            f"then {epoch_to_ts(text)} end")


def date_of(image: str, name: str, text: str) -> str:
    """Whole numbers are days since 1970; strings give their first ten characters."""
    day, kind = f"substring({text}, 1, 10)", kind_at(image, name)
    return (rf"case when {day} rlike r'^\d{{4}}-\d{{2}}-\d{{2}}$' then try_cast({day} as date) "
            f"when {text} is not null and {kind} = 'BIGINT' "
            f"then date_from_unix_date(try_cast({text} as int)) end")


CONVERSIONS = {
    "varchar": text_of,
    "bigint": bigint_of,
    "boolean": bool_of,
    "timestamp": ts_of,
    "date": date_of,
}


def table_from_topic(topic: str, prefix: str, tables) -> str:
    name = f"substring({topic}, {len(prefix) + 1})"
    return (f"case when startswith({topic}, {quoted(prefix)}) and {name} in ({listed(tables)}) "
            f"then {name} end")


def pk_from_key(key: str, parsed: str, pk: str) -> str:
    """Primary key out of a record key: JSON field, JSON string or plain text."""
    return (f"case when {key} is null or {key} = '' then null when {parsed} is null then {key} "
            f"when {fields_of(parsed)} is not null "
            f"then {text_of(parsed, pk, text_at(parsed, pk))} "
            f"when schema_of_variant({parsed}) = 'STRING' then try_cast({parsed} as string) end")


def dedup_token(lsn: str, topic: str, partition: str, offset: str) -> str:
    """Same delivery, same token; a log position at a new offset is a new delivery."""
    return (f"case when {lsn} is not null then concat('lsn:', {lsn}, ':offset:', {offset}) "
            f"else concat('kafka:', {topic}, ':', {partition}, ':', {offset}) end")


def dead_letter_id(topic: str, partition: str, offset: str) -> str:
    return f"concat({topic}, ':', {partition}, ':', {offset})"


def payload(key: str, value: str) -> str:
    """The whole rejected record, so that it can be published again."""
    return f"coalesce({value}, {key}, '')"


def extra_json(fields: str, known) -> str:
    """Fields outside the contract as JSON text; null when there are none."""
    rest = f"map_filter({fields}, (name, _) -> name not in ({listed(known)}))"
    return (f"case when size({rest}) > 0 "
            f"then to_json({rest}, map('ignoreNullFields', 'false')) end")
