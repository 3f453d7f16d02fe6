"""Event parsing and the event contract, as column expressions made from the contract's rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix import schemas
from indicatrix.functions.times import seconds_between

PARSE_FAILED = "json_parse_failed"

# The contract every domain event has to meet.
EVENT_CONTRACT = {
    "type": "object",
    "required": ["id", "domain", "event_ts", "source", "producer_ts"],
    "properties": {
        "id": {"type": "string", "minLength": 1},
        "domain": {"type": "string", "minLength": 1},
        "tld": {"type": ["string", "null"]},
        "event_ts": {"type": "string", "format": "date-time"},
        "producer_ts": {"type": "string", "format": "date-time"},
        "source": {"type": "string", "minLength": 1},
    },
    "additionalProperties": True,
}


# JSON type names -> how a variant's schema text names them.
VARIANT_KINDS = {"string": "STRING", "null": "VOID", "boolean": "BOOLEAN", "integer": "BIGINT"}


def document(value: Column) -> Column:
    """The text as a variant; NULL where it is no JSON."""
    return F.try_parse_json(F.nullif(F.trim(value), F.lit("")))


def _of_type(kind: Column, wanted: str | list[str]) -> Column:
    """Does a variant's schema text name one of the JSON types?"""
    names = [wanted] if isinstance(wanted, str) else wanted
    simple = [VARIANT_KINDS[n] for n in names if n in VARIANT_KINDS]
    found = kind.isin(*simple) if simple else F.lit(False)
    if "object" in names:
        found = found | F.startswith(kind, F.lit("OBJECT"))
    if "array" in names:
        found = found | F.startswith(kind, F.lit("ARRAY"))
    if "number" in names:
        found = found | kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return found


def _root_is(value: Column, wanted: str | list[str]) -> Column:
    """Type of a whole document by its first character, which is cheap and enough for valid JSON."""
    names = [wanted] if isinstance(wanted, str) else wanted
    marks = {"object": "{", "array": "[", "string": '"', "null": "n", "boolean": "tf", "number": "-0123456789"}
    first = F.substring(F.trim(value), 1, 1)
    return first.isin(*[c for n in names for c in marks["number" if n == "integer" else n]])


def _violation(path: str, message: Column | str) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.concat(F.lit(f"contract_violation:{path}:"), text)


def _type_text(wanted: str | list[str]) -> str:
    names = [wanted] if isinstance(wanted, str) else wanted
    return ", ".join(f"'{n}'" for n in names)


def _reason(value: Column, doc: Column, fields: dict[str, Column], kinds: dict[str, Column], rules: dict) -> Column:
    """The first rule the text breaks, or NULL.

    Rules are tried in the contract's order: root type, required fields, then
    per property its type and its least length. Formats are not asserted.
    """
    checks = [F.when(doc.isNull(), F.lit("json_decode_error:not a JSON document"))]
    is_object = _root_is(value, "object")
    if "type" in rules:
        bad = F.concat(F.to_json(doc), F.lit(f" is not of type {_type_text(rules['type'])}"))
        checks.append(F.when(~_root_is(value, rules["type"]), _violation("<root>", bad)))
    for name in rules.get("required", []):
        missing = is_object & kinds[name].isNull()
        checks.append(F.when(missing, _violation("<root>", f"'{name}' is a required property")))
    for name, rule in rules.get("properties", {}).items():
        if "type" in rule:
            bad = F.concat(F.to_json(fields[name]), F.lit(f" is not of type {_type_text(rule['type'])}"))
            checks.append(F.when(~_of_type(kinds[name], rule["type"]), _violation(name, bad)))
        if "minLength" in rule:
            text = F.try_variant_get(fields[name], "$", "string")
            short = (kinds[name] == "STRING") & (F.length(text) < rule["minLength"])
            message = "'' should be non-empty" if rule["minLength"] == 1 else "is too short"
            checks.append(F.when(short, _violation(name, message)))
    return F.coalesce(*checks)


def _with_event(df: DataFrame, reason: Column) -> DataFrame:
    return df.withColumn("reason", reason).withColumn("event", F.from_json("value", schemas.EVENT_JSON))


def parse(df: DataFrame) -> DataFrame:
    """Add the reason a message cannot be parsed (NULL for JSON objects) and its fields.

    ``from_json`` gives a row of NULLs, not NULL, for broken text, so the split
    rests on the parsed document.
    """
    value = F.col("value")
    good = document(value).isNotNull() & _root_is(value, "object")
    return _with_event(df, F.when(~F.coalesce(good, F.lit(False)), PARSE_FAILED))


def validate(df: DataFrame, contract: dict = EVENT_CONTRACT) -> DataFrame:
    """As ``parse``, but the reason is the first broken contract rule.

    The document, its fields and their types are columns of their own, so each
    is worked out once per row however many rules look at it.
    """
    names = list(dict.fromkeys([*contract.get("required", []), *contract.get("properties", {})]))
    doc, fields = F.col("_doc"), {n: F.col(f"_field_{n}") for n in names}
    kinds = {n: F.col(f"_kind_{n}") for n in names}
    out = (
        df.withColumn("_doc", document(F.col("value")))
        .withColumns({f"_field_{n}": F.try_variant_get(doc, f"$.{n}", "variant") for n in names})
        .withColumns({f"_kind_{n}": F.schema_of_variant(fields[n]) for n in names})
    )
    found = _with_event(out, _reason(F.col("value"), doc, fields, kinds, contract))
    return found.drop("_doc", *[f"_field_{n}" for n in names], *[f"_kind_{n}" for n in names])


def good_events(parsed: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Typed events of the rows without a reason, with their ingest latency."""
    now = F.current_timestamp() if ingest_ts is None else ingest_ts
    carried = [c for c in parsed.columns if c not in ("value", "reason", "event")]
    return (
        parsed.filter(F.col("reason").isNull())
        .select(
            "event.id",
            "event.domain",
            "event.tld",
            F.try_to_timestamp("event.event_ts").alias("event_ts"),
            F.try_to_timestamp("event.producer_ts").alias("producer_ts"),
            "event.source",
            *carried,
            now.alias("ingest_ts"),
        )
        .withColumn("latency_sec", seconds_between(F.col("ingest_ts"), F.col("event_ts")))
    )


def bad_events(parsed: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if ingest_ts is None else ingest_ts
    carried = [c for c in parsed.columns if c not in ("value", "reason", "event")]
    return parsed.filter(F.col("reason").isNotNull()).select("value", "reason", *carried, now.alias("ingest_ts"))
