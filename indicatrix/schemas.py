"""Table schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()),
}


def table(**kinds: str) -> T.StructType:
    """A schema of ``column="type"``, in the order given."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in kinds.items()])


def _texts(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "string")


EVENT_JSON = table(**_texts("id", "domain", "tld", "event_ts", "source", "producer_ts"))
BRONZE_MALWARE = table(
    **_texts("url", "domain", "threat", "tags", "urlhaus_link", "reporter", "status", "last_online", "dateadded"),
    first_seen="timestamp",
)
BRONZE_PHISH = table(**_texts("url", "domain"), first_seen="timestamp")
SILVER_LABEL = table(**_texts("domain", "url"), first_seen="timestamp", **_texts("label", "source"))
LABELS_UNION = table(
    **_texts("domain", "url"),
    first_seen="timestamp",
    **_texts("label", "source"),
    seen_in_urlhaus="boolean",
    seen_in_openphish="boolean",
)
THREAT_LIST = table(
    **_texts("indicator", "type", "category", "orgc", "event_id"),
    first_seen="timestamp",
    last_seen="timestamp",
    tags="strings",
    galaxies="strings",
    source="string",
)
# The published form of the list: list columns are joined text.
THREAT_LIST_TEXT = T.StructType(
    [f if f.name not in ("tags", "galaxies") else T.StructField(f.name, T.StringType()) for f in THREAT_LIST.fields]
)
GEO = table(
    **_texts("ip", "country", "region", "city"),
    lat="double",
    lon="double",
    **_texts("asn", "asn_name", "isp", "org", "reverse"),
    proxy="boolean",
    hosting="boolean",
)
DNS_GEO = T.StructType(
    [*table(puny_domain="string", ip="string", family="int").fields, *GEO.fields[1:]]
)
WHOIS = table(
    **_texts("domain", "registrar", "status"),
    created="timestamp",
    expires="timestamp",
    **_texts("raw", "error"),
    fetched_at="timestamp",
)
THREAT = table(
    **_texts("domain", "url", "firstSeen", "label", "source"),
    riskScore="double",
    **_texts("riskLevel", "threatType", "country", "registrar"),
    domainAgeDays="int",
)


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``schema`` in its order; missing ones take a default or NULL.

    A default also replaces NULLs. Text that does not cast becomes NULL.
    """
    defaults = defaults or {}
    columns = []
    for field in schema.fields:
        if field.name in df.columns:
            value = F.col(field.name)
            if df.schema[field.name].dataType != field.dataType:
                if isinstance(field.dataType, T.TimestampType) and isinstance(
                    df.schema[field.name].dataType, T.StringType
                ):
                    value = F.try_to_timestamp(value)
                else:
                    value = value.try_cast(field.dataType)
            if field.name in defaults:
                value = F.coalesce(value, defaults[field.name].cast(field.dataType))
        else:
            value = defaults.get(field.name, F.lit(None)).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
