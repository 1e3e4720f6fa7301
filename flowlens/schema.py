"""Field names and types of flow records, on the wire and in tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# The 23 columns of a raw connection record, in file order.
RAW_COLUMNS = [
    "ts", "uid", "id.orig_h", "id.orig_p", "id.resp_h", "id.resp_p", "proto", "service",
    "duration", "orig_bytes", "resp_bytes", "conn_state", "local_orig", "local_resp",
    "missed_bytes", "history", "orig_pkts", "orig_ip_bytes", "resp_pkts", "resp_ip_bytes",
    "tunnel_parents", "label", "detailed-label",
]

# Every raw column is read as text; `clean` does the typing, so no inference pass is needed.
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# Fields decoded from a message, by their name on the wire. Counters stay text
# because a missing one is written as "-".
WIRE_TYPES = {
    "uid": T.StringType(),
    "ts": T.DoubleType(),
    "id.orig_h": T.StringType(),
    "id.orig_p": T.DoubleType(),
    "id.resp_h": T.StringType(),
    "id.resp_p": T.DoubleType(),
    "proto": T.StringType(),
    "duration": T.StringType(),
    "orig_bytes": T.StringType(),
    "resp_bytes": T.StringType(),
    "conn_state": T.StringType(),
    "label": T.StringType(),
    "detailed-label": T.StringType(),
}

# Names with dots or hyphens are replaced once, on reading.
TABLE_NAMES = {
    "id.orig_h": "orig_h",
    "id.orig_p": "orig_p",
    "id.resp_h": "resp_h",
    "id.resp_p": "resp_p",
    "detailed-label": "detailed_label",
}
WIRE_NAMES = {table: wire for wire, table in TABLE_NAMES.items()}

# Names under which a stored prediction keeps its addresses.
STORED_NAMES = {
    "orig_h": "id_orig_h",
    "orig_p": "id_orig_p",
    "resp_h": "id_resp_h",
    "resp_p": "id_resp_p",
}

CORRUPT = "_corrupt_record"
MEASURES = ["duration", "orig_bytes", "resp_bytes"]
BENIGN, MALICIOUS, UNKNOWN = "Benign", "Malicious", "Unknown"


def wire_schema(fields: Iterable[str] | None = None, corrupt: bool = False) -> T.StructType:
    """JSON schema of a message, limited to ``fields`` (table names) when given."""
    wanted = None if fields is None else {WIRE_NAMES.get(f, f) for f in fields}
    if wanted is not None and wanted - WIRE_TYPES.keys():
        raise ValueError(f"unknown fields: {sorted(wanted - WIRE_TYPES.keys())}")
    schema = T.StructType(
        [
            T.StructField(name, kind)
            for name, kind in WIRE_TYPES.items()
            if wanted is None or name in wanted
        ]
    )
    return schema.add(CORRUPT, T.StringType()) if corrupt else schema
