"""Rows that the tests share."""

from __future__ import annotations

import datetime as dt

from dockyard.schema import MESSAGE

SF_SMALL = "/root/testdata/sf0.001"


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def messages(spark, rows: list[dict]):
    """Decoded-message rows (MESSAGE schema) from partial dicts; missing fields are null."""
    names = MESSAGE.fieldNames()
    data = []
    for r in rows:
        r = dict(r)
        if isinstance(r.get("extraction_datetime"), str):
            r["extraction_datetime"] = ts(r["extraction_datetime"])
        data.append(tuple(r.get(n) for n in names))
    return spark.createDataFrame(data, MESSAGE)


def point(pid: str, when: str, bikes=5, ebikes=1, empty=5, docks=10, **kw) -> dict:
    return {"id": pid, "common_name": f"name {pid}", "Installed": "true", "Locked": "false",
            "NbBikes": bikes, "NbEBikes": ebikes, "NbEmptyDocks": empty, "NbDocks": docks,
            "extraction_datetime": when, **kw}
