"""Run the job: ``spark-submit … -m tidefold config.json`` or ``python -m tidefold``.

The configuration is a JSON object:

    {"schema": "world", "log": "<folder of row events>", "log_format": "json",
     "target": "<shared folder>", "dumps": {"city": "<folder of its dump>"},
     "sinks": {"bulk_text": "<folder>", "log": "<folder>"}, "active_sinks": ["bulk_text"],
     "dead_letters": "<folder>", "most_broken": 100, "available_now": false,
     "interval": "1 second", "bytes_per_trigger": 1073741824}

``sinks`` says where each kind of sink writes: ``bulk_text`` is bulk request text for a
search index, ``log`` every change as it came.  ``active_sinks`` names those that are used,
all if it is left out; a name that is not there is an error.  ``dead_letters`` keeps batches a
sink failed on; without it they are repeated.  ``interval`` and ``bytes_per_trigger`` say how
often the log is looked at and how much one batch takes.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Mapping, Sequence

from tidefold.model import Followed
from tidefold.plans.sync import SyncConfig, fan_out, follow, load
from tidefold.session import build_session
from tidefold.sinks.fanout import Sink, activate
from tidefold.sinks.writers import TablesBulkSink, TablesLogSink

KINDS = {
    "bulk_text": lambda path, tables: TablesBulkSink(path, tables),
    "log": lambda path, tables: TablesLogSink(path),
}


def configured(given: Mapping) -> SyncConfig:
    """The job's settings, from the JSON object."""
    places = given.get("sinks", {})
    unknown = sorted(set(places) - set(KINDS))
    if unknown:
        raise ValueError(f"unknown kinds of sinks: {unknown} (there are {sorted(KINDS)})")
    names = given.get("active_sinks", list(places))
    activate(places, names)  # a wrong name is found before anything is loaded

    def sinks(tables: Sequence[Followed]) -> Mapping[str, Sink]:
        return activate({n: KINDS[n](path, tables) for n, path in places.items()}, names)

    options = ("log_format", "dead_letters", "most_broken", "split_bytes", "buckets", "compact_every", "keep_seconds")
    return SyncConfig(
        schema=given["schema"],
        dumps=given["dumps"],
        log=given["log"],
        target=given["target"],
        sinks=sinks,
        **{k: given[k] for k in options if k in given},
    )


def main(path: str) -> None:
    with open(path) as file:
        given = json.load(file)
    config = configured(given)
    spark = build_session()
    tables = load(spark, config)
    sinks = fan_out(config, tables)
    options = {k: given[k] for k in ("interval", "bytes_per_trigger") if k in given}
    try:
        follow(
            spark, config, tables, given.get("available_now", False), sinks=sinks, **options
        ).awaitTermination()
    finally:
        sinks.close()


if __name__ == "__main__":
    main(sys.argv[1])
