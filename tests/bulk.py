"""Replays bulk request text on a dict, as a search index would."""

import json
import os


def bulk_replay(spark, path, docs, folder=""):
    """Apply bulk text as an index would, batch by batch."""
    batches = sorted(r[0] for r in spark.read.text(path).select("batch_id").distinct().collect())
    for b in batches:
        at = f"{path}/batch_id={b}/{folder}"
        if not os.path.isdir(at):
            continue
        lines = iter([r[0] for r in spark.read.text(at).collect()])
        for line in lines:
            ((action, target),) = json.loads(line).items()
            if action == "index":
                docs[target["_id"]] = json.loads(next(lines))
            elif action == "update":
                body = json.loads(next(lines))["doc"]
                if target["_id"] in docs:
                    docs[target["_id"]].update(body)
            else:
                docs.pop(target["_id"], None)
    return docs
