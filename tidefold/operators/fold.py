"""Ordered keyed fold of change rows into current documents.

Insert replaces the document of a key, update writes an existing document only,
delete removes it.  What a key ends as is decided by two facts: its last change
that is not an update (the boundary) and its last change of any kind.  Both are
maxima, so the fold needs no ordering of the input: it is one aggregation with
map-side partials, it gives the same answer for any arrival order, and folding
folded pieces again, or twice, changes nothing.  That makes replays harmless and
lets a stream keep its state as a growing set of partial folds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.functions.positions import after, file_number, ordered
from tidefold.model import DELETE, INSERT, META, SEQ, UPDATE, Position
from tidefold.operators.ordering import carry_forward


def fold_state(changes: DataFrame, key: Sequence[str], doc: Sequence[str]) -> DataFrame:
    """Partial fold: one row per key with its boundary and its latest change."""
    file_no = F.col("_file_no").alias("file_no")
    is_boundary = F.col("op") != UPDATE
    # The document of a delete is never read again: keep it out of the shuffle.
    document = F.when(F.col("op") != DELETE, F.struct(*doc))
    return _numbered(changes).groupBy(*key).agg(
        F.max(F.when(is_boundary, F.struct(file_no, *META))).alias("boundary"),
        F.max(F.struct(file_no, *META, document.alias("doc"))).alias("latest"),
    )


def _numbered(changes: DataFrame) -> DataFrame:
    """Changes with the number of their log file, made once a row however often it is read."""
    return changes.withColumn("_file_no", file_number())


def combine_states(states: DataFrame, key: Sequence[str]) -> DataFrame:
    """Fold partial folds, in any order and any number of times."""
    return states.groupBy(*key).agg(
        F.max("boundary").alias("boundary"), F.max("latest").alias("latest")
    )


def live_rows(state: DataFrame, key: Sequence[str]) -> DataFrame:
    """Documents of the keys that exist."""
    return state.where(F.col("boundary.op") == INSERT).select(*key, "latest.doc.*")


def apply_changes(changes: DataFrame, key: Sequence[str], doc: Sequence[str]) -> DataFrame:
    """Final table after all inserts, updates and deletes in log order."""
    return live_rows(fold_state(changes, key, doc), key)


def net_actions(state: DataFrame, key: Sequence[str]) -> DataFrame:
    """One action per key with the same effect as its changes in order.

    A boundary insert makes the key's last document an insert; a boundary delete
    makes the key's end a delete, since later updates hit nothing; with updates
    only, the last one is an update of whatever the target holds.
    """
    op = F.coalesce("boundary.op", F.lit(UPDATE))
    return state.select(
        *key,
        *[F.col(f"latest.{c}").alias(c) for c in SEQ],
        op.alias("op"),
        F.when(op != DELETE, F.col("latest.doc")).alias("doc"),
    )


def apply_insert(inserts: DataFrame, key: Sequence[str], doc: Sequence[str]) -> DataFrame:
    """Upsert-replace: the last inserted document of each key."""
    last = F.max(ordered(*SEQ, F.struct(*doc).alias("doc"))).alias("last")
    return inserts.where(F.col("op") == INSERT).groupBy(*key).agg(last).select(*key, "last.doc.*")


def apply_update(
    target: DataFrame, updates: DataFrame, key: Sequence[str], doc: Sequence[str]
) -> DataFrame:
    """The target with the last after-image of each key that exists in it.

    Updates are reduced to one per key before the join, so a hot key joins once.
    """
    last = F.max(ordered(*SEQ, F.struct(*doc).alias("doc")))["doc"].alias("new")
    newest = updates.where(F.col("op") == UPDATE).groupBy(*key).agg(last)
    written = [
        F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(c)).alias(c)
        for c in doc
    ]
    others = [c for c in target.columns if c not in key and c not in doc]
    return target.join(newest, list(key), "left").select(*key, *written, *others)


def apply_delete(target: DataFrame, deletes: DataFrame, key: Sequence[str]) -> DataFrame:
    """The target without the deleted keys; absent keys do not matter."""
    gone = deletes.where(F.col("op") == DELETE).select(*key).distinct()
    return target.join(gone, list(key), "left_anti")


def merge_state(changes: DataFrame, key: Sequence[str], doc: Sequence[str]) -> DataFrame:
    """Partial fold for changes that carry only some columns.

    ``present`` lists the columns a change carries; a present null counts.  Each
    column keeps its own last value, so there is no join back to the changes.
    """
    file_no = F.col("_file_no").alias("file_no")
    written = F.col("op") != DELETE
    per_column = [
        F.max(
            F.when(
                written & F.array_contains("present", c),
                F.struct(F.struct(file_no, *SEQ).alias("seq"), F.col(c).alias("v")),
            )
        ).alias(c)
        for c in doc
    ]
    is_boundary = F.col("op") != UPDATE
    return _numbered(changes).groupBy(*key).agg(
        F.max(F.when(is_boundary, F.struct(F.struct(file_no, *SEQ).alias("seq"), "op"))).alias("boundary"),
        *per_column,
    )


def combine_merge_states(states: DataFrame, key: Sequence[str], doc: Sequence[str]) -> DataFrame:
    return states.groupBy(*key).agg(*[F.max(c).alias(c) for c in ("boundary", *doc)])


def merged_rows(state: DataFrame, key: Sequence[str], doc: Sequence[str]) -> DataFrame:
    """Documents of the live keys.  A value older than the boundary was replaced
    away.  ``present`` lists the fields the document has."""
    current = {c: F.col(f"{c}.seq") >= F.col("boundary.seq") for c in doc}
    return state.where(F.col("boundary.op") == INSERT).select(
        *key,
        *[F.when(current[c], F.col(f"{c}.v")).alias(c) for c in doc],
        F.array_compact(F.array(*[F.when(current[c], c) for c in doc])).alias("present"),
    )


def merged_actions(state: DataFrame, key: Sequence[str], doc: Sequence[str]) -> DataFrame:
    """As ``net_actions``, for partial documents: ``present`` lists the fields an
    insert or update carries, with their values in columns of their own."""
    op = F.coalesce("boundary.op", F.lit(UPDATE))
    since = F.col("boundary.seq")
    carried = {
        c: (op != DELETE) & F.col(c).isNotNull() & (since.isNull() | (F.col(f"{c}.seq") >= since))
        for c in doc
    }
    return state.select(
        *key,
        op.alias("op"),
        *[F.when(carried[c], F.col(f"{c}.v")).alias(c) for c in doc],
        F.array_compact(F.array(*[F.when(carried[c], c) for c in doc])).alias("present"),
    )


def merge_changes(changes: DataFrame, key: Sequence[str], doc: Sequence[str]) -> DataFrame:
    """As ``apply_changes``, for changes with partial documents."""
    return merged_rows(merge_state(changes, key, doc), key, doc)


def dropped_updates(
    changes: DataFrame, key: Sequence[str], bucket_bytes: int = 1 << 26
) -> DataFrame:
    """Updates that hit a key which does not exist at that moment.

    The last insert or delete before an update is carried along the key, in parts
    of ``bucket_bytes`` of each log file, so a key that holds a third of all
    changes is spread over many tasks, in one large log file too.
    """
    seen = carry_forward(
        changes,
        value=F.when(F.col("op") != UPDATE, F.col("op")),
        into="_before",
        order=SEQ,
        bucket=F.floor(F.col("logpos") / F.lit(bucket_bytes)),
        block=F.struct(file_number(), "logfile"),
        keys=key,
        inclusive=False,
    )
    missed = F.coalesce(F.col("_before"), F.lit(DELETE)) == DELETE
    return seen.where((F.col("op") == UPDATE) & missed).drop("_before")


def snapshot_plus_log(
    snapshot: DataFrame,
    log: DataFrame,
    taken_at: Position,
    key: Sequence[str],
    doc: Sequence[str],
) -> DataFrame:
    """The snapshot with the log after its position folded onto it.

    Changes at or before the position are already in the snapshot; the bound
    prunes the log's folders.  The log is folded to one action a key, and only
    those are joined: a snapshot kept with ``save_bucketed`` is not moved, nor is
    any snapshot when the actions are few enough to broadcast.  Keys are unique in
    the snapshot.
    """
    key = list(key)
    later = fold_state(log.where(after(taken_at)), key, doc)
    actions = net_actions(later, key).select(*key, F.col("op").alias("_op"), F.col("doc").alias("_doc"))
    rows = snapshot.select(*key, *doc)
    kept = rows.join(actions, key, "left").where(F.col("_op").isNull() | (F.col("_op") != DELETE))
    written = [F.when(F.col("_op").isNotNull(), F.col(f"_doc.{c}")).otherwise(F.col(c)).alias(c) for c in doc]
    held = rows.select(*key).join(actions.select(*key), key, "left_semi")
    new = actions.where(F.col("_op") == INSERT).join(held, key, "left_anti")
    return kept.select(*key, *written).unionByName(new.select(*key, "_doc.*"))
