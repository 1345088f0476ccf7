"""Cheapest repair of conversations, over a grammar that all of them share.

A conversation is a sequence of symbols: the class of each row's role and what is wrong
with the row.  Re-Pair finds the pairs of symbols that are frequent over all conversations
and names them, pairs of names included.  Each symbol has a min-plus matrix between the
states of the pattern ``(s?(ua)+)?``: the least cost of the edits that take the pattern
from one state to another over the rows the symbol stands for, and those edits as a rope.
The matrix of a rule is the product of its two parts' matrices, made once, bottom up, for
all conversations; a conversation's repair is the product of what is left of its sequence.

Of edits of equal cost between two states over the same rows, none is the beginning of
another (each edit but an insert takes up one row, and an insert costs), so the least text
of a product is made of least texts of its parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import small_slices, stored
from tidefold.llm.turns import in_order

# Costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# End of fixed values.

CLASSES = "suao"  # system, user, assistant, any other
GOOD, CUT_OFF, UNFIT = range(3)
TERMINALS = [(c, f) for c in CLASSES for f in (GOOD, CUT_OFF, UNFIT)]
#: States of the pattern: nothing yet, after a system turn, after a user's, after a reply.
START, SYSTEM, USER, REPLY = range(4)
STATES = range(4)
ENDS = (START, REPLY)
#: Where an inserted or re-roled turn leads, and its role.
NEXT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (REPLY, "assistant"), REPLY: (USER, "user")}
KEEPS = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("a", USER): REPLY, ("u", REPLY): USER}

#: Rounds of Re-Pair, and rules made in each.
ROUNDS, RULES = 6, 8


class Rope:
    """A text made of two shared parts, put together when it is asked for."""

    __slots__ = ("left", "right", "flat")

    def __init__(self, left, right):
        self.left, self.right, self.flat = left, right, None

    def __str__(self) -> str:
        if self.flat is None:
            out, todo = [], [self.right, self.left]
            while todo:
                part = todo.pop()
                text = part if isinstance(part, str) else part.flat
                if text is None:
                    todo += [part.right, part.left]
                else:
                    out.append(text)
            self.flat = "".join(out)
        return self.flat


#: (cost, edits) by state the pattern is in.
Row = dict[int, tuple[int, object]]
Matrix = dict[int, Row]


def better(new: tuple[int, object], old: tuple[int, object] | None) -> bool:
    if old is None or new[0] != old[0]:
        return old is None or new[0] < old[0]
    return str(new[1]) < str(old[1])


def advance(row: Row, matrix: Matrix) -> Row:
    """The best way into each state by a row of ways and then a matrix."""
    out: Row = {}
    for middle, (cost, edits) in row.items():
        for to, (more, rest) in matrix[middle].items():
            way = (cost + more, Rope(edits, rest))
            if better(way, out.get(to)):
                out[to] = way
    return out


def product(first: Matrix, second: Matrix) -> Matrix:
    return {state: advance(row, second) for state, row in first.items()}


def inserts() -> Matrix:
    """Any number of inserts: from a state the way round is never of use."""
    out: Matrix = {}
    for state in STATES:
        out[state], at, edits = {}, state, ""
        while at not in out[state]:
            out[state][at] = (INSERT * len(edits), edits)
            at, edits = NEXT[at][0], edits + "I"
    return out


def terminal(role: str, fault: int) -> Matrix:
    """Inserts, then one row kept, re-roled or deleted."""
    edit: Matrix = {}
    late = TRUNCATED if fault == CUT_OFF else 0
    for state in STATES:
        ways = [(state, (DELETE, "D"))]
        if fault != UNFIT:
            ways.append((NEXT[state][0], (REROLE + late, "R")))
            if (role, state) in KEEPS:
                ways.append((KEEPS[role, state], (late, "K")))
        edit[state] = {}
        for to, way in ways:
            if better(way, edit[state].get(to)):
                edit[state][to] = way
    return product(inserts(), edit)


@dataclass
class Grammar:
    """Rules name -> (first, second) in the order they were made, and a matrix a symbol."""

    rules: dict[str, tuple[str, str]] = field(default_factory=dict)
    matrices: dict[str, Matrix] = field(default_factory=dict)
    #: (first class, last class, pairs of neighbours that are not legal) of each symbol.
    pairs: dict[str, tuple[str, str, int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for (role, fault), name in symbols().items():
            self.matrices[name] = terminal(role, fault)
            self.pairs[name] = (role, role, 0)
        for name, (a, b) in self.rules.items():
            self.matrices[name] = product(self.matrices[a], self.matrices[b])
            (first, end, n), (begin, last, m) = self.pairs[a], self.pairs[b]
            self.pairs[name] = (first, last, n + m + unlawful(end, begin))


def replaced(text: Column, rules: Mapping[str, tuple[str, str]]) -> Column:
    for name, (a, b) in rules.items():
        text = F.replace(text, F.lit(a + b), F.lit(name))
    return text


def symbols() -> dict[tuple[str, int], str]:
    return {t: chr(ord("a") + k) for k, t in enumerate(TERMINALS)}


def unlawful(before: str, after: str) -> int:
    return int(before + after not in ("su", "ua", "au"))


def re_pair(sequences: DataFrame, rounds: int = ROUNDS, rules: int = RULES, least: int = 4) -> Grammar:
    """Rules for the most frequent pairs of the column ``symbols``, over all its rows.

    Each round counts all pairs and names up to ``rules`` of those seen ``least`` times
    that share no symbol, so their order does not matter.  The bounds keep the grammar
    small; what it leaves uncompressed is right all the same.
    """
    left = stored(sequences.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "repair-sequences")
    made: dict[str, tuple[str, str]] = {}
    for _ in range(rounds):
        at = F.sequence(F.lit(1), F.length("symbols") - 1)
        pair = F.explode(F.transform(at, lambda i: F.substr("symbols", i, F.lit(2))))
        counted = left.where(F.length("symbols") > 1).select(pair.alias("pair"), "n")
        often = counted.groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        used: set[str] = set()
        fresh = {}
        for r in often.orderBy(F.desc("n"), "pair").limit(rules * 8).collect():
            if len(fresh) < rules and not used & set(r["pair"]):
                fresh[chr(0x100 + len(made) + len(fresh))] = (r["pair"][0], r["pair"][1])
                used |= set(r["pair"])
        if not fresh:
            break
        made |= fresh
        left = left.withColumn("symbols", replaced(F.col("symbols"), fresh))
    return Grammar(made)


def cheapest(grammar: Grammar, chunks: list[str]) -> tuple[int, str, int]:
    """(cost, edits, illegal neighbours) of one conversation, given in chunks.

    A chunk's ways are put together from each state it can begin in, so the edits of all
    chunks before it are only compared once a chunk.
    """
    ways: Row = {START: (0, "")}
    illegal, end = 0, None
    for chunk in chunks:
        through: Matrix = {state: {state: (0, "")} for state in ways}
        for symbol in chunk:
            through = product(through, grammar.matrices[symbol])
            first, last, inside = grammar.pairs[symbol]
            illegal += inside + (end is not None and unlawful(end, first))
            end = last
        through = {a: {b: (c, str(e)) for b, (c, e) in row.items()} for a, row in through.items()}
        ways = {state: (c, str(e)) for state, (c, e) in advance(ways, through).items()}
    best = None
    for state, way in advance(ways, inserts()).items():
        if state in ENDS and better(way, best):
            best = way
    return best[0], str(best[1]), illegal


def role_class(role: str) -> str:
    return role[0] if role and role[0] in "sua" else "o"


class Edited:
    """Puts the edits of one conversation into effect, row by row."""

    def __init__(self, edits: str):
        self.edits, self.at, self.state = edits, 0, START

    def _made(self) -> str:
        self.state, role = NEXT[self.state]
        return role

    def _inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            yield self._made(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """The turns that stand for a row: inserted ones, and the row if it stays."""
        yield from self._inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEEPS[role_class(role), self.state]
            yield role, text
        elif edit == "R":
            yield self._made(), text

    def rest(self) -> Iterator[tuple[str, str]]:
        yield from self._inserted()


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (see ``in_order``) without texts, with ``fault``: blank, duplicate, truncated.

    A duplicate is a row whose role and text an earlier row of the conversation has.  The
    first place of each (conversation, role, text) is a minimum, made on the map side first.
    """
    body = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    told = rows.select(
        F.struct("conv_id").alias("c"), "turn", "ord", "chunk", "role",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (body == "").alias("blank"),
        (~F.substr(body, F.length(body), F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    firsts = (
        told.groupBy("c", "role", "digest")
        .agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    seen = told.join(firsts, ["c", "role", "digest"], "left")
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("ord") > F.col("first"), "duplicate")
        .when(F.col("cut"), "truncated")
    )
    return seen.select("c", "turn", "ord", "chunk", "role", fault.alias("fault"))


def sequences(told: DataFrame) -> DataFrame:
    """(c, chunk, symbols): the symbols of each chunk of a conversation, at most CHUNK."""
    initial = F.substr("role", F.lit(1), F.lit(1))
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    state = F.when(F.col("fault").isNull(), GOOD).when(F.col("fault") == "truncated", CUT_OFF).otherwise(UNFIT)
    names = F.create_map(*[F.lit(x) for (c, f), name in symbols().items() for x in (f"{c}{f}", name)])
    symbol = F.element_at(names, F.concat(kind, state.cast("string")))
    gathered = F.array_sort(F.collect_list(F.struct("ord", symbol.alias("symbol"))))
    return told.groupBy("c", "chunk").agg(
        F.array_join(F.transform(gathered, lambda x: x["symbol"]), "").alias("symbols")
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows harmed by the checksum of ``conv_id:turn``.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 takes its ends of sentences,
    3 repeats it and 4 makes it a user's.  Nulls count as one blank.
    """
    blank = F.lit(" ")
    mark = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id", "turn",
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        (F.crc32(mark.cast("binary")) % 20).alias("h"),
    )
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", ""))
    copies = F.when(F.col("h") == 0, 0).when(F.col("h") == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


@dataclass(frozen=True)
class Repair:
    """What ``repair`` finds; both tables have one row a conversation that has rows."""

    faults: DataFrame
    result: DataFrame


def repair(rows: DataFrame, turns: bool = False) -> Repair:
    """Faults and cheapest repairs of the conversations in ``rows`` (conv_id, turn, role, text).

    Rows stand by turn, nulls first; ties by role, then text.  Null roles and texts count as
    one blank, and rows without conv_id are one conversation.  ``result`` holds (conv_id,
    cost, audit, illegal, repaired_sha256), or with ``turns`` the repaired turns themselves:
    (conv_id, position, role, text, audit), conversations that end empty having none.  Long
    texts are read one by one; repeated rows are duplicates.  An empty table gives no rows.
    """
    blank = F.lit(" ")
    plain = rows.select(
        "conv_id", "turn",
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
    )
    table = in_order(plain, "repair-rows")
    told = faults(table)
    pieces = stored(sequences(told), "repair-symbols")
    grammar = re_pair(pieces)
    # A conversation's symbols come before its rows, in one sorted stream.
    stream = pieces.select(
        F.col("c.conv_id").alias("conv_id"), F.lit(0).alias("kind"), F.col("chunk").alias("ord"),
        F.lit("").alias("role"), replaced(F.col("symbols"), grammar.rules).alias("text"),
    ).unionByName(table.select("conv_id", F.lit(1).alias("kind"), "ord", "role", "text"))
    dealt = stream.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "ord")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = _Turns() if turns else _Digest()
        for batch in small_slices(batches, 4):
            for conv, is_row, _, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                whole.begin(conv, grammar)
                if is_row:
                    whole.row(role, text)
                else:
                    whole.chunks.append(text)
            if whole.out:
                yield whole.taken(batch.schema.field(0).type)
        whole.end()
        if whole.out:
            yield whole.taken(batch.schema.field(0).type)

    columns = _Turns.COLUMNS if turns else _Digest.COLUMNS
    return Repair(told, dealt.mapInArrow(run, f"conv_id {kind}, {columns}"))


class _Stream:
    """One conversation after the other: symbols first, then rows."""

    TYPES: dict[str, pa.DataType] = {}

    def __init__(self):
        self.started, self.out = False, []

    def begin(self, conv, grammar: Grammar) -> None:
        if self.started and conv == self.conv:
            return
        self.end()
        self.started, self.conv, self.grammar = True, conv, grammar
        self.chunks, self.edited = [], None

    def row(self, role: str, text: str) -> None:
        if self.edited is None:
            self.cost, self.audit, self.illegal = cheapest(self.grammar, self.chunks)
            self.edited = Edited(self.audit)
            self.open()
        for turn in self.edited.row(role, text):
            self.add(*turn)

    def end(self) -> None:
        if self.started:
            for turn in self.edited.rest():
                self.add(*turn)
            self.close()

    def taken(self, key: pa.DataType) -> pa.RecordBatch:
        columns, self.out = list(zip(*self.out)), []
        types = [key, *self.TYPES.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", *self.TYPES]
        )


class _Digest(_Stream):
    COLUMNS = "cost bigint, audit string, illegal bigint, repaired_sha256 string"
    TYPES = {"cost": pa.int64(), "audit": pa.string(), "illegal": pa.int64(), "repaired_sha256": pa.string()}

    def open(self) -> None:
        self.digest, self.mark = hashlib.sha256(), ""

    def add(self, role: str, text: str) -> None:
        self.digest.update(f"{self.mark}{role}:{text}".encode())
        self.mark = "\n"

    def close(self) -> None:
        self.out.append((self.conv, self.cost, self.audit, self.illegal, self.digest.hexdigest()))


class _Turns(_Stream):
    COLUMNS = "position bigint, role string, text string, audit string"
    TYPES = {"position": pa.int64(), "role": pa.string(), "text": pa.string(), "audit": pa.string()}

    def open(self) -> None:
        self.n = 0

    def add(self, role: str, text: str) -> None:
        # The edits stand on the first turn only.
        self.out.append((self.conv, self.n, role, text, None if self.n else self.audit))
        self.n += 1

    def close(self) -> None:
        pass


def op11_repair(spark, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = repair(damaged(given))
    kinds = ("blank", "duplicate", "truncated")
    per_turn = found.faults.groupBy("c", "turn").agg(
        *[F.count(F.when(F.col("fault") == k, 1)).alias(k) for k in kinds]
    )
    spread = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counts = per_turn.groupBy("c").agg(
        F.coalesce(spread, F.lit(0)).cast("long").alias("gaps"), *[F.sum(k).alias(k) for k in kinds]
    )
    every = given.select(F.struct("conv_id").alias("c")).distinct()
    result = found.result.select(F.struct("conv_id").alias("c"), "cost", "audit", "illegal", "repaired_sha256")
    zero = [F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in ("gaps", *kinds, "illegal", "cost")]
    return every.join(counts, "c", "left").join(result, "c", "left").select(
        "c.conv_id",
        *zero,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
