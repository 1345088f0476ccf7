"""SQL literal text: unquoting, typing, and writing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Backslash escapes of dump text and the character each stands for.
ESCAPES = {
    "0": "\0",
    "b": "\b",
    "n": "\n",
    "r": "\r",
    "t": "\t",
    "Z": "\x1a",
}
# Escapes that keep their backslash.
KEPT_ESCAPES = "%_"

# Patterns of the dump grammar.  Possessive quantifiers keep the matcher
# iterative, so literals of many megabytes do not exhaust its stack.
STRING = r"'(?:[^'\\]++|\\.|'')*+'"
FIELD = rf"(?s)((?:{STRING}|[^,']++)++)"
TUPLE = rf"(?s)(\((?:{STRING}|[^()']++)*+\))"
# End of fixed values.

_QUOTED = r"(?s)^(?:_\w+\s*)?'(.*)'$"
_MAX_UINT64 = "18446744073709551615"


def _sql(text: str) -> str:
    """A SQL string literal, every character spelt by its code point."""
    return "'" + "".join(f"\\u{ord(c):04x}" for c in text) + "'"


def _replaced(text: str, pairs: Mapping[str, str]) -> str:
    for found, by in pairs.items():
        text = f"replace({text}, {_sql(found)}, {_sql(by)})"
    return text


_UNDONE = {"''": "'"} | {"\\" + k: v for k, v in {**ESCAPES, "'": "'", '"': '"'}.items()}
_OTHER_ESCAPE = f"{_sql(rf'\\([^{KEPT_ESCAPES}])')}, '$1'"


# The escapes of any text undone.  Pairs of backslashes are taken out first by
# splitting on them, so every backslash left inside a piece starts an escape.
_UNESCAPED = f"""if(contains({{0}}, {_sql(chr(92))}),
  array_join(transform(split({{0}}, {_sql(chr(92) * 4)}, -1),
                       piece -> regexp_replace({_replaced("piece", _UNDONE)}, {_OTHER_ESCAPE})),
             {_sql(chr(92))}),
  {_replaced("{0}", {"''": "'"})})"""


# Stands for a pair of backslashes while the other escapes are undone.
_MARK = "\x01"
_BACKSLASH = _sql("\\")
_STEPS = {
    # Inside of the quotes; _charset'…' prefixes; NULL has no text.
    "body": f"""case when startswith({{0}}, {_sql("'")}) then substr({{0}}, 2, length({{0}}) - 2)
      when startswith({{0}}, '_') then regexp_extract({{0}}, {_sql(_QUOTED)}, 1)
      when upper({{0}}) <> 'NULL' then {{0}} end""",
    # Known escapes undone, backslash pairs turned into the mark.
    "known": f"""case
      when contains({{0}}_body, {_BACKSLASH})
        then {_replaced("{0}_body", {chr(92) * 2: _MARK} | _UNDONE)}
      when contains({{0}}_body, {_sql("'")}) then {_replaced("{0}_body", {"''": "'"})}
      else {{0}}_body end""",
    # Whatever else was escaped stands for itself.
    "rest": f"""if(contains({{0}}_known, {_BACKSLASH}),
      regexp_replace({{0}}_known, {_OTHER_ESCAPE}), {{0}}_known)""",
    "text": f"""case when contains({{0}}_body, {_sql(_MARK)}) then {_UNESCAPED.replace("{0}", "{0}_body")}
      else replace({{0}}_rest, {_sql(_MARK)}, {_BACKSLASH}) end""",
}


def read_literals(rows: DataFrame, literals: Mapping[str, Column]) -> DataFrame:
    """Add, for each name, the literal as ``<name>`` and its text as ``<name>_text``.

    The text is null for NULL, unquoted and unescaped for strings, and the literal
    itself otherwise.  The steps are separate projections on purpose: each value is
    computed once although later steps look at it several times.
    """
    rows = rows.withColumns({n: F.trim(lit) for n, lit in literals.items()})
    for step, sql in _STEPS.items():
        rows = rows.withColumns({f"{n}_{step}": F.expr(sql.format(n)) for n in literals})
    return rows


def literal_value(name: str) -> Column:
    """Value of a literal read by ``read_literals``, as struct(kind, text, number).

    kind is null, int, double, string or error.  Integers beyond 64 bits and
    fixed-point numbers stay text, a negative literal is a double, a byte string
    (hexadecimal) is a double when its bytes parse as one.
    """
    lit, text = F.col(name), F.col(f"{name}_text")
    upper = F.upper(lit)
    quoted = lit.rlike(r"^(?:_\w+\s*)?'")
    digits = lit.rlike(r"^\d+$")
    fits = lit.try_cast("decimal(38,0)") <= F.lit(_MAX_UINT64).cast("decimal(20,0)")
    exponent = lit.rlike(r"^(?:\d+\.?\d*|\.\d+)[eE][+-]?\d+$")
    fixed = lit.rlike(r"^(?:\d+\.\d*|\.\d+)$")
    operand = F.trim(F.substr(lit, F.lit(2)))
    minus, plus = F.startswith(lit, F.lit("-")), F.startswith(lit, F.lit("+"))
    negated = F.concat(F.lit("-"), operand).try_cast("double")
    hexadecimal = lit.rlike(r"^0[xX][0-9a-fA-F]*$")
    octets = F.unhex(F.substr(lit, F.lit(3))).cast("string")
    octet_number = octets.try_cast("double")

    def value(kind: str, text: Column = F.lit(None), number: Column = F.lit(None)) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            text.cast("string").alias("text"),
            number.cast("double").alias("number"),
        )

    return (
        F.when(upper == "NULL", value("null"))
        .when(quoted, value("string", text))
        .when(upper == "TRUE", value("int", F.lit("1"), F.lit(1)))
        .when(upper == "FALSE", value("int", F.lit("0"), F.lit(0)))
        .when(digits & F.coalesce(fits, F.lit(False)), value("int", lit, lit.try_cast("double")))
        .when(digits | fixed, value("string", lit))
        .when(exponent, value("double", lit, lit.try_cast("double")))
        .when(hexadecimal & octet_number.isNotNull(), value("double", octets, octet_number))
        .when(hexadecimal, value("string", octets))
        .when(minus & negated.isNotNull(), value("double", lit, negated))
        .when(minus, value("string", F.concat(F.lit("minus"), operand)))
        .when(plus, value("string", F.concat(F.lit("plus"), operand)))
        .otherwise(value("error", lit))
    )


def typed(name: str, kind: T.DataType) -> Column:
    """A literal read by ``read_literals`` as its column's declared type, not by
    its own shape; null when it does not fit."""
    text = F.col(f"{name}_text")
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BinaryType):
        octets = F.unhex(F.regexp_extract(name, r"^0[xX]([0-9a-fA-F]*)$", 1))
        return F.when(F.col(name).rlike(r"^0[xX]"), octets).otherwise(F.encode(text, "UTF-8"))
    if isinstance(kind, T.BooleanType):
        return F.when(F.lower(text).isin("1", "true"), True).when(
            F.lower(text).isin("0", "false"), False
        )
    return text.try_cast(kind)


_WRITTEN = {"\\": "\\\\"} | {v: "\\" + k for k, v in ESCAPES.items() if k != "b"} | {"'": "\\'"}


def written(name: str, kind: T.DataType) -> Column:
    """The literal a dump writes for a column's value."""
    if isinstance(kind, T.StringType):
        text = f"concat({_sql("'")}, {_replaced(f'`{name}`', _WRITTEN)}, {_sql("'")})"
    elif isinstance(kind, T.BinaryType):
        text = f"concat('0x', hex(`{name}`))"
    elif isinstance(kind, T.BooleanType):
        text = f"if(`{name}`, '1', '0')"
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        text = f"concat({_sql("'")}, cast(`{name}` as string), {_sql("'")})"
    else:
        text = f"cast(`{name}` as string)"
    return F.expr(f"coalesce(if(`{name}` is null, null, {text}), 'NULL')")
