"""Declared checks of many tables in one pass: each table is scanned once, all keys meet in one shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Row checks whose outcomes are the bits of one number.
MASK_BITS = 60
WHOLE = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class Declared:
    """What must hold for one table; names of columns, values and conditions.

    ``keys``: no two rows are equal in these columns, NULLs included.  ``unique``: no non-NULL value twice.
    ``references``: column -> (table, key), every non-NULL value is there.  ``true``: name -> condition; unknown passes.
    """

    keys: Sequence[Sequence[str]] = ()
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence] = field(default_factory=dict)
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    true: Mapping[str, Column | str] = field(default_factory=dict)


def _row_checks(declared: Declared, table: str) -> dict[str, Column]:
    """Name of each row check of a table and when a row breaks it."""
    checks = {f"not_null {table}.{c}": F.col(c).isNull() for c in declared.not_null}
    checks |= {f"accepted {table}.{c}": ~F.col(c).isin(*values) for c, values in declared.accepted.items()}
    return checks | {name: ~(F.expr(c) if isinstance(c, str) else c) for name, c in declared.true.items()}


def _is_number(*kinds: str) -> bool:
    """Whether values of these types are equal just when their numbers are; others are compared as text."""
    return all(kind in WHOLE for kind in kinds) or set(kinds) == {"date"}


@dataclass(frozen=True)
class _Key:
    """A key check or one side of a reference: its columns, those that are compared as numbers, whether NULLs count."""

    check: str
    columns: tuple[str, ...]
    numbers: frozenset[str]
    nulls: bool
    parent: bool = False


def _keys_of(table: str, tables: Mapping[str, DataFrame], declared: Mapping[str, Declared]) -> list[_Key]:
    """What a row of the table contributes besides its row checks: its keys, its references, and itself as a parent."""
    kinds = {name: dict(df.dtypes) for name, df in tables.items()}
    own = declared.get(table, Declared())

    def key(check: str, columns: Sequence[str], nulls: bool) -> _Key:
        return _Key(check, tuple(columns), frozenset(c for c in columns if _is_number(kinds[table].get(c, ""))), nulls)

    made = [key(f"grain {table}" if k == 0 else f"grain {table} {k + 1}", columns, True) for k, columns in enumerate(own.keys)]
    made += [key(f"unique {table}.{c}", (c,), False) for c in own.unique]
    for child, other in declared.items():
        for c, (parent, parent_key) in other.references.items():
            number = _is_number(kinds[child].get(c, ""), kinds[parent].get(parent_key, ""))
            for mine, column, is_parent in ((child, c, False), (parent, parent_key, True)):
                if mine == table:
                    made.append(_Key(f"reference {child}.{c}", (column,), frozenset({column} if number else ()), False, is_parent))
    return made


def _key_entry(key: _Key, number: int, kinds: Mapping[str, str], n_numbers: int, n_texts: int) -> Column:
    whole = [F.unix_date(c).cast("bigint") if kinds[c] == "date" else F.col(c).cast("bigint") for c in key.columns if c in key.numbers]
    text = [F.col(c).cast("string") for c in key.columns if c not in key.numbers]
    entry = _entry(number, whole, text, n_numbers, n_texts, key.parent)
    return entry if key.nulls else F.when(F.col(key.columns[0]).isNotNull(), entry)


def _entry(number: int, whole: Sequence[Column], text: Sequence[Column], n_numbers: int, n_texts: int, parent: bool = False) -> Column:
    whole = [*whole, *[F.lit(None).cast("bigint")] * (n_numbers - len(whole))]
    text = [*text, *[F.lit(None).cast("string")] * (n_texts - len(text))]
    return F.struct(F.lit(number).alias("number"), *[v.alias(f"n{i}") for i, v in enumerate(whole)],
                    *[v.alias(f"t{i}") for i, v in enumerate(text)],
                    F.lit(0 if parent else 1).cast("bigint").alias("rows"), F.lit(1 if parent else 0).cast("bigint").alias("parents"))


def check_all(tables: Mapping[str, DataFrame], declared: Mapping[str, Declared]) -> DataFrame:
    """(check, violations): one row for each declared check, zero where it holds.

    Row checks and references count rows, key checks count the keys that occur more than once.  A row opens into the
    outcomes of its row checks, as bits of one number, its keys and its references, which combine before the shuffle: a value
    that very many rows refer to is one entry for each task.  Whole numbers and dates are compared as numbers, all else and
    references between different types as text.
    """
    missing = {p for d in declared.values() for p, _ in d.references.values()} | set(declared)
    if missing - set(tables):
        raise ValueError(f"no such tables: {sorted(missing - set(tables))}")
    keys = {table: _keys_of(table, tables, declared) for table in tables}
    every_key = [key for found in keys.values() for key in found]
    n_numbers = max([1, *[len(key.numbers) for key in every_key]])
    n_texts = max([0, *[len(key.columns) - len(key.numbers) for key in every_key]])
    # Checks by number and, for row checks, by bit.
    checks: list[tuple[str, str, int, int]] = []
    numbers: dict[str, int] = {}
    for key in every_key:
        if key.check not in numbers:
            numbers[key.check] = len(numbers)
            checks.append((key.check, "reference" if key.check.startswith("reference ") else "key", numbers[key.check], 0))
    opened = []
    next_number = len(numbers)
    for table, rows in tables.items():
        kinds = dict(rows.dtypes)
        entries = [_key_entry(key, numbers[key.check], kinds, n_numbers, n_texts) for key in keys[table]]
        broken = list(_row_checks(declared.get(table, Declared()), table).items())
        for start in range(0, len(broken), MASK_BITS):
            some = broken[start:start + MASK_BITS]
            mask = reduce(Column.bitwiseOR, [F.when(when, F.lit(1 << bit).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
                                             for bit, (_, when) in enumerate(some)])
            entries.append(_entry(next_number, [mask], [], n_numbers, n_texts))
            checks += [(name, "row", next_number, bit) for bit, (name, _) in enumerate(some)]
            next_number += 1
        if entries:
            opened.append(rows.select(F.inline(F.array(*entries))).where("number is not null"))
    if not opened:
        raise ValueError("nothing is declared")
    slots = [*[f"n{i}" for i in range(n_numbers)], *[f"t{i}" for i in range(n_texts)]]
    met = reduce(DataFrame.unionByName, opened).groupBy("number", *slots).agg(
        F.sum("rows").alias("rows"), F.sum("parents").alias("parents"))
    mask = F.when(F.col("number") >= len(numbers), F.col("n0")).alias("mask")
    sums = met.groupBy("number", mask).agg(
        F.sum("rows").alias("rows"), F.count_if(F.col("rows") > 1).alias("several"),
        F.sum(F.when(F.col("parents") == 0, F.col("rows"))).alias("orphans"))
    every = opened[0].sparkSession.createDataFrame(checks, "check string, kind string, number int, bit int")
    broken = F.when(F.col("kind") == "row", F.when(F.getbit("mask", F.col("bit")) == 1, F.col("rows"))) \
        .when(F.col("kind") == "key", F.col("several")).otherwise(F.col("orphans"))
    return every.join(sums, "number", "left").groupBy("check").agg(F.coalesce(F.sum(broken), F.lit(0)).alias("violations"))


def counted(violations: Mapping[str, DataFrame]) -> DataFrame:
    """(check, violations) of checks that give their violations as frames."""
    parts = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
             for name, df in violations.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
