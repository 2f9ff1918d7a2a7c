"""Constraint checks of the model (K4-K7).

``violations`` returns one row per check - table, rule, column, number of
offending rows or keys - including the checks that pass (n = 0), so it is a
report of the whole model.  Each check is an aggregate (one scan per table for
all its not-null and length checks, an anti join per foreign key, a grouped
count per unique key); nothing is collected except by ``assert_valid``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrace.schema import FOREIGN_KEYS, ID_COLUMN, INSERT_KEY, LENGTH_LIMITS, MODEL_SCHEMAS

# Keys of more text than this are compared by a digest.
KEY_BYTES = 128
# Keys grouped at once by a task of a unique check; half as many of text.
ROWS_PER_TASK = 2_000_000
RESULT_COLUMNS = ["table_name", "rule", "column_name", "n"]


class ModelError(ValueError):
    """The model breaks one of its constraints."""


def _row(table: str, rule: str, column: str, n):
    return [F.lit(table).alias("table_name"), F.lit(rule).alias("rule"),
            F.lit(column).alias("column_name"), n.cast("long").alias("n")]


def column_checks(table: str, df: DataFrame) -> DataFrame:
    """K4 not-null and K7 length checks of one table, in one pass."""
    checks = []
    for field in MODEL_SCHEMAS[table].fields:
        if not field.nullable:
            checks.append(("not_null", field.name, F.count_if(F.col(field.name).isNull())))
        limit = LENGTH_LIMITS.get((table, field.name))
        if limit is not None:
            checks.append(("max_length", field.name,
                           F.count_if(F.octet_length(field.name) > F.lit(limit))))
    counts = df.agg(*[c.alias(f"c{i}") for i, (_, _, c) in enumerate(checks)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(col).alias("column_name"),
                 F.col(f"c{i}").alias("n"))
        for i, (rule, col, _) in enumerate(checks)]))
    return (counts.select(stacked.alias("s"))
            .select(F.lit(table).alias("table_name"), "s.rule", "s.column_name",
                    F.col("s.n").cast("long").alias("n")))


def short_key(df: DataFrame, cols: list[str]) -> list[Column]:
    """``cols`` as grouping columns whose rows stay small: keys of more than
    ``KEY_BYTES`` bytes of text go by the SHA-256 of their columns, each with its
    length before it, so equal keys and only they fall together."""
    texts = [f.name for f in df.select(*cols).schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return [F.col(c) for c in cols]
    size = sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in texts)
    whole = F.concat(*[F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"),
                                           F.col(c).cast("string")), F.lit("-")) for c in cols])
    return [F.when(size > KEY_BYTES, F.unhex(F.sha2(whole, 256))).alias("__digest"),
            *[F.when(size <= KEY_BYTES, F.col(c)).alias(c) for c in cols]]


def passes(df: DataFrame, rows: int) -> int:
    """In how many passes ``df`` is grouped so that no task of its scan groups
    more than about ``rows`` rows at once."""
    largest = (df.select(F.spark_partition_id().alias("task")).groupBy("task").count()
               .agg(F.max("count")).first()[0] or 0)
    return max(1, -(-largest // rows))


def unique_check(table: str, df: DataFrame, cols: list[str], rule: str) -> DataFrame:
    """K5: number of key values held by more than one row.  Packed tables give a
    task tens of millions of rows, and their keys hardly repeat: they are grouped
    in passes by their hash, so that a task's groups fit its memory."""
    texts = any(isinstance(f.dataType, T.StringType) for f in df.select(*cols).schema.fields)
    n = passes(df, ROWS_PER_TASK // 2 if texts else ROWS_PER_TASK)
    turn = F.pmod(F.xxhash64(*cols), F.lit(n))
    dup = reduce(DataFrame.unionByName, [
        (df if n == 1 else df.where(turn == i)).groupBy(*short_key(df, cols))
        .agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1).select("k") for i in range(n)])
    return dup.agg(*_row(table, rule, ",".join(cols), F.count(F.lit(1))))


def foreign_key_orphans(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child keys without a parent row and the number ``n`` of their rows (NULL
    keys are K4's job).  Rows are counted per key first, so a key that many
    neighbouring rows hold is shuffled once per task."""
    return (child.select(F.col(col).alias("k")).where(F.col("k").isNotNull())
            .groupBy("k").agg(F.count(F.lit(1)).alias("n"))
            .join(parent.select(F.col(parent_col).alias("k")), "k", "left_anti"))


def foreign_key_check_of(child_name: str, col: str, orphans: DataFrame) -> DataFrame:
    return orphans.agg(*_row(child_name, "foreign_key", col, F.coalesce(F.sum("n"), F.lit(0))))


def foreign_key_check(child_name: str, child: DataFrame, col: str,
                      parent: DataFrame, parent_col: str) -> DataFrame:
    """K6: child rows whose key has no parent row."""
    return foreign_key_check_of(child_name, col, foreign_key_orphans(child, col, parent, parent_col))


def violations(model) -> DataFrame:
    """All constraint checks of the model, one row each."""
    tables = model.tables()
    parts = []
    for name, df in tables.items():
        parts.append(column_checks(name, df))
        parts.append(unique_check(name, df, [ID_COLUMN[name]], "primary_key"))
    for name in ("associate", "person", "facility", "treatment"):
        parts.append(unique_check(name, tables[name], INSERT_KEY[name], "natural_key"))
    for child, col, parent, parent_col in FOREIGN_KEYS:
        parts.append(foreign_key_check(child, tables[child], col, tables[parent], parent_col))
    return reduce(DataFrame.unionByName, parts)


def append_violations(fresh: dict[str, DataFrame], existing: dict[str, DataFrame]) -> DataFrame:
    """The checks of ``violations`` for the rows ``fresh`` that are to be added
    to ``existing``, a valid model: the same rows as a check of the union gives,
    but stored rows are only read for their keys.

    A key breaks when new rows repeat it among themselves or a stored row has
    it; a new child needs a parent among the stored or the new ones.  The
    natural keys of stored rows may repeat (see ``assert_valid``), so those
    that already did are counted with the new ones.
    """
    def repeated(table: str, columns: list[str], rule: str) -> DataFrame:
        old = existing[table].select(*columns)
        new = fresh[table].groupBy(*columns).agg(F.count(F.lit(1)).alias("k"))
        taken = new.join(old, columns, "left_semi")
        alone = new.where("k > 1").join(old, columns, "left_anti")
        broken = taken.unionByName(alone).agg(*_row(table, rule, ",".join(columns), F.count(F.lit(1))))
        if rule == "primary_key":
            return broken
        # stored keys that repeat and gain no new row
        known = (old.groupBy(*columns).agg(F.count(F.lit(1)).alias("k")).where("k > 1")
                 .join(new.select(*columns), columns, "left_anti"))
        return (broken.unionByName(known.agg(*_row(table, rule, ",".join(columns), F.count(F.lit(1)))))
                .groupBy("table_name", "rule", "column_name").agg(F.sum("n").alias("n")))

    parts = []
    for name, df in fresh.items():
        parts.append(column_checks(name, df))
        parts.append(repeated(name, [ID_COLUMN[name]], "primary_key"))
    for name in ("associate", "person", "facility", "treatment"):
        parts.append(repeated(name, INSERT_KEY[name], "natural_key"))
    for child, col, parent, parent_col in FOREIGN_KEYS:
        orphans = foreign_key_orphans(fresh[child], col, fresh[parent], parent_col)
        parts.append(foreign_key_check_of(child, col, orphans.join(
            existing[parent].select(F.col(parent_col).alias("k")), "k", "left_anti")))
    return reduce(DataFrame.unionByName, parts)


def _raise_if_broken(checks: DataFrame, ignore_rules: tuple[str, ...]) -> None:
    bad = checks.where((F.col("n") > 0) & ~F.col("rule").isin(*ignore_rules)).collect()
    if bad:
        raise ModelError("model constraint violations: " + "; ".join(
            f"{r.table_name}.{r.column_name} {r.rule} x{r.n}" for r in bad))


def assert_valid_append(fresh: dict[str, DataFrame], existing: dict[str, DataFrame],
                        ignore_rules: tuple[str, ...] = ("natural_key",)) -> None:
    """Raise ``ModelError`` when adding ``fresh`` would break a check."""
    _raise_if_broken(append_violations(fresh, existing), ignore_rules)


def assert_valid(model, ignore_rules: tuple[str, ...] = ("natural_key",)) -> None:
    """Raise ``ModelError`` when a check other than ``ignore_rules`` fails.

    The natural-key check is informational by default: person variants and a
    facility name at two addresses are legitimate outcomes of the model.
    """
    _raise_if_broken(violations(model), ignore_rules)
