"""Row quality: setting corrupt lines and orphaned options aside with a stated reason."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.operators.joins import distinct_keys, join_unique, present
from orderlake.schemas import LINE_KEY, REQUIRED_ITEM_COLUMNS

# Fixed value: the reason given to an option without a valid line.
ORPHAN_REASON = "ORPHAN_OPTION_NO_MATCHING_ORDER"
REASON = "REJECT_REASON"
# the column that holds a line no row could be made of
UNREADABLE = "UNREADABLE"


def missing(columns: list[str]) -> dict[str, Column]:
    """One rule per column: the reason given, and when it applies."""
    return {f"{c} is NULL": F.isnull(c) for c in columns}


def unparsed(types: dict[str, str]) -> dict[str, Column]:
    """One rule per text column whose value does not fit its type."""
    return {f"{c} is not {kind}": F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull() for c, kind in types.items()}


def rejected(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with the reasons of all broken rules in ``REJECT_REASON``. The rules
    themselves are the filter, so that a scan skips row groups without nulls."""
    reasons = [F.when(broken, reason) for reason, broken in rules.items()]
    bad = df.filter(reduce(or_, rules.values()))
    return bad.withColumn(REASON, F.concat_ws(", ", *reasons))


def accepted(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break no rule; with ``rejected`` these are all rows."""
    return df.filter(reduce(and_, [~broken for broken in rules.values()], F.lit(True)))


def valid_items(items: DataFrame, required: list[str] = REQUIRED_ITEM_COLUMNS) -> DataFrame:
    """Lines with every required column present."""
    return present(items, required)


def corrupt_items(items: DataFrame, required: list[str] = REQUIRED_ITEM_COLUMNS) -> DataFrame:
    """Lines lacking a required column, with the missing columns named."""
    return rejected(items, missing(required))


def valid_options(
    options: DataFrame, lines: DataFrame, keys: list[str] = LINE_KEY
) -> DataFrame:
    """Options whose line is among ``lines``. Both sides of the join are plain shuffles, so a hot line is
    split without reducing the lines to distinct keys first."""
    return options.join(present(lines.select(*keys), keys), keys, "left_semi")


def orphan_options(
    options: DataFrame, lines: DataFrame, keys: list[str] = LINE_KEY
) -> DataFrame:
    """Options whose line is not among ``lines``; a null key counts as no line."""
    known = present(lines.select(*keys), keys)
    return options.join(known, keys, "left_anti").withColumn(REASON, F.lit(ORPHAN_REASON))


def lines_without_options(
    lines: DataFrame, options: DataFrame, keys: list[str] = LINE_KEY
) -> DataFrame:
    """Lines that have no option. Legitimate, so a report and not a reject."""
    return join_unique(lines, distinct_keys(options, keys), keys, "left_anti")


def corrupt_options(options: DataFrame) -> DataFrame:
    """Options without a price or quantity. Sums skip them, so they are reported, not rejected."""
    return rejected(options, missing(["OPTION_PRICE", "OPTION_QUANTITY"]))


def nonempty(df: DataFrame, column: str, blank_is_empty: bool = False) -> DataFrame:
    """Rows where the column is neither null nor the empty string."""
    value = F.trim(column) if blank_is_empty else F.col(column)
    return df.filter(F.col(column).isNotNull() & (value != ""))


def conservation(splits: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per table the rows in, kept and set aside, from ``{table: (input, judged)}``, where ``judged`` has
    each row once with a flag ``VALID``."""
    tagged = [
        part.select(F.lit(table).alias("TABLE_NAME"), valid.alias("VALID"))
        for table, (rows, judged) in splits.items()
        for part, valid in ((rows, F.lit(None).cast("boolean")), (judged, F.col("VALID")))
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("TABLE_NAME")
        .agg(
            F.count_if(F.col("VALID").isNull()).alias("n_in"),
            F.count_if(F.col("VALID")).alias("n_valid"),
            F.count_if(~F.col("VALID")).alias("n_rejected"),
        )
    )


def judged_options(options: DataFrame, lines: DataFrame, keys: list[str] = LINE_KEY) -> DataFrame:
    """Every option once, with a flag ``VALID`` that says whether its line is among ``lines``."""
    known = distinct_keys(lines, keys).withColumn("_known", F.lit(True))
    return join_unique(options, known, keys, "left").select(*keys, F.col("_known").isNotNull().alias("VALID"))


def unparsed_dates(calendar: DataFrame) -> DataFrame:
    """Calendar rows whose key fits no known spelling."""
    return calendar.filter(F.col("DATE").isNull())


def require_parsed_dates(calendar: DataFrame) -> None:
    """Raise if any calendar key could not be read; called before anything is published."""
    bad = unparsed_dates(calendar).count()
    if bad:
        raise ValueError(f"{bad} date_key rows do not parse")
