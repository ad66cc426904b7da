"""Row counts, distinct values and data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.sources import storage


def outside(value: Column, allowed) -> Column:
    """A non-null value that is not in the allowed set."""
    return ~value.isin(*allowed)


def quality_report(
    df: DataFrame,
    violations: Mapping[str, Column],
    key: str | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """``(check, violations)`` for named predicates that should never hold.

    One scan and one aggregate whatever the number of checks. ``unique_key``
    counts rows beyond one per key, null counting as one value; ``min_rows``
    counts the rows that are missing.
    """
    counts = [
        F.count_if(predicate).cast("bigint").alias(name)
        for name, predicate in violations.items()
    ]
    if key is not None:
        distinct = F.count_distinct(key) + F.max(F.col(key).isNull().cast("int"))
        counts.append((F.count("*") - distinct).alias("unique_key"))
    if min_rows is not None:
        missing = F.greatest(F.lit(min_rows) - F.count("*"), F.lit(0))
        counts.append(missing.cast("bigint").alias("min_rows"))
    return _listed(df.agg(*counts))


def _listed(totals: DataFrame) -> DataFrame:
    """One row of named counts as rows."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("check"), F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias("violations"))
            for c in totals.columns
        ]
    )
    return totals.select(F.inline(entries))


class KeptQuality:
    """Checks of a table that grows by loads, from one small state kept per load.

    A state holds the rows of a load, the violations of each named predicate and,
    for some columns, the nulls and a sketch of the distinct values. Counts add
    up and sketches unite, so a report reads the states and no load again. Counts
    are exact; the number of distinct values has a standard error of about
    ``0.83 / 2 ** (lg_k / 2)``: 1.3 % as it is. Sketches are of bounded size, so
    a state is a few kilobytes whatever the load.
    """

    def __init__(
        self, spark: SparkSession, root: str, violations: Mapping[str, Column], distinct: Sequence[str] = (),
        lg_k: int = 12,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.violations, self.distinct, self.lg_k = dict(violations), list(distinct), lg_k

    def add(self, load: DataFrame, name: str) -> bool:
        """Keep the state of a load under its name; False, and nothing read, if it is known.

        One scan and one aggregate. A load that stopped leaves no state.
        """
        at = f"{self.root}/load={name}"
        if storage.exists(self.spark, f"{at}/_SUCCESS"):
            return False
        found = [F.count("*").alias("rows")]
        found += [F.count_if(p).alias(f"bad_{i}") for i, p in enumerate(self.violations.values())]
        for i, c in enumerate(self.distinct):
            value = F.col(c).cast("string")
            found += [F.count_if(value.isNull()).alias(f"nulls_{i}"), F.hll_sketch_agg(value, self.lg_k).alias(f"sketch_{i}")]
        load.agg(*found).coalesce(1).write.mode("overwrite").parquet(at)
        return True

    def _states(self) -> DataFrame:
        kinds = ["rows bigint", *(f"bad_{i} bigint" for i in range(len(self.violations)))]
        for i in range(len(self.distinct)):
            kinds += [f"nulls_{i} bigint", f"sketch_{i} binary"]
        schema = ", ".join(kinds)
        if not storage.child_names(self.spark, self.root):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.root)

    def report(self, min_rows: int | None = None) -> DataFrame:
        """``(check, violations)`` over all loads, as :func:`quality_report` has them without ``key``."""
        sums = [F.sum(f"bad_{i}").alias(n) for i, n in enumerate(self.violations)]
        if min_rows is not None:
            sums.append(F.greatest(F.lit(min_rows) - F.coalesce(F.sum("rows"), F.lit(0)), F.lit(0)).cast("bigint").alias("min_rows"))
        return _listed(self._states().agg(*sums))

    def distinct_values(self) -> DataFrame:
        """``column``, ``estimate`` of its distinct values that are not null, ``nulls`` and ``rows``, over all loads."""
        states, parts = self._states(), []
        for i, c in enumerate(self.distinct):
            united = F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{i}"))
            parts.append(F.struct(F.lit(c).alias("column"), F.coalesce(united, F.lit(0)).cast("bigint").alias("estimate"),
                                  F.coalesce(F.sum(f"nulls_{i}"), F.lit(0)).alias("nulls"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")))
        return states.agg(F.array(*parts).alias("found")).select(F.inline("found"))


def card_quality(cards: DataFrame, min_rows: int = 1) -> DataFrame:
    """The checks of a card account table."""
    return quality_report(
        cards,
        {
            "card_status": outside(F.col("card_status"), fixed.CARD_STATUSES),
            "credit_limit": F.col("credit_limit") <= 0,
            "current_balance": F.col("current_balance") < 0,
            "currency": F.col("currency").isNull(),
        },
        key=fixed.CARD_KEY,
        min_rows=min_rows,
    )


def top_rows(df: DataFrame, by: str, tie: str, n: int) -> DataFrame:
    """The ``n`` highest rows: plans as one top-n per task, no full sort."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie)).limit(n)
