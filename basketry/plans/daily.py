"""The flags from partial aggregates that are kept: one row per customer and period, merged for any day asked about.

A period is a day, or a month whose days have been rolled up. Its row holds what merges without the purchases: sums,
counts, minima and maxima, and marks as bits (kinds of products, hours of the day). A second table holds the distinct
pairs of customer and category of each period. New purchases touch their own days only, so a refresh reads these days'
purchases and replaces these days' rows; older purchases are never read again. Windows end at the day asked about and
are cut between days, so a matrix may be asked for any day whose windows do not reach into rolled-up months.

What must hold: the versions of a purchase carry the same time, that of the purchase, so that a day's purchases can be
found by their time alone. Names in the spec (categories, payment methods, words) enter the stored rows; its limits,
windows and hours enter only when rows are merged and may change from matrix to matrix.

A refresh replaces whole periods and may be repeated. A roll-up writes the month before it drops the days; days of a
month that is there are not read, so a run that stops between the two leaves no row counted twice.
"""

from __future__ import annotations

import calendar
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.lookup import fits
from basketry.plans.features import (
    CATEGORIES,
    FLAG_NAMES,
    MARKS,
    FeatureSpec,
    bought_categories,
    day_sql,
    lookup_sides,
    measure_sql,
    needed_measures,
    purchase_rows,
    with_flags,
)
from basketry.plans.prepare import MartInputs, latest_purchases, prepare_customers, prepare_items
from basketry.sources.partitions import drop_partitions, partition_values

PERIOD = "period"
#: purchases whose time cannot be read count for everything that has no window
UNDATED = "undated"
PARTIALS, PAIRS = "partials", "categories"

# What is kept: of the purchases of a period, and of periods that are merged.
KEPT: dict[str, tuple[str, str]] = {
    "n_rows": ("count(1)", "sum"),
    "n_purchases": ("count(purchase_pk)", "sum"),
    "amount": ("sum(total_amount)", "sum"),
    "n_amounts": ("count(total_amount)", "sum"),
    "last_day": ("max(purchase_date)", "max"),
    "any_delivery": ("max(if(is_delivery, 1, 0))", "max"),
    "hours": ("bit_or(shiftleft(1, purchase_hour))", "bit_or"),
    "n_weekend": ("count_if(dayofweek(purchase_date) IN (1, 7))", "sum"),
    "n_fruit": ("count_if(marks & {fruit} <> 0)", "sum"),
    "marks": ("bit_or(marks)", "bit_or"),
    "n_baskets": ("count(n_items)", "sum"),
    "n_single": ("count_if(n_items = 1)", "sum"),
    "n_items_total": ("sum(n_items)", "sum"),
}
# These are the same as measures of purchases as they are as measures of periods.
_AS_MEASURED = {"n_cash": "sum", "n_card": "sum", "min_city": "min", "max_city": "max", "min_store": "min", "max_store": "max"}


def _bit(mark: str) -> str:
    return f"{1 << MARKS.index(mark)}L"


def _since(today: str, days: int) -> str:
    return f"last_day >= date_sub({today}, {days})"


def _seen(mark: str, today: str, days: int | None = None) -> str:
    marks = "marks" if days is None else f"if({_since(today, days)}, marks, NULL)"
    return f"if(bit_or({marks}) & {_bit(mark)} <> 0, 1, 0)"


def merged_measures(spec: FeatureSpec, today: str) -> dict[str, str]:
    """The measures of a customer over the rows of its periods, in SQL."""
    month, week = _since(today, spec.month_days), _since(today, spec.week_days)
    early = sum(1 << hour for hour in range(spec.early_from_hour, spec.early_to_hour + 1))
    return {
        "n_purchases": "sum(n_purchases)",
        "n_rows": "sum(n_rows)",
        "n_month": f"sum(if({month}, n_rows, 0))",
        "last_date": "max(last_day)",
        "any_delivery": "max(any_delivery)",
        "avg_basket": "try_divide(sum(amount), sum(n_amounts))",
        "spent_week": f"sum(if({week}, amount, NULL))",
        # the highest and the lowest hour that is set
        "last_hour": "length(bin(bit_or(hours))) - 1",
        "first_hour": "length(bin(bit_or(hours) & -bit_or(hours))) - 1",
        "any_early": f"if(bit_or(hours) & {early} <> 0, 1, 0)",
        "n_weekend": "sum(n_weekend)",
        **{name: f"{merge}({name})" for name, merge in _AS_MEASURED.items()},
        "milk_month": _seen("milk", today, spec.month_days),
        "fruit_short": _seen("fruit", today, spec.short_days),
        "veggie_short": _seen("veggie", today, spec.short_days),
        "meat_week": _seen("meat", today, spec.week_days),
        "meat_quarter": _seen("meat", today, spec.quarter_days),
        "organic": _seen("organic", today),
        "bakery": _seen("bakery", today),
        "n_fruit_month": f"sum(if({month}, n_fruit, 0))",
        "n_baskets": "sum(n_baskets)",
        "n_single": "sum(n_single)",
        "n_items_total": "sum(n_items_total)",
    }


# Windows, by the measures that have one.
_WINDOWS = {
    "n_month": "month_days",
    "n_fruit_month": "month_days",
    "milk_month": "month_days",
    "fruit_short": "short_days",
    "veggie_short": "short_days",
    "spent_week": "week_days",
    "meat_week": "week_days",
    "meat_quarter": "quarter_days",
}


def _month_end(month: str) -> date:
    year, number = int(month[:4]), int(month[4:])
    return date(year, number, calendar.monthrange(year, number)[1])


def _days(first: date, last: date) -> list[str]:
    return [f"{first + timedelta(days=k):%Y%m%d}" for k in range((last - first).days + 1)]


@dataclass(frozen=True)
class DayStore:
    """The stored rows under ``root``, a folder that all executors share."""

    spark: SparkSession
    root: str
    spec: FeatureSpec = FeatureSpec()

    def build(self, inputs: MartInputs, days_from: date | None = None) -> None:
        """Make the store of all purchases. Purchases of months that end before ``days_from`` go to month rows at once."""
        day = F.date_format("purchase_date", "yyyyMMdd")
        if days_from is not None:
            rolled = F.col("purchase_date") < F.lit(days_from.replace(day=1))
            day = F.when(rolled, F.date_format("purchase_date", "yyyyMM")).otherwise(day)
        for table, df in self._made(inputs, F.coalesce(day, F.lit(UNDATED))).items():
            self._write(table, df, [UNDATED], "static")

    def refresh(self, inputs: MartInputs, first: date, last: date) -> None:
        """Make the rows of the days ``first`` to ``last`` anew, from the purchases of these days.

        ``inputs`` may hold other purchases, which are left out by their time before anything else is done, and must
        hold all items of these. A day that has no purchases any more loses its rows. Of a month that is rolled up, all
        days must be asked for; they become the month's row again.
        """
        months = {value for value in partition_values(self.spark, f"{self.root}/{PARTIALS}", PERIOD) if len(value) == 6}
        days = _days(first, last)
        touched = {day[:6] for day in days} & months
        for month in touched:
            if date(int(month[:4]), int(month[4:]), 1) < first or _month_end(month) > last:
                raise ValueError(f"the days of {month} are rolled up; refresh the whole month")
        day = F.date_format("purchase_date", "yyyyMMdd")
        if touched:
            month = F.date_format("purchase_date", "yyyyMM")
            day = F.when(month.isin(*sorted(touched)), month).otherwise(day)
        new = replace(inputs, purchases=bought_between(inputs.purchases, first, last))
        made = self._made(new, day, few=True)
        periods = sorted({day[:6] if day[:6] in touched else day for day in days})
        for table, df in made.items():
            self._write(table, df, periods, "dynamic")

    def roll_up(self, before: date) -> None:
        """Merge the days of the months that end before ``before`` to a row per customer and month."""
        for table in (PARTIALS, PAIRS):
            path = f"{self.root}/{table}"
            periods = partition_values(self.spark, path, PERIOD)
            there = {value for value in periods if len(value) == 6}
            old = [v for v in periods if len(v) == 8 and _month_end(v[:6]) < before]
            fresh = [v for v in old if v[:6] not in there]
            if fresh:
                days = self._stored(table, fresh).withColumn(PERIOD, F.substring(PERIOD, 1, 6))
                keys = ["customer_pk", PERIOD]
                merged = days.groupBy(*keys).agg(*self._merges(days)) if table == PARTIALS else days.distinct()
                self._write(table, merged, [], "dynamic")
            drop_partitions(self.spark, path, PERIOD, old)

    def matrix(
        self,
        customers: DataFrame,
        as_of: date,
        flags: Sequence[str] = FLAG_NAMES,
        spec: FeatureSpec | None = None,
    ) -> DataFrame:
        """customer_id and flags, as ``feature_matrix`` gives them of all purchases in the store.

        ``customers``: the mart table of customers. ``spec`` may have other limits, windows and hours than the store's.
        """
        spec = spec or self.spec
        today, measures = day_sql(as_of), needed_measures(flags)
        reach = max((getattr(spec, _WINDOWS[name]) for name in measures if name in _WINDOWS), default=None)
        found = None
        wanted = [name for name in measures if name != CATEGORIES]
        if wanted:
            merged = merged_measures(spec, today)
            rows = self._read(PARTIALS, None if reach is None else as_of - timedelta(days=reach))
            found = rows.groupBy("customer_pk").agg(*(F.expr(merged[name]).alias(name) for name in wanted))
        if CATEGORIES in measures:
            pairs = self._read(PAIRS).select("customer_pk", "category_name").distinct()
            counted = pairs.groupBy("customer_pk").agg(F.count(F.lit(1)).alias(CATEGORIES))
            found = counted if found is None else found.join(counted, "customer_pk", "left")
        return with_flags(prepare_customers(customers), found, spec, today, flags)

    def _made(self, inputs: MartInputs, period: Column, *, few: bool = False) -> dict[str, DataFrame]:
        """The rows of the two tables, of all given purchases."""
        needed = set(needed_measures(FLAG_NAMES))
        sides = lookup_sides(inputs, needed)
        purchases = latest_purchases(inputs.purchases).withColumn(PERIOD, period)
        items = inputs.items
        if few:
            # of the items, those of the purchases at hand, before their versions are compared; the size of a filtered
            # table is not known before it is read, and without it all items would be shuffled to find a few
            bought = inputs.purchases.select("purchase_pk").distinct()
            items = items.join(F.broadcast(bought) if fits(bought) else bought, "purchase_pk", "left_semi")
        items = prepare_items(items, inputs.item_keys)
        rows = purchase_rows(purchases, items, inputs, self.spec, needed, sides).filter("customer_pk IS NOT NULL")
        measured = measure_sql(self.spec)
        kept = [F.expr(made.format(fruit=_bit("fruit"))).alias(name) for name, (made, _) in KEPT.items()]
        kept += [F.expr(measured[name]).alias(name) for name in _AS_MEASURED]
        pairs = bought_categories(items, sides.products, purchases, by=[PERIOD], small=sides.small.products)
        return {
            PARTIALS: rows.groupBy("customer_pk", PERIOD).agg(*kept),
            PAIRS: pairs.filter("customer_pk IS NOT NULL"),
        }

    def _write(self, table: str, rows: DataFrame, periods: Sequence[str], mode: str) -> None:
        """Replace the table, or the periods that occur. A row of nobody in each of ``periods`` makes them occur."""
        if periods:
            nobody = self.spark.createDataFrame([(period,) for period in periods], f"{PERIOD} string")
            rows = rows.unionByName(nobody, allowMissingColumns=True)
        writer = rows.hint("rebalance", PERIOD).write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy(PERIOD).parquet(f"{self.root}/{table}")

    def _merges(self, rows: DataFrame) -> list[Column]:
        merges = {name: merge for name, (_, merge) in KEPT.items()} | _AS_MEASURED
        return [F.expr(f"{merge}({name})").cast(rows.schema[name].dataType).alias(name) for name, merge in merges.items()]

    def _stored(self, table: str, periods: Sequence[str]) -> DataFrame:
        rows = self.spark.read.option("basePath", f"{self.root}/{table}").schema(self._schema(table))
        rows = rows.parquet(*(f"{self.root}/{table}/{PERIOD}={period}" for period in periods))
        return rows.filter("customer_pk IS NOT NULL")

    def _schema(self, table: str) -> T.StructType:
        """The table's columns with the period as text, whatever its folders look like."""
        schema = self.spark.read.parquet(f"{self.root}/{table}").schema
        return T.StructType([T.StructField(f.name, T.StringType() if f.name == PERIOD else f.dataType) for f in schema])

    def _read(self, table: str, since: date | None = None) -> DataFrame:
        """All rows; those that windows from ``since`` on read must be of days."""
        path = f"{self.root}/{table}"
        periods = partition_values(self.spark, path, PERIOD)
        months = {value for value in periods if len(value) == 6}
        reached = [month for month in months if since is not None and _month_end(month) >= since]
        if reached:
            raise ValueError(f"the days of {min(reached)} are rolled up, and windows reach back to {since}")
        # days of a month that is there are leftovers of a roll-up
        live = [value for value in periods if len(value) == 6 or value == UNDATED or value[:6] not in months]
        if len(live) < len(periods):
            return self._stored(table, live)
        rows = self.spark.read.schema(self._schema(table)).parquet(path)
        return rows.filter("customer_pk IS NOT NULL")


def bought_between(purchases: DataFrame, first: date, last: date) -> DataFrame:
    """Purchases of some days, by plain comparisons that reach the scan."""
    time, after = F.col("purchase_datetime"), last + timedelta(days=1)
    if isinstance(purchases.schema["purchase_datetime"].dataType, T.StringType):
        return purchases.filter((time >= f"{first:%Y-%m-%d}") & (time < f"{after:%Y-%m-%d}"))
    kind = purchases.schema["purchase_datetime"].dataType
    return purchases.filter((time >= F.lit(first).cast(kind)) & (time < F.lit(after).cast(kind)))
