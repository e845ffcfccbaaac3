"""Silver tables and marts that follow new raw files without the old ones.

``take`` lands new files and adds their first rows of new keys to
``state/<entity>``, a growing keep-first table; ``current`` is the silver table
that a full run over all files gives.  Files must be taken in the order of
their arrival.

The marts keep partial sums of their groups in ``state``: a mart follows by
aggregating the rows added since and merging them with what it has.

* Counts, exact amounts, least and largest values merge as such.
* Distinct customers of a branch are numbers and bitmaps: a customer gets a number
  once (a growing table too), and the numbers fall into buckets of 32,768.  A
  branch has a row for each customer of a bucket while those are few, which takes
  less than a bitmap, and a bitmap of 4 KB once they are many; bitmaps merge by or.
* The customers' incomes are kept without the median in the gaps, with the
  number of gaps of each group and a histogram of all incomes; the median of
  that fills the gaps when the mart is read.

Each state names the version of its source that it includes, so an update that
breaks off is caught up by the next one, and nothing counts twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankmart import vocab
from bankmart.functions.numeric import exact_units, not_finite, rest_units, round_half_up, rounded_mean, rounded_total
from bankmart.operators.impute import middle
from bankmart.plans.gold import BRANCH_KEYS
from bankmart.plans.medallion import MALFORMED
from bankmart.plans.silver import STEPS
from bankmart.schemas import ARRIVAL, KEYS
from bankmart.sources.bronze import CORRUPT, bronze_view, read_csv_text, short_arrival
from bankmart.sources.growing import GrowingTable
from bankmart.sources.lake import Lake
from bankmart.sources.snapshots import SnapshotTable, Version, narrow_splits, scratch

#: Customers of a branch in a bucket of numbers, before they are a bitmap: as many as take its 4 KB.
MOST_LISTED = 1 << 11


def growing(lake: Lake, entity: str) -> GrowingTable:
    return GrowingTable(lake.spark, lake.path("state", entity))


def take(lake: Lake, entity: str, paths: str | list[str]) -> Version:
    """Lands new raw files in ``bronze/<entity>``, malformed rows apart, and takes
    the rows whose keys are new."""
    text = read_csv_text(lake.spark, paths, entity).withColumn(MALFORMED, F.col(CORRUPT).isNotNull())
    bronze = lake.snapshots("bronze", entity)
    bronze.append(text, [MALFORMED], {"malformed": F.count_if(MALFORMED)})
    rows = bronze_view(short_arrival(bronze.added().where(~F.col(MALFORMED)).drop(CORRUPT)), entity)
    steps = STEPS[entity]
    with narrow_splits(lake.spark):
        return growing(lake, entity).add(steps.before(rows), KEYS[entity], lambda first: steps.after(first).drop(ARRIVAL))


def current(lake: Lake, entity: str) -> DataFrame:
    """The silver table of all files taken so far."""
    return STEPS[entity].complete(growing(lake, entity).read())


# --- partial sums -----------------------------------------------------------


def _amount(column: str) -> dict[str, Column]:
    """What a total or a mean of the column needs."""
    units = exact_units(column)
    return {f"{column}_units": F.sum(units), f"{column}_n": F.count(units), f"{column}_odd": F.sum(not_finite(column)),
            f"{column}_rest": F.sum(rest_units(column))}


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _mean(column: str, scale: int) -> Column:
    return rounded_mean(F.col(f"{column}_units"), F.col(f"{column}_n"), F.col(f"{column}_odd"), scale, F.col(f"{column}_rest"))


def _partials() -> dict[str, tuple[str, list[str], dict[str, Column]]]:
    """Per mart: its source, its groups, and the partial aggregates of a group."""
    channel, status = F.col("payment_channel"), F.col("transaction_status")
    return {
        "loan_performance": ("loans", ["loan_type", "loan_status", "default_flag"], {
            "total_loans": F.count("loan_id"),
            **_amount("principal_amount"), **_amount("interest_rate"), **_amount("monthly_payment"), **_amount("balance"), **_amount("term_months")}),
        "branch_performance": ("transactions", ["branch_id"], {
            "total_transactions": F.count("transaction_id"), **_amount("balance_after_transaction"),
            **{name: _count(channel.isin(chs)) for name, chs in vocab.CHANNEL_GROUPS.items()},
            "completed_count": _count(status == "Completed"), "failed_count": _count(status == "Failed")}),
        "customer_segments": ("customers", ["risk_rating", "employment_status", "city"], {
            "total_customers": F.count("cust_id"), **_amount("annual_income"),
            "least": F.min("annual_income"), "largest": F.max("annual_income"), "gaps": _count(F.col("annual_income").isNull()),
            "verified_count": _count(F.col("kyc_status") == "Verified"), "pending_count": _count(F.col("kyc_status") == "Pending"),
            "male_count": _count(F.col("gender") == "Male"), "female_count": _count(F.col("gender") == "Female")}),
    }


def _merged(state: DataFrame, keys: list[str]) -> DataFrame:
    how = {"least": F.min, "largest": F.max}
    return state.groupBy(*keys).agg(*[how.get(c, F.sum)(c).alias(c) for c in state.columns if c not in keys])


def _follow(lake: Lake, state: SnapshotTable, entity: str, partial, merge, merged: bool = True) -> DataFrame:
    """``state`` brought up to its source: what ``partial`` makes of the rows added
    since, merged with what the state has.  ``merged``: as ``partial`` has merged
    them among themselves, a first state is left as it is."""
    source = growing(lake, entity)
    upto, done = source.version().number, state.version().index["source"] if state.numbers() else 0
    if done < upto:
        with narrow_splits(lake.spark):
            new = partial(source.added(done))
            if done:
                new = state.read().unionByName(new, allowMissingColumns=True)
            if done or not merged:
                new = merge(new)
            state.write(new, index={"source": upto})
    return state.read()


def _state(lake: Lake, name: str) -> SnapshotTable:
    return lake.snapshots("state", f"mart_{name}")


def follow_mart(lake: Lake, name: str) -> DataFrame:
    """The partial sums of a mart, a row for each of its groups, up to date."""
    entity, keys, aggs = _partials()[name]

    def partial(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])

    return _follow(lake, _state(lake, name), entity, partial, lambda both: _merged(both, keys))


def loan_performance(lake: Lake) -> DataFrame:
    """The loan mart of all files taken so far."""
    return follow_mart(lake, "loan_performance").select(
        "loan_type", "loan_status", "default_flag", "total_loans", _mean("principal_amount", 2).alias("avg_principal"),
        _mean("interest_rate", 2).alias("avg_interest_rate"), _mean("monthly_payment", 2).alias("avg_monthly_payment"),
        rounded_total(F.col("balance_units"), F.col("balance_odd"), rest=F.col("balance_rest")).alias("total_remaining_balance"),
        _mean("term_months", 2).alias("avg_term_months"))


def numbered_customers(lake: Lake, rows: DataFrame) -> DataFrame:
    """customer_id and number of every customer known, those of ``rows`` included."""
    numbers = GrowingTable(lake.spark, lake.path("state", "customer_numbers"))
    ids = rows.select("customer_id").where(F.col("customer_id").isNotNull()).distinct().withColumn(ARRIVAL, F.lit(0))
    used = numbers.read().agg(F.max("number")).first()[0] if numbers.numbers() else None
    # apart by more than a bitmap, so that old and new customers share none
    base = 0 if used is None else (used // (1 << 15) + 1) << 15
    numbers.add(ids, "customer_id", lambda new: new.select("customer_id", (F.monotonically_increasing_id() + base).alias("number")))
    return numbers.read()


def follow_branch_customers(lake: Lake) -> DataFrame:
    """branch_id, bucket, at, bits: the customers of each branch, up to date.  Up to
    ``MOST_LISTED`` customers of a bucket have a row each (``at``, the position in
    the bucket), more are one bitmap (``bits``)."""
    bucket = ["branch_id", "bucket"]

    with scratch(lake.spark) as stage:

        def partial(rows: DataFrame) -> DataFrame:
            pairs = rows.select("branch_id", "customer_id").where("branch_id is not null and customer_id is not null")
            pairs = stage(pairs.distinct(), "pairs")
            numbered = pairs.join(numbered_customers(lake, pairs), "customer_id")
            at = F.bitmap_bit_position("number").cast("int")
            return numbered.select("branch_id", F.bitmap_bucket_number("number").alias("bucket"), at.alias("at"), F.lit(None).cast("binary").alias("bits"))

        def packed(both: DataFrame) -> DataFrame:
            of = Window.partitionBy(*bucket)
            many = (F.count("at").over(of) > MOST_LISTED) | (F.count("bits").over(of) > 0)
            found = stage(both.repartition(*bucket).distinct().withColumn("many", many), "customers")
            built = found.where("many and at is not null").groupBy(*bucket).agg(F.bitmap_construct_agg("at").alias("bits"))
            bitmaps = built.unionByName(found.where("bits is not null").select(*bucket, "bits")).groupBy(*bucket).agg(F.bitmap_or_agg("bits").alias("bits"))
            return found.where("not many").drop("many").unionByName(bitmaps, allowMissingColumns=True)

        return _follow(lake, _state(lake, "branch_customers"), "transactions", partial, packed, merged=False)


def branch_performance(lake: Lake, branches: DataFrame | None = None) -> DataFrame:
    """The branch mart of all files taken so far; ``branches`` by default those taken too."""
    dims = (current(lake, "branches") if branches is None else branches).select(*BRANCH_KEYS)
    customers = follow_branch_customers(lake).groupBy("branch_id").agg(F.sum(F.coalesce(F.bitmap_count("bits"), F.lit(1))).alias("unique_customers"))
    sums = follow_mart(lake, "branch_performance").where(F.col("branch_id").isNotNull()).join(customers, "branch_id", "left")
    x = "balance_after_transaction"
    return dims.join(sums, "branch_id").select(
        *BRANCH_KEYS, "total_transactions", F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"),
        rounded_total(F.col(f"{x}_units"), F.col(f"{x}_odd"), rest=F.col(f"{x}_rest")).alias("total_value"), _mean(x, 2).alias("avg_transaction_value"),
        *vocab.CHANNEL_GROUPS, "completed_count", "failed_count")


def income_histogram(lake: Lake) -> DataFrame:
    """v and n: how many customers have which income, up to date."""

    def partial(rows: DataFrame) -> DataFrame:
        v = rows.select(F.col("annual_income").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
        return v.groupBy("v").agg(F.count(F.lit(1)).alias("n"))

    return _follow(lake, _state(lake, "incomes"), "customers", partial, lambda both: _merged(both, ["v"]))


def customer_segments(lake: Lake) -> DataFrame:
    """The customer mart of all files taken so far."""
    median = middle(income_histogram(lake))
    fill = F.lit(median).cast("double")
    gaps = F.when(F.col("gaps") > 0, F.col("gaps"))
    c = "annual_income"

    def with_gaps(name: str, each: Column, kind: str) -> Column:
        both = F.col(f"{c}_{name}"), (each * gaps).cast(kind)
        return F.coalesce(both[0] + both[1], *both)

    units, rest = (with_gaps(n, x, "decimal(38,0)") for n, x in (("units", exact_units(fill)), ("rest", rest_units(fill))))
    odd = with_gaps("odd", not_finite(fill), "double")
    n = F.col(f"{c}_n") + F.when(exact_units(fill).isNotNull(), F.col("gaps")).otherwise(0)
    filled = F.when(gaps.isNotNull(), fill)
    return follow_mart(lake, "customer_segments").select(
        "risk_rating", "employment_status", "city", "total_customers", rounded_mean(units, n, odd, 2, rest).alias("avg_annual_income"),
        round_half_up(F.least("least", filled), 2).alias("min_annual_income"),
        round_half_up(F.greatest("largest", filled), 2).alias("max_annual_income"),
        "verified_count", "pending_count", "male_count", "female_count")
