"""Trial balance joined to the chart-of-accounts grouping table, and its coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.codes import trimmed_account_name
from ledgerloom.functions.columns import named
from ledgerloom.functions.numbers import money_sum
from ledgerloom.runtime import literal_rows, lookup_side

# Account categories and the words that put an account into them.
CATEGORIES = {
    "assets": ("asset",),
    "liabilities": ("liabilities", "liability"),
    "equity": ("equity",),
    "income": ("income",),
    "expenditure": ("expense",),
}


def without_nan_text(df: DataFrame) -> DataFrame:
    """Null for cells holding the text ``nan``."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[F.nullif(named(c), F.lit("nan")).alias(c) if c in texts else named(c) for c in df.columns]
    )


def normalized_code(c: Column) -> Column:
    """Account code as text without surrounding blanks and leading zeros."""
    return F.regexp_replace(F.trim(c.cast("string")), "^0+(?=.)", "")


def group_by_code(
    tb: DataFrame,
    grouping: DataFrame,
    code: str = "glAccountNumber",
    grouping_code: str = "nominalCode",
    normalize: bool = False,
) -> DataFrame:
    """Left join on the account code; null codes match null codes. The grouping's code is dropped."""
    form = normalized_code if normalize else (lambda c: c.cast("string"))
    keyed = grouping.withColumn("_code", form(named(grouping_code))).drop(grouping_code)
    side = lookup_side(keyed, once=False)
    return tb.join(side, form(tb[f"`{code}`"]).eqNullSafe(side["_code"]), "left").drop("_code")


def group_by_code_and_name(
    tb: DataFrame,
    grouping: DataFrame,
    code: str = "glAccountNumber",
    name: str = "glAccountName",
    grouping_code: str = "nominalCode",
    grouping_name: str = "description",
) -> DataFrame:
    """Left join on account code and cleaned account name; repeated result rows are dropped.

    Missing names are the texts ``nan`` on the left and ``None`` on the right, so they match each other no
    more than other names do.
    """

    def text(c: Column, missing: str) -> Column:
        return F.coalesce(c.cast("string"), F.lit(missing))

    keyed = grouping.select(
        named(grouping_code).cast("string").alias("_code"),
        F.regexp_replace(text(named(grouping_name), "None"), r"^\s+|\s+$", "").alias("_name"),
        *[named(c) for c in grouping.columns if c not in (grouping_code, grouping_name)],
    )
    side = lookup_side(keyed.distinct(), once=False)
    matches = tb[f"`{code}`"].cast("string").eqNullSafe(side["_code"]) & trimmed_account_name(
        text(tb[f"`{name}`"], "nan")
    ).eqNullSafe(side["_name"])
    return tb.join(side, matches, "left").drop("_code", "_name").dropDuplicates()


def coverage(df: DataFrame, code: str = "glAccountNumber", account: str = "account") -> DataFrame:
    """Distinct codes and distinct codes with an account, in one row."""
    per_code = (
        df.filter(named(code).isNotNull())
        .groupBy(named(code))
        .agg(F.max(named(account).isNotNull()).alias("mapped"))
    )
    return per_code.agg(
        F.count(F.lit(1)).alias("total_codes"), F.count_if(F.col("mapped")).alias("mapped_codes")
    )


def _with_category(df: DataFrame, account: str) -> DataFrame:
    lowered = F.lower(named(account))
    hits = []
    for category, words in CATEGORIES.items():
        found = lowered.contains(words[0])
        for word in words[1:]:
            found = found | lowered.contains(word)
        hits.append(F.when(found, F.lit(category)))
    return df.withColumn("category", F.explode(F.array_compact(F.array(*hits))))


def category_accounts(df: DataFrame, account: str = "account") -> DataFrame:
    """The accounts of each category, one row per pair."""
    return _with_category(df.select(named(account).alias("account")).distinct(), "account").select(
        "category", "account"
    )


def category_rollup(
    df: DataFrame,
    code: str = "glAccountNumber",
    account: str = "account",
    amount: str = "amountEnding",
) -> DataFrame:
    """Amount total, distinct codes and distinct accounts per category; categories without rows give zero.

    Amounts are first summed per account and code, so only that small table is spread over the categories.
    An account naming several categories counts in each.
    """
    per_code = (
        df.filter(named(account).isNotNull())
        .groupBy(named(account).alias("account"), named(code).alias("code"))
        .agg(money_sum(named(amount)).alias("amount"))
    )
    spread = _with_category(per_code, "account")
    blank_rows = literal_rows(
        df.sparkSession,
        [(c, None, None, None) for c in CATEGORIES],
        T.StructType(
            [
                T.StructField("category", T.StringType()),
                T.StructField("account", T.StringType()),
                T.StructField("code", per_code.schema["code"].dataType),
                T.StructField("amount", T.DecimalType(38, 8)),
            ]
        ),
    )
    merged = spread.select("category", "account", "code", "amount").unionByName(blank_rows)
    # The distinct counts are taken over the pre-aggregated table, never over ledger rows.
    return merged.groupBy("category").agg(
        F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("total_value"),
        F.count_distinct("code").alias("mapped"),
        F.count_distinct("account").alias("accounts"),
    )
