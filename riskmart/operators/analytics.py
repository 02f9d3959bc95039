"""Analytical reports over raw tables and the fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.functions.bands import age_band, income_bracket, rate_era
from riskmart.functions.scalars import (count_where, greatest_strict, ratio, round_half_up, whole_years)
from riskmart.operators.quantiles import column_quantiles
from riskmart.operators.ranking import long_values, with_ntile
from riskmart.session import broadcast_if_small


def rate_pct(label: Column | str) -> Column:
    """Mean of a 0/1 label in percent; rows without a label are left out."""
    return round_half_up(F.avg(label) * 100, 2)


def default_rate_by_segment(raw_app: DataFrame) -> DataFrame:
    """Bracket × age band × contract type, riskiest first."""
    banded = raw_app.filter(F.col("amt_income_total") > 0).select(
        income_bracket("amt_income_total").alias("income_bracket"),
        age_band(whole_years("days_birth")).alias("age_band"),
        "name_contract_type", "target", "amt_credit",
        round_half_up(ratio("amt_credit", "amt_income_total"), 2).alias("dti_ratio"),
    )
    out = banded.groupBy("income_bracket", "age_band", "name_contract_type").agg(
        F.count(F.lit(1)).alias("total_applications"),
        F.sum(F.col("target").cast("long")).alias("total_defaults"),
        rate_pct("target").alias("default_rate_pct"),
        round_half_up(F.avg("amt_credit"), 0).alias("avg_loan_amount"),
        round_half_up(F.avg("dti_ratio"), 3).alias("avg_dti_ratio"),
    )
    return out.orderBy(F.col("default_rate_pct").desc_nulls_first(), "income_bracket", "age_band", "name_contract_type")


def bureau_debt_by_applicant(raw_bureau: DataFrame) -> DataFrame:
    active, debt = F.col("credit_active") == "Active", F.col("amt_credit_sum_debt")
    return raw_bureau.groupBy("sk_id_curr").agg(
        F.count(F.lit(1)).alias("num_bureau_records"),
        count_where(active).alias("active_credits"),
        F.coalesce(F.sum(debt), F.lit(0.0)).alias("total_bureau_debt"),
        F.coalesce(F.sum("amt_credit_sum_overdue"), F.lit(0.0)).alias("total_overdue"),
        F.max(F.when(active, debt).otherwise(F.lit(0.0))).alias("max_active_debt"),
    )


def bureau_dti(raw_app: DataFrame, raw_bureau: DataFrame) -> DataFrame:
    """Applications with bureau history and their debt-to-income ratio."""
    debts = bureau_debt_by_applicant(raw_bureau.filter(F.col("sk_id_curr").isNotNull()))
    return raw_app.select("sk_id_curr", "loaded_at", "target", "amt_income_total").join(
        debts.select("sk_id_curr", "total_bureau_debt", "total_overdue"), "sk_id_curr"
    ).withColumn("_load", ratio("total_bureau_debt", "amt_income_total")).withColumn(
        "bureau_dti", round_half_up("_load", 4))


def risk_by_dti_decile(raw_app: DataFrame, raw_bureau: DataFrame, tiles: int = 10) -> DataFrame:
    # the noise of the debt sum must not decide between equal ratios, so rank on the cleaned ratio
    load = round_half_up("_load", 6)
    scored = bureau_dti(raw_app, raw_bureau).select("sk_id_curr", "loaded_at", "target", "total_bureau_debt",
                                                    "total_overdue", load.alias("_rank_key"))
    order = [F.col("_rank_key").asc_nulls_last(), F.col("sk_id_curr").asc(), F.col("loaded_at").asc()]
    return with_ntile(scored, tiles, order, name="dti_decile").groupBy("dti_decile").agg(
        F.count(F.lit(1)).alias("applicants"),
        rate_pct("target").alias("default_rate_pct"),
        round_half_up(F.avg("total_bureau_debt"), 0).alias("avg_bureau_debt"),
        round_half_up(F.avg("total_overdue"), 2).alias("avg_overdue_amt"),
    ).orderBy("dti_decile")


def payment_behaviour(raw_app: DataFrame, raw_payments: DataFrame) -> DataFrame:
    """Payment discipline per applicant, then averaged per label."""
    delay = F.col("days_entry_payment") - F.col("days_instalment")
    stats = raw_payments.filter(F.col("sk_id_curr").isNotNull()).groupBy("sk_id_curr").agg(
        ratio(count_where(delay > 0), F.count(F.lit(1))).alias("late_share"),
        F.max(greatest_strict(delay, F.lit(0.0))).alias("worst"),
        round_half_up(F.avg(ratio("amt_payment", "amt_instalment")), 4).alias("coverage"),
    )
    return raw_app.select("sk_id_curr", "target").join(stats, "sk_id_curr").groupBy("target").agg(
        round_half_up(F.avg("late_share") * 100, 2).alias("avg_late_pmt_rate_pct"),
        round_half_up(F.avg("worst"), 1).alias("avg_worst_days_late"),
        round_half_up(F.avg("coverage"), 4).alias("avg_payment_coverage"),
        F.count(F.lit(1)).alias("applicant_count"),
    )


def annual_rate(raw_macro: DataFrame, date_col: str = "date", rate_col: str = "overnight_rate") -> DataFrame:
    """Mean rate per year; unreadable dates and numbers are skipped."""
    return raw_macro.select(
        F.year(F.try_to_date(F.col(date_col), "yyyy-MM-dd")).alias("yr"),
        F.col(rate_col).try_cast("double").alias("rate"),
    ).groupBy("yr").agg(F.round(F.avg("rate"), 12).alias("avg_overnight_rate"))


def macro_by_year(applications: DataFrame, raw_macro: DataFrame, as_of: str, offset_col: str = "days_decision",
                  label: str = "target") -> DataFrame:
    """Default rate per application year beside the mean rate of that year.

    The year is ``as_of`` moved by the row's day offset. Applications are reduced to one row per year
    before the join, so the join is a handful of rows on both sides.
    """
    year = F.year(F.date_add(F.lit(as_of).cast("date"), F.col(offset_col)))
    per_year = applications.filter(F.col(offset_col).isNotNull()).groupBy(year.alias("application_year")).agg(
        F.count(F.lit(1)).alias("applications"), rate_pct(label).alias("default_rate_pct"))
    macro = annual_rate(raw_macro)
    return per_year.join(macro, F.col("application_year") == F.col("yr"), "left").select(
        "application_year", "avg_overnight_rate", "applications", "default_rate_pct",
        rate_era("avg_overnight_rate").alias("rate_environment")).orderBy("application_year")


def external_score_by_education(raw_app: DataFrame, tiles: int = 5) -> DataFrame:
    known = raw_app.filter(F.col("ext_source_2").isNotNull()).select(
        "name_education_type", "ext_source_2", "target", "sk_id_curr", "loaded_at")
    order = [F.col("ext_source_2").asc(), F.col("sk_id_curr").asc(), F.col("loaded_at").asc()]
    return with_ntile(known, tiles, order, name="ext2_quintile").groupBy("name_education_type", "ext2_quintile").agg(
        F.count(F.lit(1)).alias("applicants"),
        rate_pct("target").alias("default_rate_pct"),
        round_half_up(F.avg("ext_source_2"), 4).alias("avg_ext_score_2"),
    ).orderBy("name_education_type", "ext2_quintile")


def external_score_pivot(raw_app: DataFrame, tiles: int = 5) -> DataFrame:
    """The same rates as a matrix: education in rows, quintiles in columns."""
    cells = external_score_by_education(raw_app, tiles)
    names = list(range(1, tiles + 1))
    wide = cells.groupBy("name_education_type").pivot("ext2_quintile", names).agg(F.first("default_rate_pct"))
    return wide.select("name_education_type", *[F.col(str(n)).alias(f"q{n}_default_rate_pct") for n in names])


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs and their share per column: one scan for all columns, emptiest first."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c.upper()).alias("col"), (F.col("_n") - F.col(c)).alias("nulls"))
                               for c in columns]))
    return counts.select("_n", rows.alias("r")).select(
        "r.col", "r.nulls", round_half_up(ratio(F.col("r.nulls"), F.col("_n")) * 100, 1).alias("null_pct")
    ).orderBy(F.col("null_pct").desc_nulls_last(), "col")


def label_correlations(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Pearson correlation of each feature with the label, all in one aggregation."""
    wide = df.agg(*[F.corr(F.col(f).cast("double"), F.col(label).cast("double")).alias(f) for f in features])
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("r")) for f in features]))
    return wide.select(pairs.alias("p")).select(
        "p.feature", round_half_up(F.col("p.r"), 6).alias("correlation")).orderBy(
        F.col("correlation").desc_nulls_last(), "feature")


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share per label, and the negatives-to-positives ratio; totals come from the labels' own rows."""
    cells = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    everything = Window.partitionBy(F.lit(0))

    def rows_of(value: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col(label) == value, F.col("rows"))).over(everything), F.lit(0))

    return cells.select(label, "rows", F.sum("rows").over(everything).alias("_all"), rows_of(0).alias("_neg"), rows_of(1).alias("_pos")
                        ).select(label, "rows", round_half_up(ratio("rows", "_all"), 6).alias("share"),
                                 round_half_up(ratio("_neg", "_pos"), 6).alias("neg_pos_ratio"))


def clipped_histogram(df: DataFrame, features: Sequence[str], label: str = "label", bins: int = 20,
                      low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Histogram per feature and label between two quantiles of that label's values.

    ``rows`` are those of the bin, ``rows_outside`` those of the label below the lower or above the upper quantile,
    which belong to no bin. The join is with one row per feature and label.
    """
    edges = column_quantiles(df, features, [low, high], [label]).groupBy("feature", label).agg(
        F.max(F.when(F.col("prob") == low, F.col("value"))).alias("lo"),
        F.max(F.when(F.col("prob") == high, F.col("value"))).alias("hi"))
    values = long_values(df, features, [label]).filter(F.col("value").isNotNull())
    edges = edges.select(F.col("feature").alias("_f"), F.col(label).alias("_l"), "lo", "hi")
    placed = values.join(edges, F.col("feature").eqNullSafe(F.col("_f")) & F.col(label).eqNullSafe(F.col("_l")))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    place = F.coalesce(F.floor((F.col("value") - F.col("lo")) / F.nullif(width, F.lit(0.0))), F.lit(0))
    inside = F.col("value").between(F.col("lo"), F.col("hi"))
    counted = placed.groupBy("feature", label, F.when(inside, F.least(place, F.lit(bins - 1))).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"))
    outside = F.coalesce(F.max(F.when(F.col("bin").isNull(), F.col("rows"))).over(Window.partitionBy("feature", label)), F.lit(0))
    return counted.withColumn("rows_outside", outside).filter(F.col("bin").isNotNull())


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, rows) of every raw table."""
    parts = [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n.upper()).alias("tbl"), "rows")
             for n, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def segment_enriched(fact: DataFrame, tiles: int = 10) -> DataFrame:
    """The fact with a per-segment ratio decile and three group means.

    Group values are aggregated and joined back, instead of windows that would sort a quarter of the
    table in one task. There are four segments and two labels, so both sides are tiny; their size is
    checked all the same before they are broadcast.
    """
    seg, dec = "credit_risk_segment", "dti_risk_decile"
    order = [F.col("credit_to_income_ratio").desc_nulls_first(), F.col("applicant_id").asc()]
    tiled = with_ntile(fact, tiles, order, [seg], name=dec)
    cell = tiled.groupBy(F.col(seg).alias("_seg"), F.col(dec).alias("_dec")).agg(
        F.avg("bureau_delinquency_rate").alias("avg_segment_delinquency"),
        F.max("inst_max_days_late").alias("max_segment_days_late"))
    label = tiled.groupBy(F.col("default_flag").alias("_flag")).agg(
        F.avg("inst_late_rate").alias("late_payment_rate_by_default"))
    same_cell = F.col(seg).eqNullSafe(F.col("_seg")) & (F.col(dec) == F.col("_dec"))
    return (tiled.join(broadcast_if_small(cell), same_cell, "left")
            .join(broadcast_if_small(label), F.col("default_flag").eqNullSafe(F.col("_flag")), "left")
            .drop("_seg", "_dec", "_flag"))


def rate_by_score_decile(fact: DataFrame, tiles: int = 10) -> DataFrame:
    order = [F.col("composite_risk_score").asc_nulls_last(), F.col("applicant_id").asc()]
    tiled = with_ntile(fact.select("applicant_id", "composite_risk_score", "default_flag"), tiles, order, name="score_decile")
    return tiled.groupBy("score_decile").agg(
        F.count(F.lit(1)).alias("applicants"), rate_pct("default_flag").alias("default_rate_pct"),
        F.min("composite_risk_score").alias("min_score"), F.max("composite_risk_score").alias("max_score"),
    ).orderBy("score_decile")


def year_over_year(df: DataFrame, date_col: str, label: str) -> DataFrame:
    """Rate per year minus the rate of the year before; NULL where that year has no rows."""
    yearly = df.groupBy(F.year(date_col).alias("year")).agg(rate_pct(label).alias("default_rate_pct"))
    before = yearly.select((F.col("year") + 1).alias("year"), F.col("default_rate_pct").alias("_prior"))
    return yearly.join(before, "year", "left").select(
        "year", "default_rate_pct",
        round_half_up(F.col("default_rate_pct") - F.col("_prior"), 2).alias("yoy_change")).orderBy("year")


def surrogate_dimension(df: DataFrame, column: str, key: str) -> DataFrame:
    """Distinct values numbered from 1 in value order; NULL is no dimension value."""
    from riskmart.operators.ranking import with_position

    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return with_position(values, [F.col(column).asc()], pos=key).select(column, F.col(key).cast("long").alias(key))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows with a key the parent does not have."""
    known = parent.select(F.col(parent_key).alias("_key"))
    return child.filter(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_key"), "left_anti")


def orphan_counts(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Unknown keys and their rows. Rows are counted per key first, so a frequent key is one row in the join."""
    return orphans(child.groupBy(key).agg(F.count(F.lit(1)).alias("rows")), key, parent, parent_key)


def top_by(df: DataFrame, n: int, order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """First ``n`` rows of the order: a per-task top-n, then one merge of n rows each."""
    return df.orderBy(*order).limit(n).select(*columns)


def top_occupations(app: DataFrame, n: int = 10) -> DataFrame:
    rates = app.filter(F.col("occupation").isNotNull()).groupBy("occupation").agg(
        F.count(F.lit(1)).alias("applications"), rate_pct("default_flag").alias("default_rate_pct"))
    return top_by(rates, n, [F.col("default_rate_pct").desc_nulls_last(), F.col("occupation").asc()],
                  ["occupation", "applications", "default_rate_pct"])
