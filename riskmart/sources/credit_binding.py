"""Credit-shaped raw tables derived from the sample star schema.

Customers and suppliers become applicants (suppliers have no bureau history), orders become bureau
credits and previous applications, line items become balance months, payments and point-of-sale
months, events become card months and order days become the macro calendar. Every source row is
used; the formulas are plain arithmetic on the row, so any SQL engine can repeat them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-02"

EDUCATION = {"AUTOMOBILE": "Higher education", "BUILDING": "Secondary / secondary special",
             "FURNITURE": "Incomplete higher", "HOUSEHOLD": "Lower secondary", "MACHINERY": "Academic degree",
             "SUPPLIER": "Secondary / secondary special"}
FAMILY = ("Married", "Single / not married", "Civil marriage", "Widow")
HOUSING = ("House / apartment", "Rented apartment", "With parents")
INCOME = ("Working", "Commercial associate", "Pensioner", "State servant")
OCCUPATIONS = ("Laborers", "Sales staff", "Core staff", "Managers", "Drivers", "Accountants", "Medicine staff",
               "Cleaning staff", "Cooking staff", "Security staff", "IT staff", "Secretaries")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _unit(k: Column, factor: int, modulus: int) -> Column:
    return ((k * F.lit(factor)) % F.lit(modulus)).cast("double") / F.lit(float(modulus))


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def application_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("long").alias("nat"),
        F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    supplier = table(spark, sf_dir, "supplier").select(
        (-(F.col("s_suppkey") + 1)).alias("id"), F.col("s_suppkey").alias("k"),
        F.col("s_nationkey").cast("long").alias("nat"), F.col("s_acctbal").alias("bal"), F.lit("SUPPLIER").alias("seg"))
    # applicants of one segment handed in an earlier version as well
    resubmitted = customer.filter(F.col("seg") == "BUILDING").withColumn("ver", F.lit(1))
    base = reduce(DataFrame.unionByName, [customer.withColumn("ver", F.lit(0)), supplier.withColumn("ver", F.lit(0)),
                                          resubmitted])
    k, nat, ver = F.col("k"), F.col("nat"), F.col("ver")
    credit = F.when(k % 211 == 0, F.lit(0.0)).otherwise(
        (F.lit(45000) + ((k * 7919) % 1000) * 600 + ver * 1000).cast("double"))
    ext2 = (k * 15485863) % 9973
    age_days = F.lit(7000) + (k * 37) % 17000
    chance = (F.lit(4) + F.when(ext2 < 2000, 14).otherwise(0) + F.when(age_days < 10957, 6).otherwise(0)
              + F.when(credit > 400000, 5).otherwise(0))
    return base.select(
        F.col("id").alias("sk_id_curr"),
        _null_if(k % 31 == 30, F.when((k * 6151 + nat * 31) % 100 < chance, 1).otherwise(0)).alias("target"),
        F.when(nat % 8 == 0, "Revolving loans").otherwise("Cash loans").alias("name_contract_type"),
        F.when(k % 100 == 99, "XNA").when(k % 3 == 0, "M").otherwise("F").alias("code_gender"),
        F.when(k % 3 == 1, "Y").otherwise("N").alias("flag_own_car"),
        F.when(k % 2 == 1, "Y").otherwise("N").alias("flag_own_realty"),
        (k % 4).cast("int").alias("cnt_children"),
        (F.col("bal") * 40).alias("amt_income_total"),
        credit.alias("amt_credit"),
        _null_if(k % 11 == 0, credit / F.lit(24.0)).alias("amt_annuity"),
        _null_if(k % 13 == 0, credit * F.lit(0.9)).alias("amt_goods_price"),
        _null_if(k % 2 == 0, _unit(k, 104729, 10007)).alias("ext_source_1"),
        _null_if(k % 50 == 7, _unit(k, 15485863, 9973)).alias("ext_source_2"),
        _null_if(k % 4 == 1, _unit(k, 32452843, 9949)).alias("ext_source_3"),
        F.element_at(F.create_map(*[F.lit(x) for kv in EDUCATION.items() for x in kv]), F.col("seg"))
        .alias("name_education_type"),
        _pick(k % 4, FAMILY).alias("name_family_status"),
        _pick(k % 3, HOUSING).alias("name_housing_type"),
        _pick(nat % 4, INCOME).alias("name_income_type"),
        _null_if(k % 5 == 0, _pick(nat % 12, OCCUPATIONS)).alias("occupation_type"),
        ((k % 70).cast("double") / F.lit(1000.0)).alias("region_population_relative"),
        (F.lit(1) + nat % 3).cast("int").alias("region_rating_client"),
        (k % 2).cast("int").alias("flag_work_phone"),
        F.when(k % 17 == 0, 1).otherwise(0).alias("flag_email"),
        _null_if(k % 97 == 0, (k % 4 + 2).cast("double")).alias("cnt_fam_members"),
        (-age_days).cast("int").alias("days_birth"),
        F.when(k % 9 == 0, F.lit(365243)).otherwise(-((k * 53) % 9000)).cast("int").alias("days_employed"),
        (-((k * 11) % 12000)).cast("double").alias("days_registration"),
        (-((k * 17) % 6000)).cast("int").alias("days_id_publish"),
        F.when(ver == 1, _moment("2024-01-01 00:00:00")).otherwise(_moment("2024-01-02 00:00:00")).alias("loaded_at"),
    )


def _days_before_as_of(day: str) -> Column:
    return (-F.datediff(F.lit(AS_OF).cast("date"), F.col(day).cast("date"))).cast("int")


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    days = _days_before_as_of("o_orderdate")
    unknown = (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P")
    debt = (F.when(k % 7 == 0, F.lit(None).cast("double")).when(k % 101 == 0, F.lit(-500.0))
            .when(F.col("o_orderstatus") == "O", price * F.lit(0.6)).otherwise(F.lit(0.0)))
    kinds = {"1-URGENT": "Microloan", "2-HIGH": "Consumer credit", "3-MEDIUM": "Credit card", "4-NOT SPECIFIED": "Car loan",
             "5-LOW": "Mortgage"}
    return o.select(
        _null_if(unknown, F.col("o_custkey")).alias("sk_id_curr"),
        k.alias("sk_id_bureau"),
        F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "O", "Active")
        .otherwise("Sold").alias("credit_active"),
        F.when(k % 20 == 0, "currency 2").otherwise("currency 1").alias("credit_currency"),
        F.element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), F.col("o_orderpriority"))
        .alias("credit_type"),
        days.alias("days_credit"),
        _null_if(k % 10 == 3, (days + 365 * (1 + k % 5)).cast("double")).alias("days_credit_enddate"),
        _null_if(k % 13 == 0, price).alias("amt_credit_sum"),
        debt.alias("amt_credit_sum_debt"),
        F.when(k % 17 == 0, F.lit(None).cast("double")).when(k % 9 == 0, price * F.lit(0.01)).otherwise(F.lit(0.0))
        .alias("amt_credit_sum_overdue"),
        _null_if(k % 3 == 0, price * F.lit(0.1)).alias("amt_credit_sum_limit"),
    )


def bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    late = (flag == "R") & (F.col("l_quantity") <= 15)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sk_id_bureau"),
        (-line).cast("int").alias("months_balance"),
        F.when(late, (F.lit(1) + line % 5).cast("string")).when(flag != "A", "0")
        .when(F.col("l_linestatus") == "F", "C").otherwise("X").alias("status"),
    )


def installments_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = F.col("l_partkey")
    # what follows from the line alone is worked out before the join, so that it moves small numbers in place of keys
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount",
        _null_if(part % 97 == 0, (part * 13 + F.col("l_suppkey")) % 45 - 33).cast("byte").alias("shift"),
        ((part % 19 == 0) & (F.col("l_linenumber") == 7)).alias("nothing_due"), (part % 89 == 0).alias("unpaid"))
    lines = lines.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    due = (_days_before_as_of("o_orderdate") + 30 * F.col("l_linenumber")).cast("double")
    price = F.col("l_extendedprice")
    return lines.select(
        F.col("o_custkey").alias("sk_id_curr"),
        F.col("l_orderkey").alias("sk_id_prev"),
        F.lit(1.0).alias("num_instalment_version"),
        F.col("l_linenumber").cast("int").alias("num_instalment_number"),
        due.alias("days_instalment"),
        (due + F.col("shift").cast("double")).alias("days_entry_payment"),
        F.when(F.col("nothing_due"), F.lit(0.0)).otherwise(price).alias("amt_instalment"),
        _null_if(F.col("unpaid"), price * (F.lit(1.0) - F.col("l_discount"))).alias("amt_payment"),
    )


def credit_card_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, kind, value = F.col("event_id"), F.col("event_type"), F.col("value")
    failed = kind == "error"
    return table(spark, sf_dir, "events").select(
        k.alias("sk_id_prev"),
        F.col("user_id").alias("sk_id_curr"),
        (-F.dayofmonth("ts")).cast("int").alias("months_balance"),
        (value * 160).alias("amt_balance"),
        F.when(failed, F.lit(0.0)).otherwise((F.lit(800) + (k % 10) * 800).cast("double")).alias("amt_credit_limit_actual"),
        _null_if(kind == "view", value).alias("amt_drawings_current"),
        _null_if(kind == "click", value * F.lit(0.5)).alias("amt_payment_current"),
        (value * 160).alias("amt_total_receivable"),
        (k % 5).cast("int").alias("cnt_drawings_current"),
        F.when(kind == "signup", "Signed").when(kind == "purchase", "Completed").otherwise("Active")
        .alias("name_contract_status"),
        F.when(failed, k % 40).otherwise(0).cast("int").alias("sk_dpd"),
        F.when(failed & (k % 3 == 0), k % 20).otherwise(0).cast("int").alias("sk_dpd_def"),
    )


def previous_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, price, urgency = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderpriority")
    refused = (urgency == "3-MEDIUM") | ((urgency == "5-LOW") & (F.col("o_custkey") % 4 == 0))
    return table(spark, sf_dir, "orders").select(
        k.alias("sk_id_prev"),
        F.col("o_custkey").alias("sk_id_curr"),
        F.when(k % 8 == 0, "Revolving loans").otherwise("Cash loans").alias("name_contract_type"),
        _null_if(k % 6 == 0, price / F.lit(12.0)).alias("amt_annuity"),
        price.alias("amt_application"),
        _null_if(k % 29 == 0, price * F.lit(0.95)).alias("amt_credit"),
        _null_if(k % 2 == 0, price * F.lit(0.05)).alias("amt_down_payment"),
        _null_if(k % 5 == 0, price * F.lit(0.9)).alias("amt_goods_price"),
        F.when(refused, "Refused").when(urgency.isin("1-URGENT", "2-HIGH"), "Approved")
        .when(urgency == "4-NOT SPECIFIED", "Canceled").otherwise("Unused offer").alias("name_contract_status"),
        F.when(k % 3 == 0, "Cash through the bank").otherwise("XNA").alias("name_payment_type"),
        F.when(refused, "HC").otherwise("XAP").alias("code_reject_reason"),
        F.when(k % 4 == 0, "New").otherwise("Repeater").alias("name_client_type"),
        F.when(k % 8 == 0, "Cards").otherwise("Cash").alias("name_portfolio"),
        F.when(k % 7 == 0, "walk-in").otherwise("x-sell").alias("name_product_type"),
        F.when(k % 9 == 0, "Stone").otherwise("Country-wide").alias("channel_type"),
        F.when(price > 300000, "high").when(price > 100000, "middle").otherwise("low_normal").alias("name_yield_group"),
        _days_before_as_of("o_orderdate").alias("days_decision"),
    )


def pos_cash_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, qty = F.col("l_linenumber"), F.col("l_quantity")
    returned = F.col("l_returnflag") == "R"
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sk_id_prev"),
        (-(F.col("l_suppkey") + 1)).alias("sk_id_curr"),
        (-line).cast("int").alias("months_balance"),
        qty.alias("cnt_instalment"),
        F.when(qty >= line, qty - line).alias("cnt_instalment_future"),
        F.when(F.col("l_linestatus") == "F", "Completed").otherwise("Active").alias("name_contract_status"),
        F.when(returned, line).otherwise(0).cast("int").alias("sk_dpd"),
        F.when(returned & (qty > 25), line).otherwise(0).cast("int").alias("sk_dpd_def"),
    )


def boc_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order day; some series have gaps."""
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    year, doy = F.year("d"), F.dayofyear("d")
    rate = (F.lit(25) + (year - 1995) * 60 + doy % 10).cast("double") / F.lit(100.0)
    return days.select(
        F.date_format("d", "yyyy-MM-dd").alias("date"),
        _null_if(doy % 50 == 0, rate).alias("overnight_rate"),
        (rate + F.lit(0.5)).alias("bond_2yr"),
        _null_if(doy % 7 == 0, rate + F.lit(1.25)).alias("bond_10yr"),
        ((F.lit(700) + doy).cast("double") / F.lit(1000.0)).alias("cadusd"),
        F.when(F.dayofmonth("d") == 1, doy.cast("double") / F.lit(100.0)).alias("cpi_total"),
        _moment("2024-01-02 00:00:00").alias("loaded_at"),
    )


RAW_TABLES = {
    "application_train": application_train, "bureau": bureau, "bureau_balance": bureau_balance,
    "previous_application": previous_application, "pos_cash_balance": pos_cash_balance,
    "installments_payments": installments_payments, "credit_card_balance": credit_card_balance, "boc_macro": boc_macro,
}
