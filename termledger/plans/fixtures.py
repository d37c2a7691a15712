"""Release-shaped views over the driver's star-schema tables.

The given tables hold no terminology, so each view projects one of them into
the shape of a component table. Every view reads its whole table; column lists
are narrow so that only the columns named here reach the parquet scan, and the
few fan-outs are generators over literal arrays rather than cross joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termledger import constants as K

#: Added to a key to get one that no history holds.
NEVER_SEEN = 1_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _either(predicate: Column, then: int, otherwise: int) -> Column:
    return F.when(predicate, F.lit(then)).otherwise(F.lit(otherwise))


def _digest(*columns) -> Column:
    return F.md5(F.concat_ws("|", *columns))


def fx_concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("concept_id"),
        F.lit("2018-11-01").cast("date").alias("effective_time"),
        _either(F.col("p_size") % 10 == 0, 0, 1).alias("active"),
        F.lit(K.EXTENSION_MODULE).alias("module_id"),
        _either(F.col("p_retailprice") > 1000, K.FULLY_DEFINED, 900000000000074008).alias(
            "definition_status_id"
        ),
    )


def fx_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return (
        table(spark, sf_dir, "part")
        .withColumn("k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        .select(
            (F.col("p_partkey") * 10 + k).alias("description_id"),
            F.col("p_partkey").alias("concept_id"),
            _either((F.col("p_partkey") + k) % 11 == 0, 0, 1).alias("active"),
            F.lit("en").alias("language_code"),
            _either(k == 1, K.FULLY_SPECIFIED_NAME, K.SYNONYM).alias("type_id"),
            F.when(k == 1, F.concat("p_name", F.lit(" ("), F.lower("p_type"), F.lit(")")))
            .when(k == 2, F.col("p_name"))
            .otherwise(F.col("p_brand"))
            .alias("term"),
            _either(k == 3, K.CASE_SENSITIVE, 900000000000448009).alias("case_significance_id"),
        )
    )


def fx_dialect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .where(F.col("p_partkey") % 7 != 0)
        .withColumn("k", F.explode(F.array(F.lit(2), F.lit(3))))
        .select(
            (F.col("p_partkey") * 10 + F.col("k")).alias("description_id"),
            _either(F.col("k") == 2, K.PREFERRED, K.ACCEPTABLE).alias("acceptability_id"),
        )
    )


def fx_dialect_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two descriptions of every part, preferred and acceptable."""
    return (
        table(spark, sf_dir, "part")
        .withColumn("k", F.explode(F.array(F.lit(2), F.lit(3))))
        .select(
            (F.col("p_partkey") * 10 + F.col("k")).alias("description_id"),
            _either(F.col("k") == 2, K.PREFERRED, K.ACCEPTABLE).alias("acceptability_id"),
        )
    )


def fx_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    even_line = F.col("l_linenumber") % 2 == 0
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("relationship_id"),
            "l_orderkey",
            "l_linenumber",
        )
        .agg(
            F.min("l_partkey").alias("source_id"),
            F.min("l_suppkey").alias("destination_id"),
            F.min(_either(F.col("l_returnflag") == "R", 0, 1)).alias("active"),
            F.min(_either(even_line, K.ASSOCIATED_MORPHOLOGY, K.FINDING_SITE)).alias("type_id"),
            F.min(
                _either(F.col("l_linestatus") == "F", K.INFERRED, 900000000000010007)
            ).alias("characteristic_type_id"),
        )
        .drop("l_orderkey", "l_linenumber")
    )


def fx_is_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = F.array(F.expr("p_partkey div 2"), F.expr("p_partkey div 3"))
    return (
        table(spark, sf_dir, "part")
        .where(F.col("p_partkey") > 0)
        .select(
            F.col("p_partkey").alias("sub_concept_id"),
            F.explode(F.array_distinct(parents)).alias("super_concept_id"),
        )
    )


def fx_map_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_partkey").alias("concept_id"),
            F.col("l_suppkey"),
            F.to_date("l_shipdate").alias("effective_date"),
        )
        .agg(F.min(_either(F.col("l_returnflag") == "R", 0, 1)).alias("active"))
        .select(
            _digest("concept_id", "l_suppkey").alias("member_id"),
            "effective_date",
            "active",
            (F.col("l_suppkey") % 5).alias("refset_id"),
            "concept_id",
            F.col("l_suppkey").cast("string").alias("map_target"),
        )
    )


def fx_map_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of part and supplier once, as a set of map members."""
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_partkey", "l_suppkey")
        .distinct()
        .select(
            (F.col("l_suppkey") % 5).alias("refset_id"),
            F.col("l_partkey").alias("concept_id"),
            F.col("l_suppkey").cast("string").alias("map_target"),
        )
    )


def fx_map_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a new release should hold, which must differ from the history: lines
    of small quantity are gone, seventh lines have a code never seen."""
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_quantity") > 15)
        .select(
            "l_partkey",
            F.when(F.col("l_linenumber") == 7, F.col("l_suppkey") + NEVER_SEEN).otherwise(F.col("l_suppkey")).alias("l_suppkey"),
        )
        .distinct()
        .select(
            (F.col("l_suppkey") % 5).alias("refset_id"),
            F.col("l_partkey").alias("concept_id"),
            F.col("l_suppkey").cast("string").alias("map_target"),
        )
    )


def fx_lang_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_custkey").alias("description_id"),
            F.to_date("o_orderdate").alias("effective_date"),
        )
        .agg(
            F.min(_either(F.col("o_orderstatus") == "F", 0, 1)).alias("active"),
            F.max(_either(urgent, K.PREFERRED, K.ACCEPTABLE)).alias("acceptability_id"),
        )
        .select(
            _digest(F.col("description_id") % 2, "description_id").alias("member_id"),
            "effective_date",
            "active",
            (F.col("description_id") % 2).alias("refset_id"),
            "description_id",
            "acceptability_id",
        )
    )


def _new_customers() -> Column:
    """Every tenth key becomes one that no order has."""
    key = F.col("c_custkey")
    return F.when(key % 10 == 0, key + NEVER_SEEN).otherwise(key)


def fx_lang_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a language member."""
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 2).alias("refset_id"),
        F.col("c_custkey").alias("description_id"),
        _either(F.col("c_mktsegment") == "BUILDING", K.PREFERRED, K.ACCEPTABLE).alias("acceptability_id"),
    )


def fx_lang_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a new release should hold; differs from the history."""
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_acctbal") > 0)
        .select(
            (F.col("c_custkey") % 2).alias("refset_id"),
            _new_customers().alias("description_id"),
            _either(F.col("c_mktsegment") == "BUILDING", K.PREFERRED, K.ACCEPTABLE).alias(
                "acceptability_id"
            ),
        )
    )


def fx_refset_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple refset history: the language history without acceptability."""
    return (
        fx_lang_full(spark, sf_dir)
        .drop("acceptability_id")
        .withColumnRenamed("description_id", "concept_id")
    )


def fx_refset_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_acctbal") > 0)
        .select(
            _digest(F.lit("tool"), "c_custkey").alias("member_id"),
            (F.col("c_custkey") % 2).alias("refset_id"),
            _new_customers().alias("concept_id"),
        )
    )


def fx_dep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Module dependencies, one per supplier in each of two releases, so that
    the table grows with the data."""
    dates = F.array(F.lit("2018-08-01").cast("date"), F.lit("2018-11-01").cast("date"))
    return (
        table(spark, sf_dir, "supplier")
        .withColumn("effective_date", F.explode(dates))
        .select(
            F.md5("s_name").alias("dep_id"),
            "effective_date",
            F.lit(1).alias("active"),
            F.lit(K.EXTENSION_MODULE).alias("module_id"),
            F.lit(900000000000534007).alias("refset_id"),
            F.col("s_suppkey").alias("referenced_component_id"),
            F.col("effective_date").alias("source_effective_date"),
            F.col("effective_date").alias("target_effective_date"),
        )
    )


def fx_read_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    digits = key.cast("string")
    return table(spark, sf_dir, "part").select(
        # five signs, more for keys that have more, so that a code stands for one part
        F.lpad(digits, F.greatest(F.lit(5), F.length(digits)), F.lit("0")).alias("read_code"),
        F.lit("00").alias("term_code"),
        F.when(key % 3 == 0, F.lit("")).otherwise(F.col("p_type")).alias("term_30"),
        F.when(key % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("term_60"),
        F.when(key % 5 == 0, F.col("p_brand")).otherwise(F.lit("")).alias("term_198"),
    )


def fx_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(
            (F.col("c_custkey") + 1).cast("string"),
            F.lit("100021010"),
            (F.col("c_custkey") % 10).cast("string"),
        ).alias("sctid")
    )
