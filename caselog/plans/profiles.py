"""Counts that describe the data. Counts only: `denominator` names the metric to divide by."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselog.functions import has_no_items, n_items
from caselog.functions.text import NO_CODE, SOURCE_HARMONISED, SOURCE_NONE, SOURCE_VERBATIM
from caselog.operators.fanout import to_long
from caselog.operators.joins import cross_join_scalars

FATAL = "5"


def outcome_counts(react: DataFrame) -> DataFrame:
    """Reactions and cases, with and without probable duplicates, as one row.

    Reactions are first summed per report, then over reports. That gives the distinct counts of
    reports without a row copy per distinct count, and rides on the partitioning by report that
    the version collapse left behind.
    """
    kept = ~F.col("is_probable_duplicate")
    per_report = react.groupBy("safety_report_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("outcome_code") == NO_CODE).alias("n_no_code"),
        F.count_if(kept).alias("n_kept"),
        F.count_if(kept & (F.col("outcome_code") == FATAL)).alias("n_fatal"),
    )
    known = F.col("safety_report_id").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_report.agg(
        total("n").alias("reaction_events"),
        total("n_no_code").alias("reactions_no_outcome_code"),
        total("n_kept").alias("reaction_events_ex_duplicates"),
        F.count_if(known & (F.col("n_kept") > 0)).alias("cases_ex_duplicates"),
        F.count_if(known & (F.col("n_fatal") > 0)).alias("fatal_cases_ex_duplicates"),
    )


def headline_outcomes(react: DataFrame) -> DataFrame:
    """Cases, reactions and fatal cases, probable duplicates excluded. Deaths count per case."""
    return outcome_counts(react).select(
        F.col("cases_ex_duplicates").alias("cases"),
        F.col("reaction_events_ex_duplicates").alias("reactions"),
        F.col("fatal_cases_ex_duplicates").alias("fatal_cases"),
    )


def profile_cases(
    raw: DataFrame,
    stg: DataFrame,
    susp: DataFrame,
    react: DataFrame,
    drugs: DataFrame,
    terms: DataFrame,
) -> DataFrame:
    """18 metrics of the case reports. 'Flagged duplicate' here means any duplicate mark at all,
    unlike the models, which ask for the mark '1'."""
    landed = raw.agg(
        F.count("*").alias("raw_rows"),
        F.countDistinct("safetyreportid").alias("raw_distinct_cases"),
        F.countDistinct("receiptdateformat").alias("receipt_date_format_variants"),
    )
    staged = stg.agg(
        F.count("*").alias("staged_cases"),
        F.count("duplicate").alias("cases_flagged_duplicate"),
        F.count_if(has_no_items(F.col("reactions"))).alias("cases_no_reactions"),
        F.max("safety_report_version").alias("max_report_version"),
    )
    source = F.col("drug_name_source")
    suspects = susp.agg(
        F.count_if(source == SOURCE_HARMONISED).alias("drug_name_from_openfda"),
        F.count_if(source == SOURCE_VERBATIM).alias("drug_name_from_verbatim"),
        F.count_if(source == SOURCE_NONE).alias("drug_name_absent"),
        F.count_if(F.col("n_suspect_drugs") >= 2).alias("cases_multi_suspect"),
    )
    wide = cross_join_scalars(
        [
            landed,
            staged,
            suspects,
            outcome_counts(react),
            drugs.agg(F.count("*").alias("distinct_drug_names")),
            terms.agg(F.count("*").alias("distinct_reaction_terms")),
        ]
    )
    denominators = {
        "raw_distinct_cases": "raw_rows",
        "cases_flagged_duplicate": "staged_cases",
        "cases_no_reactions": "staged_cases",
        "drug_name_from_openfda": "staged_cases",
        "drug_name_from_verbatim": "staged_cases",
        "drug_name_absent": "staged_cases",
        "cases_multi_suspect": "staged_cases",
        "reactions_no_outcome_code": "reaction_events",
        "reaction_events_ex_duplicates": "reaction_events",
        "cases_ex_duplicates": "staged_cases",
        "fatal_cases_ex_duplicates": "cases_ex_duplicates",
    }
    return _all_columns_long(wide, denominators)


def profile_applications(raw: DataFrame, stg: DataFrame) -> DataFrame:
    """8 metrics of the applications."""
    landed = raw.agg(
        F.count("*").alias("raw_rows"),
        F.countDistinct("application_number").alias("raw_distinct_applications"),
        F.countDistinct("_batch_id").alias("raw_batches"),
    )
    products = n_items(F.col("products"))
    staged = stg.agg(
        F.count("*").alias("staged_applications"),
        F.count_if(F.col("openfda").isNull()).alias("applications_no_openfda"),
        F.count_if(has_no_items(F.col("products"))).alias("applications_no_products"),
        F.sum(products).alias("products_total"),
        F.max(products).alias("max_products_per_application"),
    )
    denominators = {
        "raw_distinct_applications": "raw_rows",
        "applications_no_openfda": "staged_applications",
        "applications_no_products": "staged_applications",
    }
    return _all_columns_long(cross_join_scalars([landed, staged]), denominators)


def profile_vocabulary(raw: DataFrame, stg: DataFrame) -> DataFrame:
    """8 metrics of the vocabulary. More tree numbers than distinct ones, or several per
    descriptor, tell that the hierarchy is no tree."""
    landed = raw.agg(
        F.count("*").alias("raw_rows"),
        F.countDistinct("descriptor_ui").alias("raw_distinct_descriptors"),
    )
    n_numbers = n_items(F.col("tree_numbers"))
    staged = stg.agg(
        F.count("*").alias("staged_descriptors"),
        F.count_if(n_numbers > 1).alias("descriptors_multi_tree"),
        F.count_if(has_no_items(F.col("tree_numbers"))).alias("descriptors_no_tree"),
        F.max(n_numbers).alias("max_tree_numbers_per_descriptor"),
    )
    numbers = explode_counts(stg, "tree_numbers")
    wide = cross_join_scalars(
        [landed, staged, numbers.toDF("tree_numbers_total", "tree_numbers_distinct")]
    )
    denominators = {
        "raw_distinct_descriptors": "raw_rows",
        "descriptors_multi_tree": "staged_descriptors",
        "descriptors_no_tree": "staged_descriptors",
        "tree_numbers_distinct": "tree_numbers_total",
    }
    return _all_columns_long(wide, denominators)


def explode_counts(df: DataFrame, arr: str) -> DataFrame:
    """Items of an array column over all rows: how many, and how many distinct ones."""
    return df.select(F.explode(arr).alias("item")).agg(
        F.count("item").alias("n_items"), F.countDistinct("item").alias("n_distinct")
    )


def _all_columns_long(wide: DataFrame, denominators: dict[str, str]) -> DataFrame:
    metrics = {c: (c, denominators.get(c)) for c in wide.columns}
    return to_long(wide, metrics).orderBy("metric")


def reconcile_rows(pairs: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Landed against staged rows per source: (raw log, staged rows, key path in the raw log).

    grain_gap is 0 where staging holds one row per key, and negative where keys were withdrawn.
    Distinct counts are exact.
    """
    landed = [
        raw.select(F.col(key).alias("_key"), "_source_file", "_batch_id")
        .agg(
            F.count("*").alias("landed_rows"),
            F.countDistinct("_key").alias("distinct_keys"),
            F.countDistinct("_source_file").alias("source_files"),
            F.countDistinct("_batch_id").alias("batches"),
        )
        .select(F.lit(name).alias("source_name"), "*")
        for name, (raw, _, key) in pairs.items()
    ]
    staged = [
        stg.agg(F.count("*").alias("staged_rows")).select(F.lit(name).alias("source_name"), "*")
        for name, (_, stg, _) in pairs.items()
    ]
    # One row per source on both sides.
    return (
        reduce(DataFrame.unionByName, landed)
        .join(F.broadcast(reduce(DataFrame.unionByName, staged)), "source_name")
        .select(
            "source_name",
            "landed_rows",
            "distinct_keys",
            "staged_rows",
            (F.col("landed_rows") - F.col("staged_rows")).alias("rows_removed"),
            (F.col("staged_rows") - F.col("distinct_keys")).alias("grain_gap"),
            "source_files",
            "batches",
        )
        .orderBy(F.desc("rows_removed"))
    )
