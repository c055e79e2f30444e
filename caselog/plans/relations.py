"""Relations between the staged sources: names, suspects, the descriptor tree and the catalogue's history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from caselog.functions import clean_text, name_source
from caselog.operators.fanout import fan_out
from caselog.operators.similar import SHARE, within_edits
from caselog.plans.intermediate import drug_name_of, suspects_of
from caselog.sources.storage import save


def suspect_bridge(stg: DataFrame) -> DataFrame:
    """One row per suspect of a report, in the order listed, with its share of the report. The first
    one is the suspect the star attributes a report to; reports without suspects have no row."""
    listed = stg.select("safety_report_id", suspects_of(F.col("drugs")).alias("suspects"))
    rows = fan_out(listed.withColumn("weight", 1 / F.size("suspects")), "suspects", "suspect_seq", "suspect")
    return rows.select(
        "safety_report_id",
        "suspect_seq",
        F.coalesce(drug_name_of(F.col("suspect"))).alias("drug_name"),
        name_source(F.col("suspect")).alias("drug_name_source"),
        "weight",
    )


def application_names(applications: DataFrame) -> DataFrame:
    """Distinct (application_number, drug_name) of the product names, normalised as report names are."""
    products = fan_out(applications.select("application_number", "products"), "products", "product_seq", "product")
    named = products.select("application_number", clean_text(F.col("product.brand_name")).alias("drug_name"))
    return named.where(F.col("drug_name").isNotNull()).distinct()


def drug_crosswalk(drugs: DataFrame, applications: DataFrame) -> DataFrame:
    """(drug_name, application_number) for every name of the drug dimension, NULL where no application
    has it. Both sides are distinct names first, so the join sees each name once per application."""
    names = drugs.select("drug_name").distinct()
    return names.join(application_names(applications), "drug_name", "left")


def _names_in(df: DataFrame, path: str) -> Column | None:
    """The names at a path of nested fields, of which arrays may be, as one array; None if the schema lacks it."""
    column, kind, depth = None, df.schema, 0
    for part in path.split("."):
        if not isinstance(kind, StructType) or part not in kind.fieldNames():
            return None
        column, kind = (F.col(part) if column is None else column[part]), kind[part].dataType
        # a field of an array's items is an array of them, and of arrays an array of arrays
        while isinstance(kind, ArrayType):
            kind, depth = kind.elementType, depth + 1
            if depth > 1:
                column, depth = F.flatten(column), 1
    return column if depth else F.array(column)


# Where an application names its drug, and what the name is called here. A declared schema need
# not have all of them.
NAME_PATHS = {
    "products.brand_name": "brand",
    "openfda.brand_name": "harmonised",
    "openfda.generic_name": "harmonised",
    "openfda.substance_name": "ingredient",
    "products.active_ingredients.name": "ingredient",
}


def registered_names(applications: DataFrame) -> DataFrame:
    """Distinct (application_number, source, drug_name): brand names, harmonised names and ingredients, normalised
    as report names are."""
    def labelled(names: Column, source: str) -> Column:
        return F.transform(names, lambda n: F.struct(F.lit(source).alias("source"), n.cast("string").alias("name")))

    found = [labelled(c, source) for path, source in NAME_PATHS.items() if (c := _names_in(applications, path)) is not None]
    empty = F.array().cast("array<struct<source:string,name:string>>")
    every = F.concat(*[F.coalesce(c, empty) for c in found])
    named = applications.select("application_number", F.inline(every))
    named = named.select("application_number", "source", clean_text(F.col("name")).alias("drug_name"))
    return named.where(F.col("drug_name").isNotNull()).distinct()


def nearest_crosswalk(names: DataFrame, registered: DataFrame, share: int = SHARE) -> DataFrame:
    """(drug_name, application_number, source, registered_name, distance): for every distinct name the registered ones
    nearest to it, equal ones first, else those within its allowed edits; NULL where there are none.

    Equal names are found by a join alone, so only the others are cut into segments, and only distinct names
    are compared, however many reports and applications have them.
    """
    names = save(names.select("drug_name").where(F.col("drug_name").isNotNull()).distinct(), "names")
    registered = save(registered, "registered")
    known = registered.select(F.col("drug_name").alias("name")).distinct()
    left = names.select(F.col("drug_name").alias("name"))
    equal = left.join(known, "name").select("name", F.col("name").alias("other"), F.lit(0).alias("distance"))
    near = save(within_edits(left.join(known, "name", "left_anti"), known, share=share), "near")
    least = near.groupBy("name").agg(F.min("distance").alias("distance"))
    links = equal.unionByName(near.join(least, ["name", "distance"]).select("name", "other", "distance"))
    rows = links.join(registered.withColumnRenamed("drug_name", "other"), "other")
    rows = rows.select(F.col("name").alias("drug_name"), "application_number", "source", F.col("other").alias("registered_name"), "distance")
    return names.join(rows, "drug_name", "left")


def descriptor_ancestors(descriptors: DataFrame) -> DataFrame:
    """(descriptor_ui, tree_number, ancestor_number, depth, parent_number): every prefix of each tree
    number, itself included, without recursion, and the number above it. Depth counts from the root, 1,
    which has no parent. A descriptor without tree numbers has one row, all else NULL."""
    numbers = descriptors.select("descriptor_ui", F.explode_outer("tree_numbers").alias("tree_number"))
    parts = F.split("tree_number", r"\.")
    places = F.when(F.col("tree_number").isNotNull(), F.sequence(F.lit(1), F.size(parts)))
    depths = numbers.withColumn("depth", F.explode_outer(places))
    prefix = lambda n: F.array_join(F.slice(parts, F.lit(1), n), ".")
    parent = F.when(F.col("depth") > 1, prefix(F.col("depth") - 1))
    return depths.select(
        "descriptor_ui", "tree_number", prefix(F.col("depth")).alias("ancestor_number"), "depth", parent.alias("parent_number")
    )


def descriptor_hierarchy(descriptors: DataFrame) -> DataFrame:
    """Per tree number of any depth: how many descriptors are at or below it."""
    return descriptor_edges(descriptors).where("ancestor_number is not null").drop("parent_number")


def descriptor_edges(descriptors: DataFrame) -> DataFrame:
    """Per tree number of any depth, with its parent: how many descriptors are at or below it. Those
    without a position are counted under NULL."""
    return (
        descriptor_ancestors(descriptors)
        .groupBy("ancestor_number", "parent_number", "depth")
        .agg(F.countDistinct("descriptor_ui").alias("n_descriptors"))
    )


def snapshots(log: DataFrame, key: str, content: list[str], batch_col: str = "_batch_id") -> DataFrame:
    """History of a catalogue that lands whole: (key, content, valid_from, valid_to) per version.

    A version ends with the first batch in which the key has other content or is missing, a hard
    delete; the current ones have no end. Rows of a key in one batch must agree, or the last by
    `_pulled_at` and file counts.
    """
    by_batch = Window.partitionBy(key, batch_col).orderBy(F.desc("_pulled_at"), F.desc("_source_file"))
    rows = log.withColumn("_rank", F.row_number().over(by_batch)).where("_rank = 1")
    batches = log.select(F.col(batch_col).alias("_at")).distinct()
    batches = batches.withColumn("_next", F.lead("_at").over(Window.orderBy("_at")))
    rows = rows.join(batches, rows[batch_col] == batches["_at"])
    by_key = Window.partitionBy(key).orderBy(batch_col)
    state = F.struct(*content)
    same = F.equal_null(F.lag(state).over(by_key), state) & (F.lag("_next").over(by_key) == F.col(batch_col))
    versions = rows.withColumn("_new", (~F.coalesce(same, F.lit(False))).cast("int"))
    versions = versions.withColumn("_version", F.sum("_new").over(by_key))
    return (
        versions.groupBy(key, "_version")
        .agg(
            F.min(F.struct(batch_col, state.alias("state"))).alias("first"),
            F.max(F.struct(F.col(batch_col), F.col("_next").alias("end"))).alias("last"),
        )
        .select(key, "first.state.*", F.col(f"first.{batch_col}").alias("valid_from"), F.col("last.end").alias("valid_to"))
    )
