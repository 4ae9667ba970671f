"""Row policies, column masks, PII tagging and lineage."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from tidemark.session import settle

# What counts as personal data.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+?[0-9]{1,3}[-. ][0-9]{3}[-. ][0-9]{3,4}[-. ]?[0-9]{0,4}",
    "ipv4": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}


def row_policy(
    df: DataFrame,
    column: str,
    user: str,
    grants: DataFrame,
    groups: Collection[str] = (),
    admin_group: str = "admins",
) -> DataFrame:
    """Rows whose ``column`` is granted to ``user`` in ``grants(user, value)``.

    Members of the admin group see everything, users without a grant nothing.
    """
    if admin_group in groups:
        return df
    mine = grants.filter(F.col("user") == user).select(F.col("value").alias(column)).distinct()
    return df.join(mine, column, "left_semi")


def mask_email(c: Column) -> Column:
    """First two characters and the domain; a value without ``@`` is hidden whole."""
    domain = F.get(F.split(c, "@"), F.lit(1))
    masked = F.concat(F.substring(c, 1, 2), F.lit("***@"), domain)
    return F.when(c.isNotNull(), F.when(domain.isNull(), F.lit("***")).otherwise(masked))


def mask_phone(c: Column) -> Column:
    return F.when(c.isNotNull(), F.concat(F.lit("***-***-"), F.substring(c, -4, 4)))


def mask_fixed(shown: str):
    def mask(c: Column) -> Column:
        return F.when(c.isNotNull(), F.lit(shown))

    return mask


MASKS = {
    "email": mask_email,
    "phone": mask_phone,
    "salary": mask_fixed("***"),
    "ssn": mask_fixed("***-**-****"),
}


def mask_columns(
    df: DataFrame,
    masks: dict[str, str],
    groups: Collection[str] = (),
    clear_group: str = "data_engineers",
) -> DataFrame:
    """Apply the named mask to each column unless the reader is in the clear group."""
    if clear_group in groups:
        return df
    return df.withColumns({c: MASKS[kind](F.col(c)) for c, kind in masks.items()})


def classify_columns(df: DataFrame, table: str, threshold: float = 0.01) -> DataFrame:
    """Tag text columns by the share of rows with a hit, in one pass over the table."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    pairs = [(c, kind) for c in text for kind in PII_PATTERNS]
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).rlike(PII_PATTERNS[k])).alias(f"h{i}") for i, (c, k) in enumerate(pairs)],
    )
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(k).alias("kind"),
            F.when(F.col("n") > 0, F.col(f"h{i}") / F.col("n")).alias("hit_rate"),
        )
        for i, (c, k) in enumerate(pairs)
    ]
    tagged = one.select(F.inline(F.array(*rows)))
    return tagged.withColumn("pii", F.coalesce(F.col("hit_rate") >= threshold, F.lit(False)))


def upstream(edges: DataFrame) -> DataFrame:
    """Every ``(node, upstream, depth)`` along ``edges(node, upstream)``, chains of any length.

    A pair met on several paths keeps its shortest depth, so cycles end too. Each
    step joins the newest pairs with the edge list and drops the known ones; it is
    stored, so no step is worked out twice. It ends when a step finds nothing new.
    """
    step = settle(edges.select("node", "upstream").distinct(), "lineage-edges")
    hop = step.select(F.col("node").alias("upstream"), F.col("upstream").alias("__next"))
    known, depth = step.withColumn("depth", F.lit(1).cast("long")), 1
    frontier = step
    while True:
        depth += 1
        further = frontier.join(hop, "upstream").select("node", F.col("__next").alias("upstream")).distinct()
        frontier = settle(further.join(known, ["node", "upstream"], "left_anti"), "lineage-step")
        if frontier.isEmpty():
            return known
        known = known.unionByName(frontier.withColumn("depth", F.lit(depth).cast("long")))


def paged_sets(
    df: DataFrame, keys: Sequence[str], member: str, page: int = 1000
) -> DataFrame:
    """Distinct integer members per key as sorted lists, a page of ids per row.

    One row per key would grow without bound; a page holds at most ``page`` ids.
    """
    pairs = df.select(*keys, member).distinct()
    return (
        pairs.withColumn("page", F.floor(F.col(member) / page))
        .groupBy(*keys, "page")
        .agg(F.sort_array(F.collect_set(member)).alias("members"))
    )
