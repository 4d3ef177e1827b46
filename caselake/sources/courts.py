"""Court dimension: ids, display names, groups, lake/ingest membership.

The lake and ingest sets and the display labels are fixed values that must
equal the reference's for the same filtering and headers. The full 201-court
name list is not hard-coded: callers pass it as a DataFrame (id, name, group);
a court that it does not list is named by its label or id and has no group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ── Fixed values ────────────────────────────────────────────────────────────
# Courts whose opinions are kept in the lake (106 ids).
LAKE_COURTS = (
    "scotus",
    "ca1", "ca2", "ca3", "ca4", "ca5", "ca6", "ca7", "ca8", "ca9",
    "ca10", "ca11", "cadc", "cafc",
    "ala", "alaska", "ariz", "ark", "cal", "colo", "conn", "del", "dc",
    "fla", "ga", "haw", "idaho", "ill", "ind", "iowa", "kan", "ky", "la",
    "me", "md", "mass", "mich", "minn", "miss", "mo", "mont", "neb", "nev",
    "nh", "nj", "nm", "ny", "nc", "nd", "ohio", "okla", "or", "pa", "ri",
    "sc", "sd", "tenn", "tex", "utah", "vt", "va", "wash", "wva", "wis", "wyo",
    "alacivapp", "alacrimapp", "arizctapp", "arkctapp", "calctapp", "coloapp",
    "connappct", "flaapp", "gaapp", "idahoctapp", "illappct", "indctapp",
    "iowactapp", "kanctapp", "kyctapp", "laapp", "mdapp", "massappct",
    "michctapp", "minnctapp", "missctapp", "moapp", "nebctapp",
    "njsuperctappdiv", "nmctapp", "ncctapp", "ohioctapp", "oklaapp",
    "oklacrimapp", "orctapp", "pacommwct", "pasuperct", "scctapp",
    "tennctapp", "tenncrimapp", "texapp", "texcrimapp", "utahctapp",
    "vaapp", "washctapp", "wisctapp",
)
# Courts embedded into the vector tables.
INGEST_COURTS = ("sc", "scctapp")
# Header labels; any other court is shown by its id.
COURT_LABELS = {
    "sc": "SC Supreme Court",
    "scctapp": "SC Court of Appeals",
    "scotus": "US Supreme Court",
    "ca4": "4th Circuit Court of Appeals",
}
# ── End of fixed values ─────────────────────────────────────────────────────


def court_label(court) -> Column:
    """J7 for the fixed labels as a map lookup (no join): label, else the id."""
    c = F.col(court) if isinstance(court, str) else court
    pairs = []
    for k, v in COURT_LABELS.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*pairs)[c], c)


def court_dimension(spark: SparkSession, court_ids: DataFrame | None = None,
                    names: DataFrame | None = None) -> DataFrame:
    """One row per court: id, name, group, label, in_lake, in_ingest.

    ``court_ids``: a one-column DataFrame (``court_id``) of the courts to describe,
    e.g. the distinct courts of a dockets table; defaults to the lake set.
    ``names``: optional (id, name, group) rows; the group of a court not listed is null.
    """
    if court_ids is None:
        court_ids = spark.createDataFrame([(c,) for c in LAKE_COURTS], "court_id string")
    dim = court_ids.select(F.col("court_id").alias("id")).distinct()
    if names is not None:
        dim = dim.join(names.select("id", F.col("name").alias("_name"), F.col("group").alias("_group")), "id", "left")
    else:
        dim = dim.withColumn("_name", F.lit(None).cast("string")).withColumn("_group", F.lit(None).cast("string"))
    label = court_label(F.col("id"))
    return dim.select(
        "id",
        F.coalesce(F.col("_name"), label).alias("name"),
        F.col("_group").alias("group"),
        label.alias("label"),
        F.col("id").isin(list(LAKE_COURTS)).alias("in_lake"),
        F.col("id").isin(list(INGEST_COURTS)).alias("in_ingest"),
    )


def search_courts(dim: DataFrame, query: str) -> DataFrame:
    """Case-insensitive substring match on name or id; blank query returns all."""
    q = (query or "").strip().lower()
    if not q:
        return dim
    return dim.where(F.lower("name").contains(q) | F.lower("id").contains(q))
