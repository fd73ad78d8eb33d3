"""Bronze -> silver graph: node and edge rules.

Each rule set reads bronze once. The three node rules are disjoint by event
type except the user rule, so one pass emits at most two candidate nodes per
event; edges are at most one per event. DISTINCT then runs as a partial
aggregate on the map side before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.functions.scalar import prefixed, root_folder_id, status_of
from tracewise.functions.vocabulary import (
    FILE_TYPES, NAMED_ENTITY, SHARE_ACCESS, SHARE_LINK, SHARE_PREFIX, SHARE_TYPES, USER_PREFIX,
)

NODE_COLUMNS = ["id", "name", "entity_type", "entity_role"]
EDGE_COLUMNS = ["id", "event_ts", "relationship", "src", "dst", "entity_sub_relationship",
                "item_type_shared", "status"]


def _node(id_col, type_col, role_col):
    return F.struct(id_col.alias("id"), id_col.alias("name"), type_col.alias("entity_type"),
                    role_col.cast("string").alias("entity_role"))


def silver_nodes(bronze: DataFrame) -> DataFrame:
    """UNION DISTINCT of the share-object, user and root-folder node rules."""
    m = "metadata."
    et = F.col("event_type")
    share_ok = et.isin(*SHARE_TYPES) & F.col(m + "itemSource").isNotNull() & F.col(m + "itemType").isNotNull()
    folder_ok = et.isin(*FILE_TYPES) & (F.length(F.col(m + "path")) > 1)
    user_ok = F.col("entity_id").isNotNull()
    share_id = prefixed(SHARE_PREFIX, F.col(m + "itemSource"))
    folder_id = root_folder_id(F.col(m + "path"))
    candidates = F.array(
        F.when(user_ok, _node(prefixed(USER_PREFIX, F.col("entity_id")), F.lit("user"), F.col("role"))),
        F.when(share_ok, _node(share_id, prefixed(SHARE_PREFIX, F.col(m + "itemType")), F.lit(None)))
         .when(folder_ok, _node(folder_id, F.lit("root_folder"), F.lit(None))),
    )
    return (bronze.filter(F.col("entity_type") == NAMED_ENTITY)
            .select(F.explode(candidates).alias("n"))
            .filter(F.col("n").isNotNull())
            .select("n.*")
            .distinct())


def silver_edges(bronze: DataFrame) -> DataFrame:
    """UNION DISTINCT of the sharing, share-access and file-action edge rules."""
    m = "metadata."
    et = F.col("event_type")
    is_link, is_access = et == SHARE_LINK, et == SHARE_ACCESS
    is_file = et.isin(*FILE_TYPES) & (F.length(F.col(m + "path")) > 1)
    owner = prefixed(USER_PREFIX, F.col(m + "uidOwner"))
    token = prefixed(USER_PREFIX, F.col(m + "token"))
    share = prefixed(SHARE_PREFIX, F.col(m + "itemSource"))
    return (bronze
            .filter((F.col("entity_type") == NAMED_ENTITY) & (is_link | is_access | is_file))
            .select(
                F.col("id"),
                F.col("event_ts"),
                et.alias("relationship"),
                F.when(is_link, owner).when(is_access, share)
                 .otherwise(prefixed(USER_PREFIX, F.col("entity_id"))).alias("src"),
                F.when(is_link, share).when(is_access, token)
                 .otherwise(root_folder_id(F.col(m + "path"))).alias("dst"),
                F.when(is_link, token).when(is_access, owner)
                 .otherwise(F.col(m + "path")).alias("entity_sub_relationship"),
                F.when(is_link | is_access, F.col(m + "itemType"))
                 .otherwise(F.lit("local_file")).alias("item_type_shared"),
                status_of(F.col(m + "errorCode")).alias("status"),
            )
            .distinct())


def active_batch_users(events: DataFrame, batch_start: str) -> DataFrame:
    """H4: distinct prefixed user keys of the active batch (named entities only, T7)."""
    return (events
            .filter((F.col("event_ts") >= F.to_timestamp(F.lit(batch_start)))
                    & (F.col("entity_type") == NAMED_ENTITY) & F.col("entity_id").isNotNull())
            .select(prefixed(USER_PREFIX, F.col("entity_id")).alias("entity_id"))
            .distinct())
