"""Questions asked of the social vault: who writes, who invites, how groups convert."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.money import ratio
from martloom.operators.aggregates import distinct_count
from martloom.operators.windows import oldest_n


def users_with_messages(l_user_message: DataFrame, l_groups_dialogs: DataFrame) -> DataFrame:
    """Distinct authors per group."""
    joined = l_user_message.select("hk_message_id", "hk_user_id").join(
        l_groups_dialogs.select("hk_message_id", "hk_group_id"), "hk_message_id"
    )
    return distinct_count(joined, ["hk_group_id"], "hk_user_id", "cnt_users_in_group_with_messages")


def added_users(
    history: DataFrame, activity: DataFrame, h_groups: DataFrame, n: int = 10, added_by: str = "inviter"
) -> DataFrame:
    """Distinct inviters (or, with ``added_by="user"``, distinct users who joined) in the ``n`` oldest groups."""
    # n rows, a bound given by the caller, cut the links before they meet the history.
    oldest = oldest_n(h_groups.select("hk_group_id", "group_id", "registration_dt"), "registration_dt", "group_id", n)
    links = activity.select("hk_l_user_group_activity", "hk_group_id", "hk_user_id").join(
        F.broadcast(oldest.select("hk_group_id")), "hk_group_id"
    )
    joined = history.where(F.col("event") == "add").select("hk_l_user_group_activity", "user_id_from").join(
        links, "hk_l_user_group_activity"
    )
    column = {"inviter": "user_id_from", "user": "hk_user_id"}[added_by]
    return distinct_count(joined, ["hk_group_id"], column, "cnt_added_users")


def group_conversion(added: DataFrame, writing: DataFrame) -> DataFrame:
    """Active authors per added user of each group."""
    joined = added.join(writing, "hk_group_id", "left")
    active = F.coalesce("cnt_users_in_group_with_messages", F.lit(0))
    return joined.select(
        "hk_group_id", "cnt_added_users", active.alias("cnt_users_in_group_with_messages"),
        ratio(active, F.col("cnt_added_users")).alias("group_conversion"),
    )


def ordered_conversion(mart: DataFrame) -> DataFrame:
    """The conversion mart with the best group first; the place of groups of one conversion goes by their key."""
    order = [F.col("group_conversion").desc(), F.col("hk_group_id")]
    # As many rows as groups, which the caller has bounded.
    return mart.withColumn("place", F.row_number().over(Window.orderBy(*order))).orderBy(*order)
