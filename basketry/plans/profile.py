"""The customer profile: value features, tiers, engagement and user data in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketry.operators.customers import (
    clv_features,
    clv_tier,
    engagement_features,
    unified_profile,
)


def customer_profile(
    transactions: DataFrame, sessions: DataFrame, users: DataFrame, exact: bool = True
) -> DataFrame:
    """One row per buyer, from cleaned transactions and users, and sessions.

    Reports on the profile read it several times: write it once (see ``reports``) and
    hand them the written table.
    """
    value = clv_tier(clv_features(transactions), exact=exact)
    return unified_profile(value, engagement_features(sessions), users)
