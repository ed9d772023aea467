"""The two refined tables: claims with their policy, transactions with their claim."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import names as n
from tidemark.functions.columns import named
from tidemark.operators.delta import Reference, affected_rows, referred_rows
from tidemark.operators.skew import skew_left_join
from tidemark.session import Staging

DELIVERY_COLUMNS = ("cyc_run_sk", "Soft_Delete", "GW_FINGERPRINT", "GW_TIMESTAMP", "ABC_AUDIT_DATE_TIME")

# --- fixed values: output column -> source column ------------------------------
DETAIL_FROM_CLAIM = {
    "id": "id",
    "claim_publicid": "publicid",
    "claimnumber": "claimnumber",
    "policyid": "policyid",
    "lossdate": "lossdate",
    "reporteddate": "reporteddate",
    "closeddate": "closeddate",
    "losscause": "losscause",
    "losstype": "losstype",
    "lossstate": "state",
    "catastropheid": "catastropheid",
    "assignedgroupid": "assignedgroupid",
    "assigneduserid": "assigneduserid",
    "claim_createtime": "createtime",
    "claim_updatetime": "updatetime",
}
DETAIL_FROM_POLICY = {
    "policynumber": "policynumber",
    "policytype": "policytype",
    "policy_effectivedate": "effectivedate",
    "policy_expirationdate": "expirationdate",
    "policy_status": "status",
    "premium": "premium",
    "insuranceline": "insuranceline",
}
FINANCIAL_FROM_TRANSACTION = {
    "id": "id",
    "transaction_publicid": "publicid",
    "claimid": "claimid",
    "amount": "amount",
    "currency": "currency",
    "transactiondate": "transactiondate",
    "transaction_status": "status",
    "costtype": "costtype",
    "costcategory": "costcategory",
    "reserveline": "reserveline",
    "transaction_createtime": "createtime",
    "transaction_updatetime": "updatetime",
}
FINANCIAL_FROM_CLAIM = {
    "claimnumber": "claimnumber",
    "lossdate": "lossdate",
    "losstype": "losstype",
    "lossstate": "state",
}


def _present(df: DataFrame, mapping: Mapping[str, str]) -> dict[str, str]:
    return {out: c for out, c in ((o, named(df, s)) for o, s in mapping.items()) if c}


def enrich(
    driving: DataFrame,
    lookup: DataFrame,
    foreign_key: str,
    from_driving: Mapping[str, str],
    from_lookup: Mapping[str, str],
    lookup_key: str = "id",
    salts: int = 0,
) -> DataFrame:
    """Live driving rows with columns of the row they refer to, if any (left outer).

    The soft-delete filter is on the driving side only: a deleted lookup row still joins.
    Both sides are cut to the columns used before they move. ``lookup`` is unique on its key,
    so no row multiplies. Rows without a foreign key skip the join, as they can be many and
    would all meet in one task. A key that many rows share is split by Spark at run time (AQE
    skew join); ``salts`` > 1 spreads such keys in the plan itself, at the price of one more
    pass over the foreign key column.
    """
    live = driving.filter(F.col(n.SOFT_DELETE) == "N")
    own, other = _present(driving, from_driving), _present(lookup, from_lookup)
    delivery = _present(driving, {c: c for c in DELIVERY_COLUMNS})
    left = live.select(
        *[F.col(c).alias(out) for out, c in own.items()],
        *[F.col(c).alias(out) for out, c in delivery.items()],
        F.col(foreign_key).alias("_fk"),
    )
    right = lookup.select(
        F.col(lookup_key).alias("_pk"), *[F.col(c).alias(out) for out, c in other.items()]
    )
    order = [*own, *other, *delivery]
    if salts > 1:
        return skew_left_join(left, right, "_fk", "_pk", F.col("id"), salts).select(*order)
    matched = left.filter(F.col("_fk").isNotNull()).join(right, F.col("_fk") == F.col("_pk"), "left")
    alone = left.filter(F.col("_fk").isNull())
    return matched.unionByName(alone, allowMissingColumns=True).select(*order)


def claim_detail(claims: DataFrame, policies: DataFrame, salts: int = 0) -> DataFrame:
    return enrich(
        claims, policies, "policyid", DETAIL_FROM_CLAIM, DETAIL_FROM_POLICY, salts=salts
    )


def claim_financial(transactions: DataFrame, claims: DataFrame, salts: int = 0) -> DataFrame:
    return enrich(
        transactions, claims, "claimid", FINANCIAL_FROM_TRANSACTION, FINANCIAL_FROM_CLAIM, salts=salts
    )


def _delta(driving: DataFrame, lookup: DataFrame, foreign_key: str, previous_run: int, staging: Staging):
    reference = Reference(lookup, foreign_key)
    rows = staging.put(affected_rows(driving, [reference], previous_run, staging), "affected")
    return rows, referred_rows(rows, reference, staging)


def claim_detail_delta(
    claims: DataFrame, policies: DataFrame, previous_run: int, staging: Staging, salts: int = 0
) -> DataFrame:
    """Rows of ``claim_detail`` that changes of claims or policies since ``previous_run`` touch."""
    return claim_detail(*_delta(claims, policies, "policyid", previous_run, staging), salts=salts)


def claim_financial_delta(
    transactions: DataFrame, claims: DataFrame, previous_run: int, staging: Staging, salts: int = 0
) -> DataFrame:
    """Rows of ``claim_financial`` that changes of transactions or claims since ``previous_run`` touch."""
    return claim_financial(*_delta(transactions, claims, "claimid", previous_run, staging), salts=salts)
