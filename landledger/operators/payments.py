"""The payment fact, derived from receivables and recovery actions.

A receivable or action has one payment, with the amounts as they stand: the payment
fact is a projection of the two merged facts.  What each batch added or took back is
kept beside it as movements, differences against what other batches have recorded,
so the movements of a payment always add up to its amounts.

Durations, methods and reference numbers that the source system does not hold
are drawn from a hash of the source id, so a re-run gives the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger import schemas
from landledger.functions import scalars as s

COLLECTION = "COLLECTE"
RECOVERY = "RECOUVREMENT"
PAID_IN_FULL = "PAYE_COMPLET"
PAID_IN_PART = "PAYE_PARTIEL"
UNPAID = "IMPAYE"
RECOVERED = "RECOUVRE"
SUCCESSFUL = (PAID_IN_FULL, PAID_IN_PART, RECOVERED)

# Fixed values of the payment rules.
FULL_RATE = "0.95"
PART_RATE = "0.5"
COLLECTION_FEE = "0.02"
RECOVERY_FEE = "0.03"
RECOVERY_BILLING = "1.2"
COLLECTION_DAYS = (15, 45)
RECOVERY_DAYS = (45, 90)
LATE_AFTER_DAYS = 30
COLLECTION_METHODS = ("VIREMENT", "CHEQUE", "ESPECE")
RECOVERY_METHODS = ("VIREMENT", "CHEQUE")
DEFAULT_ZONE = "ZONE_DEFAULT"


def _factor(text: str):
    return F.lit(text).cast("decimal(4,2)")


def _keys(transaction: str, source_id: str, date_key: str) -> dict:
    """Payment key and reference; the key pairs the source with its own id.

    The reference is a printed number drawn from 9 000 per day: it repeats and is
    no key.
    """
    key = s.prefixed_key(f"{transaction}_", F.col(source_id))
    number = s.hash_range(F.concat(F.lit("ref_"), key), 1000, 9999)
    return {
        "payment_key": key,
        "transaction_type": F.lit(transaction),
        "source_id": F.col(source_id),
        "payment_date_key": F.col(date_key),
        "payment_reference": F.concat(F.lit("PAY"), F.col(date_key).cast("string"), number.cast("string")),
    }


def _tag(batch_id: str | Column) -> Column:
    return F.lit(batch_id) if isinstance(batch_id, str) else batch_id


def payments_from_receivables(receivable_facts: DataFrame, batch_id: str | Column) -> DataFrame:
    """Payments behind the receivables: 2 % fee, status by recovery rate."""
    due, paid = F.col("amount_due"), F.col("amount_collected")
    rate = F.coalesce(F.col("recovery_rate"), F.lit(0))
    complete = rate >= _factor(FULL_RATE)
    payments = receivable_facts.withColumns(
        _keys(COLLECTION, "receivable_fact_key", "created_date_key")
    ).withColumns({
        "payment_date": F.col("created_on"),
        "payment_method": s.hash_choice(F.concat(F.lit("method_"), "payment_key"), COLLECTION_METHODS),
        "payment_status": F.when(complete, PAID_IN_FULL)
                           .when(rate >= _factor(PART_RATE), PAID_IN_PART)
                           .otherwise(UNPAID),
        "amount_billed": due,
        "amount_paid": paid,
        "fee": due * _factor(COLLECTION_FEE),
        "amount_net": paid - due * _factor(COLLECTION_FEE),
        "payment_days": s.hash_range(F.concat(F.lit("days_"), "payment_key"), *COLLECTION_DAYS),
        "payment_rate": rate,
        "is_complete": complete,
        "notes": F.concat(F.lit("receivable "), F.col("receivable_fact_key").cast("string")),
        "etl_batch_id": _tag(batch_id),
    }).withColumn("is_late", F.col("payment_days") > LATE_AFTER_DAYS)
    return schemas.conform(payments, schemas.PAYMENTS)


def payments_from_recoveries(recovery_facts: DataFrame, batch_id: str | Column) -> DataFrame:
    """Payments behind recovery actions: 3 % fee, billed at 1.2, always late.

    ``effectiveness`` may exceed 1 when an action brings in more than was due;
    the rate is stored as it is.
    """
    paid = F.col("payment")
    rate = F.coalesce(F.col("effectiveness"), F.lit(0))
    payments = recovery_facts.withColumns(
        _keys(RECOVERY, "recovery_fact_key", "action_date_key")
    ).withColumns({
        "payment_date": F.col("action_on"),
        "zone_key": F.lit(DEFAULT_ZONE),
        "payment_method": s.hash_choice(F.concat(F.lit("method_"), "payment_key"), RECOVERY_METHODS),
        "payment_status": F.when(rate > 0, RECOVERED).otherwise(UNPAID),
        "amount_billed": paid * _factor(RECOVERY_BILLING),
        "amount_paid": paid,
        "fee": paid * _factor(RECOVERY_FEE),
        "amount_net": paid - paid * _factor(RECOVERY_FEE),
        "payment_days": s.hash_range(F.concat(F.lit("days_"), "payment_key"), *RECOVERY_DAYS),
        "payment_rate": rate,
        "is_complete": rate >= _factor(FULL_RATE),
        "is_late": F.lit(True),
        "notes": F.concat(F.lit("recovery "), F.col("recovery_fact_key").cast("string")),
        "etl_batch_id": _tag(batch_id),
    })
    return schemas.conform(payments, schemas.PAYMENTS)


def build_payments(receivable_facts: DataFrame, recovery_facts: DataFrame,
                   collection_batch: str | Column, recovery_batch: str | Column) -> DataFrame:
    """Both payment sources in one fact."""
    return payments_from_receivables(receivable_facts, collection_batch).unionByName(
        payments_from_recoveries(recovery_facts, recovery_batch))


def batch_tags(batch: Column) -> tuple[Column, Column]:
    """Payment tags of a load: one for receivables, one for recovery actions."""
    return F.concat(batch, F.lit("_COLLECTES")), F.concat(batch, F.lit("_RECOUVREMENTS"))


def current_payments(receivable_facts: DataFrame, recovery_facts: DataFrame) -> DataFrame:
    """One payment per row of the merged facts, under the tag of the batch that changed
    it last.  A projection: no row moves, and there is no second copy to keep right."""
    return build_payments(receivable_facts, recovery_facts, *batch_tags(F.col("etl_batch_id")))


# --- movements ------------------------------------------------------------------------

MOVED = ("amount_billed", "amount_paid", "fee", "amount_net")
MOVEMENT_MONTH = "payment_month"


def payment_movements(payments: DataFrame, recorded: DataFrame, tags: tuple[str, str]) -> DataFrame:
    """What the batch ``tags`` changes: the amounts of ``payments`` as they stand now,
    less the movements that other batches have ``recorded`` for them.

    A payment seen first is a movement of all its amounts, also of nothing paid yet;
    one whose amounts did not change is none; a lower amount is a negative movement.
    Repeating a batch, in any order with others, gives movements that again add up.
    Both sides hold one row per payment when they meet, so no key is hot.
    """
    before = recorded.filter(~F.col("etl_batch_id").isin(*tags)).groupBy("payment_key").agg(
        *[F.sum(c).alias(f"_before_{c}") for c in MOVED])
    moved = {c: (F.col(c) - F.coalesce(F.col(f"_before_{c}"), F.lit(0))).cast(s.MONEY) for c in MOVED}
    first = F.col("_before_amount_billed").isNull()
    tag = F.when(F.col("transaction_type") == COLLECTION, tags[0]).otherwise(tags[1])
    return (payments.join(before, "payment_key", "left").select(
        "payment_key", "transaction_type", "source_id", "payment_date", "payment_status",
        *[v.alias(c) for c, v in moved.items()],
        payment_month().alias(MOVEMENT_MONTH), tag.alias("etl_batch_id"), first.alias("_first"))
        .filter(F.col("_first") | reduce(lambda a, b: a | b, [F.col(c) != 0 for c in MOVED]))
        .drop("_first"))


def payment_month() -> Column:
    """Year and month of the payment date as a number, 0 when unknown."""
    return F.coalesce((F.col("payment_date_key") / 100).cast("int"), F.lit(0))
