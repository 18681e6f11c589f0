"""Column contracts of the staging tables and the payment fact.

These tables are read with these types; the other facts and the dimensions with
the types of the frames that were written.
Timestamps carry no zone, money is ``decimal(15,2)``, ids are 64 bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "id": T.LongType(),
    "int": T.IntegerType(),
    "text": T.StringType(),
    "money": T.DecimalType(15, 2),
    "rate": T.DecimalType(20, 4),
    "flag": T.BooleanType(),
    "date": T.DateType(),
    "ts": T.TimestampNTZType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


REQUESTS = _schema(
    request_id="id", reference="text", status="text", current_step="int",
    request_type="text", operator_id="id", company_id="id", plot_id="id", zone_id="id",
    priority="text", financing_amount="money", total_jobs="int", is_priority="flag",
    created_at="ts", modified_at="ts", processing_days="int",
    is_finalised="flag", is_accepted="flag",
)
COMPANIES = _schema(
    company_id="id", company_name="text", phone="text", email="text",
    trade_register="text", tax_account="text", legal_form="text", address="text",
    founded_on="date", activity_id="id", created_at="ts", modified_at="ts",
)
PLOTS = _schema(
    plot_id="id", plot_number="text", block="text", area="money", area_unit="text",
    price="money", status="text", priority="text", is_serviced="flag",
    description="text", coordinates="text", zone_id="id", company_id="id",
    operator_id="id", acquired_on="date", reserved_on="date", option_days="int",
    created_at="ts", modified_at="ts",
)
ZONES = _schema(
    zone_id="id", zone_code="text", zone_name="text", description="text", area="money",
    area_unit="text", plots_available="int", address="text", status="text", region="text",
    created_at="ts", modified_at="ts",
)
RECEIVABLES = _schema(
    receivable_id="id", reference="text", receivable_type="text", amount_due="money",
    amount_collected="money", status="text", created_on="date", due_on="date",
    recovered_on="date", agent_id="id", company_id="id", plot_id="id", zone_id="id",
    request_id="id", notes="text", modified_at="ts",
)
AGENTS = _schema(
    agent_id="id", agent_name="text", badge_number="text", job_title="text", zone_id="id",
    phone="text", email="text", status="text", hired_on="date", created_on="date",
    modified_at="ts",
)
RECOVERIES = _schema(
    recovery_id="id", receivable_id="id", action_type="text", action_on="date",
    payment="money", payment_mode="text", agent_id="id", status="text", notes="text",
    document="text", created_on="date", modified_at="ts",
)
PAYMENTS = _schema(
    payment_key="text", transaction_type="text", source_id="id", payment_date_key="int",
    payment_date="date", company_key="text", zone_key="text", agent_id="id",
    payment_method="text", payment_status="text", amount_billed="money",
    amount_paid="money", fee="money", amount_net="money", payment_days="int",
    payment_rate="rate", is_complete="flag", is_late="flag", payment_reference="text",
    notes="text", etl_batch_id="text",
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a contract: exactly these columns, in order, with these types.

    A missing column fails at analysis time, before any row is read.
    """
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields])
