"""One warehouse: staging frames in, dimensions, facts and views out.

Every attribute is a lazily built plan; nothing runs until a result is written
or fetched.  The same attribute names are served by ``StoredWarehouse`` from the
tables a load job has written, so KPIs do not care where their input comes from.
"""

from __future__ import annotations

import datetime as dt
import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from landledger import schemas
from landledger.operators import agents as agent_dim
from landledger.operators import clean, dimensions, facts, payments
from landledger.session import exists
from landledger.sources import seeds

TABLES = (
    "requests", "companies", "plots", "zones",
    "dim_company", "dim_plot", "dim_zone", "dim_request_status", "dim_date", "dim_agent",
    "dim_receivable_type", "dim_receivable_status", "dim_payment_mode",
    "fact_requests", "fact_receivables", "fact_recoveries", "fact_payments", "quarantine",
)


class Warehouse:
    """Warehouse planned directly on top of staging frames."""

    def __init__(self, spark: SparkSession, staging, as_of, batch_id: str,
                 calendar: tuple[dt.date, dt.date] | None = None):
        self.spark = spark
        self.staging = staging
        self.as_of = as_of
        self.batch_id = batch_id
        self.calendar = calendar

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    # staging
    @property
    def requests(self) -> DataFrame:
        return self.staging.requests

    @property
    def companies(self) -> DataFrame:
        return self.staging.companies

    @property
    def plots(self) -> DataFrame:
        return self.staging.plots

    @property
    def zones(self) -> DataFrame:
        return self.staging.zones

    # dimensions
    @cached_property
    def dim_company(self) -> DataFrame:
        return dimensions.dim_company(self.companies)

    @cached_property
    def dim_plot(self) -> DataFrame:
        return dimensions.dim_plot(self.plots)

    @cached_property
    def dim_zone(self) -> DataFrame:
        return dimensions.dim_zone(self.zones)

    @cached_property
    def dim_request_status(self) -> DataFrame:
        return dimensions.dim_request_status(self.requests)

    @cached_property
    def dim_date(self) -> DataFrame:
        """The calendar; without given bounds, over all days found in the requests."""
        spine = (dimensions.date_spine(self.spark, *self.calendar) if self.calendar
                 else dimensions.request_days(self.requests))
        return dimensions.dim_date(spine)

    @cached_property
    def dim_agent(self) -> DataFrame:
        cleaned = clean.clean_agents(self.staging.agents)
        return agent_dim.first_versions(cleaned, self.as_of)

    @cached_property
    def dim_receivable_type(self) -> DataFrame:
        return seeds.receivable_types(self.spark)

    @cached_property
    def dim_receivable_status(self) -> DataFrame:
        return seeds.receivable_statuses(self.spark)

    @cached_property
    def dim_payment_mode(self) -> DataFrame:
        return seeds.payment_modes(self.spark)

    # facts
    @cached_property
    def fact_requests(self) -> DataFrame:
        return facts.fact_requests(self.requests)

    @cached_property
    def fact_receivables(self) -> DataFrame:
        cleaned = clean.clean_receivables(self.staging.receivables)
        return facts.fact_receivables(cleaned, self.batch_id)

    @cached_property
    def quarantine(self) -> DataFrame:
        cleaned = clean.clean_receivables(self.staging.receivables)
        return facts.quarantined_receivables(cleaned, self.batch_id)

    @cached_property
    def fact_recoveries(self) -> DataFrame:
        cleaned = clean.clean_recoveries(self.staging.recoveries)
        return facts.fact_recoveries(cleaned, self.fact_receivables, self.batch_id)

    @cached_property
    def fact_payments(self) -> DataFrame:
        # not every payment KPI needs the receivable behind an action
        cleaned = clean.clean_recoveries(self.staging.recoveries)
        actions = facts.fact_recoveries(cleaned, self.fact_receivables, self.batch_id, state_unique=True)
        return payments.build_payments(
            self.fact_receivables, actions,
            f"{self.batch_id}_COLLECTES", f"{self.batch_id}_RECOUVREMENTS")


def request_table(load_id: str) -> str:
    """Catalog name of a load's request fact, which is bucketed by request."""
    return "fact_requests_" + "".join(c if c.isalnum() else "_" for c in load_id).lower()


class StoredWarehouse:
    """The same tables, read from what the jobs have written.

    Request tables are read from ``load_id``, collection tables from
    ``batch_id`` (the same id unless given); the merged facts have one current state
    and the payments follow from them.  ``as_of`` is the day for which lateness is reported.
    """

    _contracts = {"requests": schemas.REQUESTS, "companies": schemas.COMPANIES, "plots": schemas.PLOTS,
                  "zones": schemas.ZONES}
    _collection = {"dim_agent", "dim_receivable_type", "dim_receivable_status", "dim_payment_mode",
                   "quarantine"}
    _merged = {"fact_receivables", "fact_recoveries"}

    def __init__(self, spark: SparkSession, path: str, load_id: str, batch_id: str | None = None,
                 as_of=None):
        self.spark, self.path, self.as_of = spark, path, as_of
        self.load_id, self.batch_id = load_id, batch_id or load_id

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name == "fact_payments":  # one row per receivable and action, as they stand
            return payments.current_payments(self.fact_receivables, self.fact_recoveries)
        if name == "fact_requests" and self.spark.catalog.tableExists(request_table(self.load_id)):
            return self.spark.table(request_table(self.load_id))
        place = os.path.join(self.path, name)
        if name not in self._merged:
            load = self.batch_id if name in self._collection else self.load_id
            place = os.path.join(place, f"load_id={load}")
        reader = self.spark.read
        if name in self._contracts:
            reader = reader.schema(self._contracts[name])
        elif name in self._merged:  # a fact may have no rows yet; its batches tell the types
            batch = os.path.join(self.path, f"{name}_batch", f"load_id={self.batch_id}")
            if exists(self.spark, batch):
                reader = reader.schema(self.spark.read.parquet(batch).schema)
        return reader.parquet(place)

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)
