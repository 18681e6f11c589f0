"""Binding of the shared sample tables (orders, lineitem, events, ...) to the
source and staging contracts of the warehouse.

Orders stand for land requests, customers for companies, parts for plots,
nations for zones, orders with line items for receivables, suppliers for agents
and events for recovery actions.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger import schemas
from landledger.functions import scalars as s
from landledger.operators.dimensions import IN_ZONE, OUT_OF_ZONE
from landledger.sources import extract
from landledger.warehouse import Warehouse

REQUESTS_AS_OF = "2001-12-31"     # the day pending requests are aged to
COLLECTIONS_AS_OF = "2024-01-31"  # the day of the agent and recovery windows
CALENDAR = (dt.date(1990, 1, 1), dt.date(2030, 12, 31))
BATCH = "LOAD_1"


def _money(column: str) -> Column:
    return F.col(column).cast(s.MONEY)


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _case(column: str, codes: dict, otherwise: str) -> Column:
    """Chained CASE over a column with few values."""
    chain = None
    for value, code in codes.items():
        test = F.col(column) == value
        chain = F.when(test, code) if chain is None else chain.when(test, code)
    return chain.otherwise(otherwise)


def _notation(column: str, number: Column) -> Column:
    """A price as 1234.50, 1,234.50, 1.234,50 or 1 234,50."""
    plain, grouped = _money(column).cast("string"), F.format_number(_money(column), 2)
    return (F.when(number == 0, plain).when(number == 1, grouped)
             .when(number == 2, F.translate(grouped, ",.", ".,"))
             .otherwise(F.translate(grouped, ",.", " ,")))


class SampleTables:
    """Raw and staged frames over one folder of sample tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # --- line items per order ---------------------------------------------------

    @cached_property
    def order_lines(self) -> DataFrame:
        """Line items folded to one row per order.

        Partially aggregated before the exchange, so an order holding much of
        the line items is a handful of rows by then.  Columns a query does not
        use are pruned from the scan and the aggregate.
        """
        return self._fold(self.table("lineitem"))

    def _fold(self, lineitem: DataFrame) -> DataFrame:
        flagged = F.col("l_linestatus") == "F"
        # prices have two decimals: summed in cents they stay exact, and the sum of
        # one order fits a 64-bit buffer, which a decimal sum would not
        lines = lineitem.withColumn("cents", F.rint(F.col("l_extendedprice") * 100).cast("bigint"))
        return lines.groupBy("l_orderkey").agg(
            F.sum(F.col("l_quantity").cast("int")).cast("int").alias("jobs"),
            F.max("l_shipdate").alias("last_ship"),
            F.min("l_partkey").alias("first_part"),
            F.min("l_suppkey").alias("first_supplier"),
            # the one-letter flag as a number: a fixed-width buffer keeps this a hash aggregate
            F.min(F.ascii("l_returnflag")).alias("first_flag"),
            (F.sum("cents").cast("decimal(19,0)") / 100).cast(s.MONEY).alias("due"),
            (F.sum(F.when(flagged, F.col("cents"))).cast("decimal(19,0)") / 100).cast(s.MONEY).alias("paid"),
            F.max(F.when(flagged, F.col("l_shipdate"))).alias("last_paid"),
        )

    # --- requests ---------------------------------------------------------------

    def _orders_with_place(self) -> DataFrame:
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        nations = self.table("nation").select("n_nationkey", "n_regionkey")
        return (
            self.table("orders")
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        )

    @cached_property
    def _request_rows(self) -> DataFrame:
        """Orders with their place, joined last to the folded line items.

        The join on the order id comes last, so the result stays partitioned by
        request id and distinct request counts add no further exchange.  Queries
        that use no line item column get a plan without the line items: the
        optimizer drops an outer join to a side that is unique on the join key.
        """
        lines = self.order_lines.select("l_orderkey", "jobs", "last_ship", "first_part")
        orders = self._orders_with_place().join(
            lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        in_zone = F.col("n_regionkey") < 3
        priority = _case("o_orderpriority", {"1-URGENT": "urgente", "2-HIGH": "haute"}, "normale")
        return orders.select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("REQ-"), F.col("o_orderkey").cast("string")).alias("reference"),
            _case("o_orderstatus", {"O": "EN_COURS", "F": "ACCEPTEE", "P": "REJETEE"}, "INCONNU").alias("statut"),
            (F.col("o_orderkey") % 4).cast("int").alias("etape_courante"),
            F.when(in_zone, IN_ZONE).otherwise(OUT_OF_ZONE).alias("type_demande"),
            _none("bigint").alias("operateur_id"),
            F.col("o_custkey").alias("entreprise_id"),
            F.col("first_part").alias("lot_id"),
            F.when(in_zone, F.col("n_nationkey").cast("bigint")).alias("zone_id"),
            priority.alias("priorite"),
            _money("o_totalprice").alias("amount"),
            "jobs",
            F.col("o_orderdate").alias("created_at"),
            F.greatest("last_ship", "o_orderdate").alias("updated_at"),
        )

    @cached_property
    def requests(self) -> DataFrame:
        named = self._request_rows.withColumnsRenamed({
            "id": "request_id", "statut": "status", "etape_courante": "current_step",
            "type_demande": "request_type", "operateur_id": "operator_id",
            "entreprise_id": "company_id", "lot_id": "plot_id", "priorite": "priority",
            "amount": "financing_amount", "jobs": "total_jobs", "updated_at": "modified_at",
        })
        flagged = extract.with_request_flags(named, REQUESTS_AS_OF)
        return schemas.conform(flagged, schemas.REQUESTS)

    @cached_property
    def source_requests(self) -> DataFrame:
        """Requests as the source system delivers them, with JSON documents."""
        rows = self._request_rows
        return (
            rows.withColumn("financement", F.to_json(F.struct(F.col("amount").alias("montantTotal"))))
                .withColumn("emplois", F.to_json(F.struct(F.col("jobs").alias("total"))))
                .drop("amount", "jobs")
        )

    # --- companies, plots, zones ---------------------------------------------------

    @cached_property
    def source_companies(self) -> DataFrame:
        form = {"AUTOMOBILE": "Sarl", "BUILDING": "SAS", "FURNITURE": "sci",
                "HOUSEHOLD": "EURL", "MACHINERY": "GIE"}
        return self.table("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("raison_sociale"),
            _none("string").alias("telephone"),
            _none("string").alias("email"),
            F.concat(F.lit("RC-"), F.col("c_custkey").cast("string")).alias("registre_commerce"),
            _none("string").alias("compte_contribuable"),
            _case("c_mktsegment", form, "AUTRE").alias("forme_juridique"),
            _none("string").alias("adresse"),
            _none("date").alias("date_constitution"),
            F.col("c_nationkey").cast("bigint").alias("domaine_activite_id"),
            _none("timestamp_ntz").alias("date_creation"),
            _none("timestamp_ntz").alias("date_modification"),
        )

    @cached_property
    def companies(self) -> DataFrame:
        return extract.extract_companies(self.source_companies)

    @cached_property
    def source_plots(self) -> DataFrame:
        state = {"STANDARD": "disponible", "ECONOMY": "disponible", "PROMO": "occupé"}
        even = F.col("p_size") % 2 == 0
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            F.concat(F.lit("LOT-"), F.col("p_partkey").cast("string")).alias("numero"),
            F.col("p_brand").alias("ilot"),
            F.col("p_size").alias("superficie"),
            F.when(even, "ha").otherwise("m2").alias("unite_mesure"),
            F.concat(_notation("p_retailprice", F.col("p_partkey") % 4), F.lit(" €")).alias("prix"),
            _case("p_type", state, "reserve").alias("statut"),
            F.when(F.col("p_type") == "LARGE", "haute").otherwise("normale").alias("priorite"),
            (F.col("p_size") >= 25).alias("viabilite"),
            _none("string").alias("description"),
            _none("string").alias("coordonnees"),
            _none("bigint").alias("zone_industrielle_id"),
            _none("bigint").alias("entreprise_id"),
            _none("bigint").alias("operateur_id"),
            _none("date").alias("date_acquisition"),
            _none("date").alias("date_reservation"),
            _none("int").alias("delai_option"),
            _none("timestamp_ntz").alias("created_at"),
            _none("timestamp_ntz").alias("updated_at"),
        )

    @cached_property
    def plots(self) -> DataFrame:
        return extract.extract_plots(self.source_plots)

    @cached_property
    def source_zones(self) -> DataFrame:
        nations, regions = self.table("nation"), self.table("region")
        state = {"AFRICA": "inactif", "AMERICA": "en_construction"}
        return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.concat(F.lit("Z"), F.col("n_nationkey").cast("string")).alias("code"),
            F.col("n_name").alias("libelle"),
            _none("string").alias("description"),
            ((F.col("n_nationkey") + 1) * 1000).alias("superficie"),
            F.when(F.col("n_regionkey") == 0, "m2").otherwise("ha").alias("unite_mesure"),
            F.col("n_regionkey").alias("lots_disponibles"),
            _none("string").alias("adresse"),
            _case("r_name", state, "actif").alias("statut"),
            F.col("r_name").alias("region"),
            _none("timestamp_ntz").alias("created_at"),
            _none("timestamp_ntz").alias("updated_at"),
        )

    @cached_property
    def zones(self) -> DataFrame:
        return extract.extract_zones(self.source_zones)

    # --- receivables, agents, recovery actions ----------------------------------------

    def _receivable_rows(self, lines: DataFrame) -> DataFrame:
        """Staged receivables over folded line items."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        paid = F.coalesce(F.col("paid"), F.lit(0).cast(s.MONEY))
        state = (F.when(paid == 0, "non_recouvree").when(paid >= F.col("due"), "Recouvree")
                  .otherwise("partiellement_recouvree"))
        kind = _case("first_flag", {ord("A"): "impot", ord("N"): "redevance"}, "taxe")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").alias("receivable_id"),
            F.concat(F.lit("COL-"), F.col("l_orderkey").cast("string")).alias("reference"),
            kind.alias("receivable_type"),
            F.col("due").alias("amount_due"),
            paid.alias("amount_collected"),
            state.alias("status"),
            F.col("o_orderdate").alias("created_on"),
            (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("due_on"),
            F.col("last_paid").alias("recovered_on"),
            F.col("first_supplier").alias("agent_id"),
            F.col("o_custkey").alias("company_id"),
            _none("bigint").alias("plot_id"),
            _none("bigint").alias("zone_id"),
            F.col("l_orderkey").alias("request_id"),
            _none("string").alias("notes"),
            F.greatest("last_ship", "o_orderdate").alias("modified_at"),
        )

    @cached_property
    def receivables(self) -> DataFrame:
        return self._receivable_rows(self.order_lines)

    def receivables_known_on(self, day: str) -> DataFrame:
        """Receivables as staged on an earlier day: only lines shipped by then."""
        shipped = F.col("l_shipdate") <= s.as_timestamp(day)
        return self._receivable_rows(self._fold(self.table("lineitem").filter(shipped)))

    @cached_property
    def delivered_receivables(self) -> DataFrame:
        """Receivables with their amounts as text, as an untyped feed has them."""
        return self.receivables.withColumns({
            c: F.col(c).cast("string") for c in ("amount_due", "amount_collected")})

    @cached_property
    def source_receivables(self) -> DataFrame:
        return self.delivered_receivables.select(
            F.col("receivable_id").alias("id"), "reference",
            F.col("amount_due").alias("montant_a_recouvrer"),
            F.col("amount_collected").alias("montant_recouvre"),
            F.col("status").alias("statut"),
            F.col("created_on").alias("date_debut"), F.col("due_on").alias("date_fin_prevue"),
            F.col("agent_id").alias("cree_par"), F.col("notes").alias("commentaire"),
            F.col("modified_at").alias("updated_at"),
        )

    @cached_property
    def source_agents(self) -> DataFrame:
        """Suppliers; a low balance makes an agent inactive."""
        as_of = s.as_date(COLLECTIONS_AS_OF)
        return self.table("supplier").select(
            F.col("s_suppkey").alias("agent_id"),
            F.col("s_name").alias("nom"),
            _none("string").alias("prenom"),
            F.concat(F.lit("MAT-"), F.col("s_suppkey").cast("string")).alias("matricule"),
            F.col("s_nationkey").cast("bigint").alias("zone_assignee_id"),
            _none("string").alias("telephone"),
            F.when(F.col("s_nationkey") < 12, F.concat(F.lower(F.replace("s_name", F.lit("#"), F.lit("."))),
                                                       F.lit("@example.org")))
             .otherwise(F.col("s_name")).alias("email"),
            F.when(F.col("s_acctbal") < 1000, "INACTIF").otherwise("ACTIF").alias("statut"),
            _none("date").alias("date_embauche"),
            _none("date").alias("date_creation"),
            F.date_sub(as_of, F.col("s_nationkey")).cast("timestamp_ntz").alias("date_modification"),
        )

    @cached_property
    def agents(self) -> DataFrame:
        """All agents as staged (the incremental window opened to the beginning)."""
        return extract.incremental_agents(self.source_agents, COLLECTIONS_AS_OF, days=36500)

    @cached_property
    def source_recoveries(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").try_cast("int")
        return self.table("events").select(
            F.col("event_id").alias("recouvrement_id"),
            F.col("event_id").alias("collecte_id"),
            F.col("event_type").alias("type_action"),
            F.col("ts").alias("date_action"),
            F.col("value").alias("montant_paiement"),
            F.when(k < 34, "espece").when(k < 67, "Virement").otherwise("cheque").alias("mode_paiement"),
            F.col("user_id").alias("agent_recouvrement_id"),
            _case("event_type", {"purchase": "reussi", "error": "echec"}, "en_cours").alias("statut_recouvrement"),
            F.col("props").alias("observations"),
            _none("string").alias("piece_justificative"),
            F.col("ts").alias("date_creation"),
            F.col("ts").alias("date_modification"),
        )

    @cached_property
    def recoveries(self) -> DataFrame:
        return extract.all_recoveries(self.source_recoveries)


@lru_cache(maxsize=8)
def sample_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over one folder; kept, so KPIs share its planned frames."""
    return Warehouse(spark, SampleTables(spark, folder), REQUESTS_AS_OF, BATCH, CALENDAR)
