"""DuckDB SQL that each query of ``sample_queries`` is checked against.

Written over the sample tables on its own: shared parts are common table
expressions, rounded values go through a decimal so that ties round half up.
"""

from __future__ import annotations


def _dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def _int(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _round(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _pct(part: str, whole: str, digits: int) -> str:
    return _round(f"100.0 * CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0)", digits)


def _mean(expr: str, digits: int | None = None) -> str:
    value = f"CAST(SUM({expr}) AS DOUBLE) / NULLIF(COUNT({expr}), 0)"
    return value if digits is None else _round(value, digits)


def _when(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def _bucket(text: str, buckets: int) -> str:
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {buckets})"


def _date_key(column: str) -> str:
    return f"CAST(year({column}) * 10000 + month({column}) * 100 + day({column}) AS INTEGER)"


# --- requests -------------------------------------------------------------------------

REQUESTS = """
lines AS (
  SELECT l_orderkey, CAST(SUM(CAST(l_quantity AS INTEGER)) AS INTEGER) AS jobs,
         MAX(l_shipdate) AS last_ship, MIN(l_partkey) AS first_part
  FROM lineitem GROUP BY l_orderkey),
request_rows AS (
  SELECT o.o_orderkey AS request_id, 'REQ-' || o.o_orderkey AS reference,
         CASE o.o_orderstatus WHEN 'O' THEN 'EN_COURS' WHEN 'F' THEN 'ACCEPTEE'
              WHEN 'P' THEN 'REJETEE' ELSE 'INCONNU' END AS status,
         CAST(o.o_orderkey % 4 AS INTEGER) AS current_step,
         CASE WHEN n.n_regionkey < 3 THEN 'ZONE_INDUSTRIELLE' ELSE 'HORS_ZONE_INDUSTRIELLE' END AS request_type,
         CAST(NULL AS BIGINT) AS operator_id, o.o_custkey AS company_id, l.first_part AS plot_id,
         CASE WHEN n.n_regionkey < 3 THEN CAST(n.n_nationkey AS BIGINT) END AS zone_id,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'urgente' WHEN '2-HIGH' THEN 'haute' ELSE 'normale' END AS priority,
         CAST(o.o_totalprice AS DECIMAL(15,2)) AS financing_amount, l.jobs AS total_jobs,
         o.o_orderdate AS created_at, GREATEST(COALESCE(l.last_ship, o.o_orderdate), o.o_orderdate) AS modified_at
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN lines l ON l.l_orderkey = o.o_orderkey),
requests AS (
  SELECT *, priority IN ('haute', 'élevée', 'prioritaire', 'urgente') AS is_priority,
         status IN ('ACCEPTEE', 'REJETEE') AS is_finalised, status = 'ACCEPTEE' AS is_accepted,
         CAST(CASE WHEN status IN ('ACCEPTEE', 'REJETEE') THEN date_sub('day', created_at, modified_at)
              WHEN status = 'EN_COURS' THEN date_sub('day', created_at, TIMESTAMP '2001-12-31') END AS INTEGER)
           AS processing_days
  FROM request_rows)"""

_FACT_COLUMNS = f"""
  {_date_key('created_at')} AS creation_date_key, {_date_key('modified_at')} AS modification_date_key,
  'zone_' || zone_id AS zone_key, 'lot_' || plot_id AS plot_key, 'entreprise_' || company_id AS company_key,
  COALESCE(status, 'UNKNOWN') || '_' || COALESCE(request_type, 'UNKNOWN') || '_' || COALESCE(current_step, 0) AS status_key,
  zone_id, plot_id, company_id, request_id, reference, 1 AS request_count,
  COALESCE(financing_amount, 0) AS financing, COALESCE(total_jobs, 0) AS jobs,
  COALESCE(processing_days, 0) AS processing_days,
  {_when('is_priority')} AS n_priority, {_when('is_finalised')} AS n_finalised,
  {_when('is_accepted')} AS n_accepted, {_when("status = 'REJETEE'")} AS n_rejected,
  {_when("status = 'EN_COURS'")} AS n_pending,
  {_when("request_type = 'ZONE_INDUSTRIELLE'")} AS n_in_zone,
  {_when("request_type = 'HORS_ZONE_INDUSTRIELLE'")} AS n_out_of_zone,
  priority, current_step, created_at, modified_at"""

FACT = REQUESTS + f""",
fact AS (SELECT {_FACT_COLUMNS} FROM requests)"""

COMPANIES = """
companies AS (
  SELECT c_custkey AS company_id, c_name AS company_name, CAST(NULL AS VARCHAR) AS phone,
         CAST(NULL AS VARCHAR) AS email, 'RC-' || c_custkey AS trade_register,
         CAST(NULL AS VARCHAR) AS tax_account,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Sarl' WHEN 'BUILDING' THEN 'SAS' WHEN 'FURNITURE' THEN 'sci'
              WHEN 'HOUSEHOLD' THEN 'EURL' WHEN 'MACHINERY' THEN 'GIE' ELSE 'AUTRE' END AS legal_form,
         CAST(NULL AS VARCHAR) AS address, CAST(NULL AS DATE) AS founded_on,
         CAST(c_nationkey AS BIGINT) AS activity_id,
         CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS modified_at
  FROM customer)"""

PLOTS = """
plots AS (
  SELECT p_partkey AS plot_id, 'LOT-' || p_partkey AS plot_number, p_brand AS block,
         CAST(p_size AS DECIMAL(15,2)) AS area, CASE WHEN p_size % 2 = 0 THEN 'ha' ELSE 'm2' END AS area_unit,
         CAST(p_retailprice AS DECIMAL(15,2)) AS price,
         CASE WHEN p_type IN ('STANDARD', 'ECONOMY') THEN 'disponible' WHEN p_type = 'PROMO' THEN 'occupé'
              ELSE 'reserve' END AS status,
         CASE WHEN p_type = 'LARGE' THEN 'haute' ELSE 'normale' END AS priority, p_size >= 25 AS is_serviced,
         '' AS description, CAST(NULL AS VARCHAR) AS coordinates, CAST(NULL AS BIGINT) AS zone_id,
         CAST(NULL AS BIGINT) AS company_id, CAST(NULL AS BIGINT) AS operator_id,
         CAST(NULL AS DATE) AS acquired_on, CAST(NULL AS DATE) AS reserved_on,
         CAST(NULL AS INTEGER) AS option_days,
         CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS modified_at
  FROM part)"""

ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS BIGINT) AS zone_id, 'Z' || n_nationkey AS zone_code, n_name AS zone_name,
         '' AS description, CAST((n_nationkey + 1) * 1000 AS DECIMAL(15,2)) AS area,
         CASE WHEN n_regionkey = 0 THEN 'm2' ELSE 'ha' END AS area_unit,
         n_regionkey AS plots_available, '' AS address,
         CASE r_name WHEN 'AFRICA' THEN 'inactif' WHEN 'AMERICA' THEN 'en_construction' ELSE 'actif' END AS status,
         r_name AS region, CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS modified_at
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

DIM_COMPANY = COMPANIES + """,
dim_company AS (
  SELECT 'entreprise_' || company_id AS company_key, company_id, company_name, phone, email, trade_register,
         tax_account, legal_form, address, founded_on, activity_id,
         CASE WHEN legal_form ILIKE '%sarl%' THEN 'SARL' WHEN legal_form ILIKE '%sa%' THEN 'SA'
              WHEN legal_form ILIKE '%sci%' THEN 'SCI' WHEN legal_form ILIKE '%eurl%' THEN 'EURL'
              ELSE 'AUTRE' END AS legal_form_class, created_at, modified_at
  FROM companies)"""

_HECTARES = "CAST(CASE WHEN area_unit = 'm2' THEN CAST(area AS DOUBLE) / 10000 ELSE area END AS DECIMAL(21,6))"

DIM_PLOT = PLOTS + f""",
dim_plot AS (
  SELECT 'lot_' || plot_id AS plot_key, plot_id, plot_number, block, area, area_unit, price, status, priority,
         is_serviced, description, coordinates, zone_id,
         CASE status WHEN 'disponible' THEN 'Disponible' WHEN 'occupé' THEN 'Occupé' ELSE 'Autre' END AS status_label,
         CASE priority WHEN 'normale' THEN 'Normal' WHEN 'haute' THEN 'Haute Priorité' ELSE 'Autre' END AS priority_label,
         CASE WHEN is_serviced THEN 'Viabilisé' ELSE 'Non Viabilisé' END AS serviced_label,
         {_HECTARES} AS area_hectares, created_at, modified_at
  FROM plots)"""

DIM_ZONE = ZONES + f""",
dim_zone AS (
  SELECT 'zone_' || zone_id AS zone_key, zone_id, zone_code, zone_name, description, area, area_unit,
         plots_available, address, status, region,
         CASE status WHEN 'actif' THEN 'Active' WHEN 'inactif' THEN 'Inactive'
              WHEN 'en_construction' THEN 'En Construction' ELSE 'Autre' END AS status_label,
         {_HECTARES} AS area_hectares, created_at, modified_at
  FROM zones)"""

DIM_STATUS = f"""
dim_status AS (
  SELECT DISTINCT status || '_' || request_type || '_' || COALESCE(current_step, 0) AS status_key,
         status, request_type, COALESCE(current_step, 0) AS current_step,
         CASE status WHEN 'EN_COURS' THEN 'En Cours' WHEN 'ACCEPTEE' THEN 'Validée' WHEN 'REJETEE' THEN 'Rejetée'
              WHEN 'DOCUMENTS_REJETES' THEN 'Documents Rejetés' ELSE 'Inconnu' END AS status_label,
         CASE request_type WHEN 'ZONE_INDUSTRIELLE' THEN 'Zone Industrielle'
              WHEN 'HORS_ZONE_INDUSTRIELLE' THEN 'Hors Zone Industrielle' ELSE 'Inconnu' END AS type_label,
         {_when("status = 'ACCEPTEE'")} AS is_accepted, {_when("status = 'REJETEE'")} AS is_rejected,
         {_when("status = 'EN_COURS'")} AS is_pending,
         {_when("status IN ('ACCEPTEE', 'REJETEE')")} AS is_finalised,
         {_when("request_type = 'ZONE_INDUSTRIELLE'")} AS is_in_zone
  FROM requests WHERE status IS NOT NULL AND request_type IS NOT NULL)"""

_MONTHS = ("['Janvier','Février','Mars','Avril','Mai','Juin','Juillet','Août','Septembre',"
           "'Octobre','Novembre','Décembre']")
_DAYS = "['Dimanche','Lundi','Mardi','Mercredi','Jeudi','Vendredi','Samedi']"

_DATE_COLUMNS = f"""
  {_date_key('d')} AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(extract(dow FROM d) AS INTEGER) AS weekday, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  CAST(weekofyear(d) AS INTEGER) AS iso_week,
  strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short,
  strftime(d, '%A') AS weekday_name, strftime(d, '%a') AS weekday_short,
  {_DAYS}[CAST(extract(dow FROM d) AS INTEGER) + 1] AS weekday_name_fr,
  {_MONTHS}[CAST(month(d) AS INTEGER)] AS month_name_fr,
  'Q' || quarter(d) || '-' || year(d) AS quarter_label, strftime(d, '%Y-%m') AS year_month,
  extract(dow FROM d) IN (0, 6) AS is_weekend, extract(dow FROM d) NOT IN (0, 6) AS is_workday,
  CAST(d - INTERVAL 1 DAY AS DATE) AS previous_date, CAST(d + INTERVAL 1 DAY AS DATE) AS next_date"""

DATA_DAYS = """
bounds AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders),
data_days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)"""

DIM_DATE = f"""
calendar_days AS (SELECT CAST(unnest(generate_series(DATE '1990-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
dim_date AS (SELECT {_DATE_COLUMNS} FROM calendar_days)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


# --- collections -------------------------------------------------------------------------

def _receivables(name: str, where: str = "") -> str:
    return f"""
{name}_lines AS (
  SELECT l_orderkey, MAX(l_shipdate) AS last_ship, MIN(l_suppkey) AS first_supplier, MIN(l_returnflag) AS first_flag,
         SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS due,
         COALESCE(SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(15,2)) END), 0) AS paid,
         MAX(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS last_paid
  FROM lineitem {where} GROUP BY l_orderkey),
{name} AS (
  SELECT l_orderkey AS receivable_id, 'COL-' || l_orderkey AS reference,
         CASE first_flag WHEN 'A' THEN 'IMPOT' WHEN 'N' THEN 'REDEVANCE' ELSE 'TAXE' END AS receivable_type,
         CAST(due AS DECIMAL(15,2)) AS amount_due, CAST(paid AS DECIMAL(15,2)) AS amount_collected,
         CASE WHEN paid = 0 THEN 'NON_RECOUVREE' WHEN paid >= due THEN 'RECOUVREE'
              ELSE 'PARTIELLEMENT_RECOUVREE' END AS status,
         CAST(o_orderdate AS DATE) AS created_on, CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS due_on,
         CAST(last_paid AS DATE) AS recovered_on, first_supplier AS agent_id, o_custkey AS company_id,
         CAST(NULL AS BIGINT) AS plot_id, CAST(NULL AS BIGINT) AS zone_id, l_orderkey AS request_id,
         CAST(NULL AS VARCHAR) AS notes, GREATEST(last_ship, o_orderdate) AS modified_at
  FROM {name}_lines JOIN orders ON l_orderkey = o_orderkey)"""


def _hash_agent(column: str, version: str = "1") -> str:
    return f"CASE WHEN {column} IS NOT NULL THEN 'AGT_' || upper(md5('AGT_' || {column} || '_' || {version})) END"


def _measured(name: str, source: str, batch: str) -> str:
    """Receivable fact columns before the range checks, and the fact."""
    return f"""
{name}_all AS (
  SELECT receivable_id AS receivable_fact_key, receivable_id, {_date_key('created_on')} AS created_date_key,
         {_date_key('due_on')} AS due_date_key, {_date_key('recovered_on')} AS recovered_date_key,
         {_date_key('modified_at')} AS modified_date_key, {_hash_agent('agent_id')} AS agent_key,
         'TYP_' || receivable_type AS type_key,
         CASE status WHEN 'PARTIELLEMENT_RECOUVREE' THEN 'STAT_PART_RECOUVREE' ELSE 'STAT_' || status END AS status_key,
         'entreprise_' || company_id AS company_key, 'lot_' || plot_id AS plot_key, 'zone_' || zone_id AS zone_key,
         agent_id, company_id, amount_due, amount_collected, amount_due - amount_collected AS amount_remaining,
         CAST(CASE WHEN amount_due > 0 THEN CAST(amount_collected AS DOUBLE) / CAST(amount_due AS DOUBLE)
              ELSE 0 END AS DECIMAL(20,4)) AS recovery_rate,
         CAST(date_diff('day', created_on, recovered_on) AS INTEGER) AS recovery_days,
         due_on, recovered_on,
         reference, notes, request_id, created_on, modified_at, '{batch}' AS etl_batch_id
  FROM {source}),
{name} AS (
  SELECT * FROM {name}_all
  WHERE COALESCE(amount_due >= 0, TRUE) AND COALESCE(amount_collected >= 0, TRUE)
    AND COALESCE(recovery_rate BETWEEN 0 AND 1, TRUE))"""


RECEIVABLES = _receivables("receivables")
FACT_RECEIVABLES = RECEIVABLES + "," + _measured("fact_receivables", "receivables", "LOAD_1")

SOURCE_AGENTS = """
source_agents AS (
  SELECT s_suppkey AS agent_id, s_name AS nom, CAST(NULL AS VARCHAR) AS prenom, 'MAT-' || s_suppkey AS matricule,
         CAST(s_nationkey AS BIGINT) AS zone_id, CAST(NULL AS VARCHAR) AS phone,
         CASE WHEN s_nationkey < 12 THEN replace(lower(s_name), '#', '.') || '@example.org' ELSE s_name END AS email,
         CASE WHEN s_acctbal < 1000 THEN 'INACTIF' ELSE 'ACTIF' END AS status,
         CAST(NULL AS DATE) AS hired_on, CAST(NULL AS DATE) AS created_on,
         CAST(DATE '2024-01-31' - CAST(s_nationkey AS INTEGER) AS TIMESTAMP) AS modified_at
  FROM supplier)"""

AGENTS = SOURCE_AGENTS + """,
agents AS (
  SELECT agent_id, trim(concat(nom, ' ', prenom)) AS agent_name, matricule AS badge_number,
         'COLLECTEUR' AS job_title, zone_id, phone, CASE WHEN contains(email, '@') THEN email END AS email,
         status, hired_on, created_on, modified_at
  FROM source_agents)"""


def _versions(source: str, loaded: str, where: str = "") -> str:
    key = _hash_agent("agent_id")
    return f"""SELECT {key} AS agent_key, {key} AS durable_key, agent_id, agent_name, '' AS first_name,
         agent_name AS full_name, badge_number, job_title, phone, email, status, zone_id, hired_on, created_on,
         modified_at, TIMESTAMP '{loaded}' AS valid_from, TIMESTAMP '9999-12-31 23:59:59' AS valid_to,
         TRUE AS is_current, 1 AS version
  FROM {source} {where}"""


RECOVERIES = """
recoveries AS (
  SELECT event_id AS recovery_id, event_id AS receivable_id, upper(event_type) AS action_type,
         CAST(ts AS DATE) AS action_on, CAST(value AS DECIMAL(15,2)) AS payment,
         CASE WHEN k < 34 THEN 'ESPECE' WHEN k < 67 THEN 'VIREMENT' ELSE 'CHEQUE' END AS payment_mode,
         user_id AS agent_id,
         CASE event_type WHEN 'purchase' THEN 'REUSSI' WHEN 'error' THEN 'ECHEC' ELSE 'EN_COURS' END AS status,
         props AS notes, CAST(NULL AS VARCHAR) AS document, CAST(ts AS DATE) AS created_on, ts AS modified_at
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

FACT_RECOVERIES = FACT_RECEIVABLES + "," + RECOVERIES + f""",
fact_recoveries AS (
  SELECT r.recovery_id AS recovery_fact_key, r.recovery_id, p.receivable_fact_key, r.receivable_id,
         {_date_key('r.action_on')} AS action_date_key, {_date_key('r.created_on')} AS created_date_key,
         {_date_key('r.modified_at')} AS modified_date_key, {_hash_agent('r.agent_id')} AS agent_key,
         'ACT_' || r.action_type AS action_type_key, 'STAT_' || r.status AS status_key, p.company_key, r.agent_id, p.company_id,
         r.payment, CAST(0 AS DECIMAL(15,2)) AS fee, r.payment AS amount_net,
         CAST(CAST(r.payment AS DOUBLE) / NULLIF(CAST(p.amount_due AS DOUBLE), 0) AS DECIMAL(20,4)) AS effectiveness,
         CAST(date_diff('day', p.created_on, r.action_on) AS INTEGER) AS days_since_receivable,
         r.action_type, r.payment_mode, r.status, r.notes, r.document, r.action_on, r.modified_at,
         'LOAD_1' AS etl_batch_id
  FROM recoveries r LEFT JOIN fact_receivables p ON r.receivable_id = p.receivable_id)"""


def _payment_sources(collection_batch: str, recovery_batch: str) -> str:
    def common(kind: str, source: str, day: str) -> str:
        return (f"'{kind}_' || {source} AS payment_key, '{kind}' AS transaction_type, {source} AS source_id, "
                f"{day} AS payment_date_key")

    def tail(kind: str, source: str, day: str) -> str:
        key = f"'ref_{kind}_' || {source}"
        return f"'PAY' || {day} || ({_bucket(key, 9000)} + 1000) AS payment_reference"

    def days(kind: str, source: str, low: int, high: int) -> str:
        key = f"'days_{kind}_' || {source}"
        return f"CAST({_bucket(key, high - low + 1)} + {low} AS INTEGER)"

    def method(kind: str, source: str, names: str, n: int) -> str:
        key = f"'method_{kind}_' || {source}"
        return f"{names}[{_bucket(key, n)} + 1]"

    c, d = "receivable_fact_key", "created_date_key"
    r, e = "recovery_fact_key", "action_date_key"
    return f"""
collection_payments AS (
  SELECT {common('COLLECTE', c, d)}, created_on AS payment_date, company_key, zone_key, agent_id,
         {method('COLLECTE', c, "['VIREMENT','CHEQUE','ESPECE']", 3)} AS payment_method,
         CASE WHEN recovery_rate >= 0.95 THEN 'PAYE_COMPLET' WHEN recovery_rate >= 0.5 THEN 'PAYE_PARTIEL'
              ELSE 'IMPAYE' END AS payment_status,
         amount_due AS amount_billed, amount_collected AS amount_paid,
         CAST(amount_due * CAST(0.02 AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS fee,
         CAST(amount_collected - amount_due * CAST(0.02 AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS amount_net,
         {days('COLLECTE', c, 15, 45)} AS payment_days, CAST(recovery_rate AS DECIMAL(20,4)) AS payment_rate,
         recovery_rate >= 0.95 AS is_complete, {days('COLLECTE', c, 15, 45)} > 30 AS is_late,
         {tail('COLLECTE', c, d)}, 'receivable ' || {c} AS notes, '{collection_batch}' AS etl_batch_id
  FROM fact_receivables),
recovery_payments AS (
  SELECT {common('RECOUVREMENT', r, e)}, action_on AS payment_date, company_key, 'ZONE_DEFAULT' AS zone_key, agent_id,
         {method('RECOUVREMENT', r, "['VIREMENT','CHEQUE']", 2)} AS payment_method,
         CASE WHEN COALESCE(effectiveness, 0) > 0 THEN 'RECOUVRE' ELSE 'IMPAYE' END AS payment_status,
         CAST(payment * CAST(1.2 AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS amount_billed, payment AS amount_paid,
         CAST(payment * CAST(0.03 AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS fee,
         CAST(payment - payment * CAST(0.03 AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS amount_net,
         {days('RECOUVREMENT', r, 45, 90)} AS payment_days,
         CAST(COALESCE(effectiveness, 0) AS DECIMAL(20,4)) AS payment_rate,
         COALESCE(effectiveness, 0) >= 0.95 AS is_complete, TRUE AS is_late,
         {tail('RECOUVREMENT', r, e)}, 'recovery ' || {r} AS notes, '{recovery_batch}' AS etl_batch_id
  FROM fact_recoveries)"""


PAYMENTS = FACT_RECOVERIES + "," + _payment_sources("LOAD_1_COLLECTES", "LOAD_1_RECOUVREMENTS") + """,
payments AS (SELECT * FROM collection_payments UNION ALL SELECT * FROM recovery_payments)"""

SQL: dict[str, str] = {}


def _select(columns: str, source: str) -> str:
    return f"SELECT {columns} FROM {source}"


# --- extracts, loads, cleaning ---------------------------------------------------------------

SQL["extract_requests"] = _with(REQUESTS) + """SELECT * REPLACE (CAST(financing_amount AS DOUBLE) AS financing_amount)
FROM requests"""
SQL["extract_companies"] = _with(COMPANIES) + "SELECT * FROM companies"
SQL["load_full_refresh"] = SQL["extract_companies"]
SQL["extract_plots"] = _with(PLOTS) + """SELECT * REPLACE (CAST(area AS DOUBLE) AS area, CAST(price AS DOUBLE) AS price)
FROM plots"""
SQL["extract_zones"] = _with(ZONES) + "SELECT * REPLACE (CAST(area AS DOUBLE) AS area) FROM zones"
SQL["extract_receivables"] = _with(RECEIVABLES) + """
SELECT receivable_id, reference, 'RECOUVREMENT' AS receivable_type, CAST(amount_due AS VARCHAR) AS amount_due,
       CAST(amount_collected AS VARCHAR) AS amount_collected,
       CASE status WHEN 'RECOUVREE' THEN 'Recouvree' ELSE lower(status) END AS status,
       CAST(created_on AS TIMESTAMP) AS created_on, CAST(due_on AS TIMESTAMP) AS due_on,
       CAST(NULL AS DATE) AS recovered_on, agent_id, CAST(NULL AS BIGINT) AS company_id,
       CAST(NULL AS BIGINT) AS plot_id, CAST(NULL AS BIGINT) AS zone_id, CAST(NULL AS BIGINT) AS request_id,
       notes, modified_at
FROM receivables"""
SQL["incremental_agents"] = _with(SOURCE_AGENTS) + """
SELECT agent_id, concat(nom, ' ', prenom) AS agent_name, matricule AS badge_number, 'COLLECTEUR' AS job_title,
       zone_id, phone, email, status, hired_on, created_on, modified_at
FROM source_agents WHERE status = 'ACTIF' OR modified_at >= DATE '2024-01-31' - INTERVAL 7 DAY"""
SQL["incremental_recoveries"] = """
SELECT event_id AS recovery_id, event_id AS receivable_id, event_type AS action_type, ts AS action_on,
       value AS payment,
       CASE WHEN k < 34 THEN 'espece' WHEN k < 67 THEN 'Virement' ELSE 'cheque' END AS payment_mode,
       user_id AS agent_id,
       CASE event_type WHEN 'purchase' THEN 'reussi' WHEN 'error' THEN 'echec' ELSE 'en_cours' END AS status,
       props AS notes, CAST(NULL AS VARCHAR) AS document, ts AS created_on, ts AS modified_at
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 1 DAY"""
SQL["clean_receivables"] = _with(RECEIVABLES) + """
SELECT * REPLACE (CAST(amount_due AS DOUBLE) AS amount_due, CAST(amount_collected AS DOUBLE) AS amount_collected)
FROM receivables WHERE amount_due >= 0"""
SQL["clean_agents"] = _with(AGENTS) + "SELECT * FROM agents"
SQL["clean_recoveries"] = _with(RECOVERIES) + "SELECT * REPLACE (CAST(payment AS DOUBLE) AS payment) FROM recoveries"

_FACT_DOUBLES = """* REPLACE (CAST(amount_due AS DOUBLE) AS amount_due, CAST(amount_collected AS DOUBLE) AS amount_collected,
  CAST(amount_remaining AS DOUBLE) AS amount_remaining, CAST(recovery_rate AS DOUBLE) AS recovery_rate)"""
# past due and not fully paid by then: a paid receivable is judged by its recovery date (not late without
# one), an open one by the day of the report
_LATENESS = """*,
  CASE WHEN amount_due - amount_collected <= 0 THEN COALESCE(date_diff('day', due_on, recovered_on) > 0, FALSE)
       ELSE COALESCE(date_diff('day', due_on, DATE '2001-12-31') > 0, FALSE) END AS is_late,
  CAST(GREATEST(CASE WHEN amount_due - amount_collected <= 0 THEN date_diff('day', due_on, recovered_on)
       ELSE date_diff('day', due_on, DATE '2001-12-31') END, 0) AS INTEGER) AS days_late"""
_RECOVERY_DOUBLES = """* REPLACE (CAST(payment AS DOUBLE) AS payment, CAST(fee AS DOUBLE) AS fee,
  CAST(amount_net AS DOUBLE) AS amount_net, CAST(effectiveness AS DOUBLE) AS effectiveness)"""
_PAYMENT_DOUBLES = """* REPLACE (CAST(amount_billed AS DOUBLE) AS amount_billed, CAST(amount_paid AS DOUBLE) AS amount_paid,
  CAST(fee AS DOUBLE) AS fee, CAST(amount_net AS DOUBLE) AS amount_net, CAST(payment_rate AS DOUBLE) AS payment_rate)"""

SQL["collections_two_batches"] = _with(RECEIVABLES, RECOVERIES, AGENTS) + """
SELECT 'fact_receivables' AS "table", 'B2' AS tag, COUNT(*) AS rows, CAST(SUM(amount_collected) AS DOUBLE) AS amount
FROM receivables
UNION ALL SELECT 'fact_recoveries', 'B2', COUNT(*), CAST(SUM(payment) AS DOUBLE) FROM recoveries
UNION ALL SELECT 'payment_movements', 'B1_COLLECTES', COUNT(*), 0 FROM receivables
          WHERE receivable_id % 2 = 0 AND receivable_id % 500 <> 4
UNION ALL SELECT 'payment_movements', 'B2_COLLECTES', COUNT(*), CAST(SUM(amount_collected) AS DOUBLE) FROM receivables
          WHERE receivable_id % 2 = 1 OR receivable_id % 500 = 4 OR amount_collected <> 0
UNION ALL SELECT 'payment_movements', 'B2_RECOUVREMENTS', COUNT(*), CAST(SUM(payment) AS DOUBLE) FROM recoveries
UNION ALL SELECT 'fact_payments', 'B2_COLLECTES', COUNT(*), CAST(SUM(amount_collected) AS DOUBLE) FROM receivables
UNION ALL SELECT 'fact_payments', 'B2_RECOUVREMENTS', COUNT(*), CAST(SUM(payment) AS DOUBLE) FROM recoveries
UNION ALL SELECT 'dim_agent', 'current', COUNT(*), 0 FROM agents
          WHERE status = 'ACTIF' OR modified_at >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY"""
SQL["late_receivables"] = _with(RECEIVABLES) + """
SELECT paid, is_late, COUNT(*) AS receivables, CAST(SUM(days) AS BIGINT) AS days_late FROM (
  SELECT CASE WHEN amount_collected >= amount_due THEN 'full' WHEN amount_collected > 0 THEN 'part'
              ELSE 'none' END AS paid,
         amount_collected < amount_due AND due_on < DATE '2001-12-31' AS is_late,
         CASE WHEN amount_collected < amount_due
              THEN GREATEST(date_diff('day', due_on, DATE '2001-12-31'), 0) ELSE 0 END AS days
  FROM receivables WHERE amount_due >= 0 AND amount_collected >= 0
    AND (amount_due = 0 OR CAST(amount_collected AS DOUBLE) / CAST(amount_due AS DOUBLE) < 1.00005))
GROUP BY 1, 2"""
SQL["upsert_receivable_fact"] = _with(
    _receivables("earlier", "WHERE l_shipdate <= TIMESTAMP '1999-12-31'"),
    _measured("target", "earlier", "LOAD_0"), RECEIVABLES, _measured("batch", "receivables", "LOAD_1")) + f"""
SELECT {_FACT_DOUBLES} FROM (SELECT {_LATENESS} FROM (
  SELECT o.* REPLACE (
      CASE WHEN n.receivable_id IS NULL THEN o.amount_collected ELSE n.amount_collected END AS amount_collected,
      CASE WHEN n.receivable_id IS NULL THEN o.amount_remaining ELSE n.amount_remaining END AS amount_remaining,
      CASE WHEN n.receivable_id IS NULL THEN o.recovery_rate ELSE n.recovery_rate END AS recovery_rate,
      CASE WHEN n.receivable_id IS NULL THEN o.status_key ELSE n.status_key END AS status_key,
      CASE WHEN n.receivable_id IS NULL THEN o.modified_date_key ELSE n.modified_date_key END AS modified_date_key,
      CASE WHEN n.receivable_id IS NULL THEN o.modified_at ELSE n.modified_at END AS modified_at,
      CASE WHEN n.receivable_id IS NULL THEN o.etl_batch_id ELSE n.etl_batch_id END AS etl_batch_id)
  FROM target o LEFT JOIN batch n ON o.receivable_id = n.receivable_id
  UNION ALL
  SELECT * FROM batch WHERE receivable_id NOT IN (SELECT receivable_id FROM target)))"""

SQL["upsert_recovery_fact"] = _with(FACT_RECOVERIES, """
target AS (SELECT * FROM fact_recoveries WHERE action_on < DATE '2024-01-24'),
revised AS (
  SELECT * REPLACE (CAST(payment * CAST(0.97 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS payment, 'REUSSI' AS status,
                    'REVISED' AS action_type, 'LOAD_2' AS etl_batch_id,
                    CAST(payment * CAST(0.97 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS amount_net)
  FROM fact_recoveries WHERE action_on >= DATE '2024-01-17')""") + f"""
SELECT {_RECOVERY_DOUBLES} FROM (
  SELECT o.* REPLACE (
      CASE WHEN n.recovery_id IS NULL THEN o.payment ELSE n.payment END AS payment,
      CASE WHEN n.recovery_id IS NULL THEN o.amount_net ELSE n.amount_net END AS amount_net,
      CASE WHEN n.recovery_id IS NULL THEN o.status ELSE n.status END AS status,
      CASE WHEN n.recovery_id IS NULL THEN o.modified_at ELSE n.modified_at END AS modified_at,
      CASE WHEN n.recovery_id IS NULL THEN o.etl_batch_id ELSE n.etl_batch_id END AS etl_batch_id)
  FROM target o LEFT JOIN revised n ON o.recovery_id = n.recovery_id
  UNION ALL
  SELECT * FROM revised WHERE recovery_id NOT IN (SELECT recovery_id FROM target))"""

_END_AS_TEXT = "SELECT * REPLACE (strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to) FROM"
SQL["insert_new_agents"] = _with(AGENTS) + f"""
{_END_AS_TEXT} ({_versions('agents', '2024-01-01', "WHERE status = 'ACTIF'")}
UNION ALL
{_versions('agents', '2024-02-01', "WHERE status <> 'ACTIF'")})"""

_RECENT = "modified_at >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY"
SQL["scd2_agents"] = _with(AGENTS, f"""
second AS (SELECT * REPLACE (CASE WHEN {_RECENT} THEN NULL ELSE email END AS email,
             CASE WHEN agent_id % 7 = 3 THEN 'Older' ELSE agent_name END AS agent_name,
             CASE WHEN agent_id % 7 = 3 THEN modified_at - INTERVAL 10 DAY ELSE modified_at END AS modified_at)
           FROM agents),
known AS ({_versions('agents', '2024-01-01', "WHERE status = 'ACTIF'")}),
changed AS (SELECT k.agent_id FROM known k JOIN second s ON k.agent_id = s.agent_id
            WHERE k.email IS DISTINCT FROM s.email AND k.agent_id % 7 <> 3)""") + f"""
{_END_AS_TEXT} (
SELECT * FROM known WHERE agent_id NOT IN (SELECT agent_id FROM changed)
UNION ALL
SELECT * REPLACE (TIMESTAMP '2024-02-01' AS valid_to, FALSE AS is_current) FROM known
WHERE agent_id IN (SELECT agent_id FROM changed)
UNION ALL
SELECT * REPLACE ({_hash_agent('agent_id', '2')} AS agent_key, 2 AS version)
FROM ({_versions('second', '2024-02-01', 'WHERE agent_id IN (SELECT agent_id FROM changed)')})
UNION ALL
{_versions('second', '2024-02-01', 'WHERE agent_id NOT IN (SELECT agent_id FROM known)')})"""

SQL["seed_reference_dims"] = _with(FACT_RECOVERIES, """
members(dimension, member_key, label) AS (VALUES
  ('type', 'TYP_RECOUVREMENT', 'Recouvrement'), ('type', 'TYP_REDEVANCE', 'Redevance'), ('type', 'TYP_IMPOT', 'Impôt'),
  ('type', 'TYP_TAXE', 'Taxe'), ('type', 'TYP_AMENDE', 'Amende'),
  ('status', 'STAT_EN_COURS', 'En cours'), ('status', 'STAT_RECOUVREE', 'Recouvrée'),
  ('status', 'STAT_PART_RECOUVREE', 'Partiellement recouvrée'), ('status', 'STAT_NON_RECOUVREE', 'Non recouvrée'),
  ('status', 'STAT_ANNULEE', 'Annulée'), ('status', 'STAT_SUSPENDUE', 'Suspendue'),
  ('mode', 'MODE_ESPECE', 'Espèces'), ('mode', 'MODE_CHEQUE', 'Chèque'), ('mode', 'MODE_VIREMENT', 'Virement'),
  ('mode', 'MODE_CB', 'Carte bancaire'), ('mode', 'MODE_MOBILE', 'Mobile Money')),
used AS (
  SELECT type_key AS member_key, COUNT(*) AS n FROM fact_receivables GROUP BY 1
  UNION ALL SELECT status_key, COUNT(*) FROM fact_receivables GROUP BY 1
  UNION ALL SELECT 'MODE_' || payment_mode, COUNT(*) FROM fact_recoveries GROUP BY 1)""") + """
SELECT m.dimension, m.member_key, m.label, COALESCE(u.n, 0) AS "rows"
FROM members m LEFT JOIN used u ON m.member_key = u.member_key"""

SQL["date_spine"] = _with(DATA_DAYS) + """
SELECT d AS date, COUNT(o_orderkey) AS requests
FROM data_days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY d"""

# --- dimensions and facts -----------------------------------------------------------------------

SQL["dim_date"] = _with(DATA_DAYS) + f"SELECT {_DATE_COLUMNS} FROM data_days"
SQL["dim_company"] = _with(DIM_COMPANY) + "SELECT * FROM dim_company"
SQL["dim_plot"] = _with(DIM_PLOT) + """
SELECT * REPLACE (CAST(area AS DOUBLE) AS area, CAST(price AS DOUBLE) AS price,
                  CAST(area_hectares AS DOUBLE) AS area_hectares) FROM dim_plot"""
SQL["dim_zone"] = _with(DIM_ZONE) + """
SELECT * REPLACE (CAST(area AS DOUBLE) AS area, CAST(area_hectares AS DOUBLE) AS area_hectares) FROM dim_zone"""
SQL["dim_request_status"] = _with(REQUESTS, DIM_STATUS) + "SELECT * FROM dim_status"
SQL["fact_requests"] = _with(FACT) + "SELECT * REPLACE (CAST(financing AS DOUBLE) AS financing) FROM fact"
SQL["fact_receivables"] = _with(FACT_RECEIVABLES) + f"""
SELECT {_FACT_DOUBLES} FROM (SELECT {_LATENESS} FROM fact_receivables)"""
SQL["fact_recoveries"] = _with(FACT_RECOVERIES) + f"SELECT {_RECOVERY_DOUBLES} FROM fact_recoveries"
SQL["payments_from_receivables"] = _with(
    FACT_RECOVERIES, _payment_sources("LOAD_1", "LOAD_1")) + f"SELECT {_PAYMENT_DOUBLES} FROM collection_payments"
SQL["payments_from_recoveries"] = _with(
    FACT_RECOVERIES, _payment_sources("LOAD_1", "LOAD_1")) + f"SELECT {_PAYMENT_DOUBLES} FROM recovery_payments"
SQL["build_payments"] = _with(PAYMENTS) + f"SELECT {_PAYMENT_DOUBLES} FROM payments"

# --- request KPIs ---------------------------------------------------------------------------------

_N = "COUNT(DISTINCT request_id)"
_MONEY = "CAST(SUM(financing) AS DOUBLE) AS financing"
_JOBS = "CAST(SUM(jobs) AS BIGINT) AS jobs"
_AVG_DAYS = f"{_mean('processing_days', 1)} AS avg_days"


def _total(column: str, name: str) -> str:
    return f"CAST(SUM({column}) AS BIGINT) AS {name}"


def _share(groups: str, count: str = "requests", digits: int = 2) -> str:
    return f"SELECT *, {_pct(count, f'SUM({count}) OVER ()', digits)} AS share_pct FROM ({groups})"


_STATUS_BUCKET = ("CASE WHEN n_pending > 0 THEN 'EN_COURS' WHEN n_accepted > 0 THEN 'VALIDÉE' "
                  "WHEN n_rejected > 0 THEN 'REJETÉE' ELSE 'AUTRE' END")
_ZONE_TYPE = "CASE WHEN n_in_zone > 0 THEN 'ZONE_INDUSTRIELLE' ELSE 'HORS_ZONE_INDUSTRIELLE' END"
_LEVEL = "CASE WHEN n_priority > 0 THEN 'PRIORITAIRE' ELSE 'NORMALE' END"

_BY_STATUS = _share(f"SELECT {_STATUS_BUCKET} AS status, {_N} AS requests, {_MONEY}, {_JOBS} FROM fact GROUP BY 1")
_BY_PRIORITY = _share(f"SELECT {_LEVEL} AS priority_level, {_N} AS requests, {_MONEY}, {_JOBS}, {_AVG_DAYS}, "
                      f"{_total('n_accepted', 'accepted')} FROM fact GROUP BY 1")
_BY_TYPE = _share(f"SELECT {_ZONE_TYPE} AS zone_type, {_N} AS requests, {_MONEY}, {_JOBS}, "
                  f"{_mean('processing_days')} AS avg_days FROM fact GROUP BY 1")
SQL["kpi_by_status"] = _with(FACT) + _BY_STATUS
SQL["kpi_by_zone_type"] = _with(FACT) + _BY_TYPE
SQL["kpi_priority_split"] = _with(FACT) + _BY_PRIORITY

_STAR = _with(FACT, DIM_ZONE, DIM_PLOT, DIM_COMPANY)
_ENTITY = f"""
SELECT z.zone_name, p.plot_number, c.company_name, {_N} AS requests, {_MONEY}, {_JOBS}, {_AVG_DAYS},
       {_total('n_accepted', 'accepted')}, {_total('n_rejected', 'rejected')}, {_total('n_pending', 'pending')}
FROM fact f JOIN dim_zone z ON f.zone_key = z.zone_key JOIN dim_plot p ON f.plot_key = p.plot_key
JOIN dim_company c ON f.company_key = c.company_key GROUP BY 1, 2, 3"""
_TOP_ENTITIES = f"""
SELECT zone_name, plot_number, company_name, requests, financing FROM ({_ENTITY})
ORDER BY requests DESC, financing DESC, zone_name, plot_number, company_name LIMIT """
SQL["kpi_by_entity"] = _STAR + _ENTITY
SQL["kpi_top_entities"] = _STAR + _TOP_ENTITIES + "5"
SQL["kpi_top_10_entities"] = _STAR + _TOP_ENTITIES + "10"

_DELAY = f"""
SELECT {_mean('processing_days', 1)} AS avg_days, {_round('quantile_cont(processing_days, 0.5)', 1)} AS median_days,
       MIN(processing_days) AS min_days, MAX(processing_days) AS max_days,
       COUNT(DISTINCT CASE WHEN processing_days <= 7 THEN request_id END) AS up_to_7_days,
       COUNT(DISTINCT CASE WHEN processing_days BETWEEN 8 AND 15 THEN request_id END) AS from_8_to_15_days,
       COUNT(DISTINCT CASE WHEN processing_days > 15 THEN request_id END) AS over_15_days,
       COUNT(DISTINCT CASE WHEN n_finalised > 0 THEN request_id END) AS finalised_requests
FROM fact WHERE processing_days > 0"""
SQL["kpi_delay_stats"] = _with(FACT) + _DELAY
SQL["kpi_delay_finalised"] = _with(FACT) + _DELAY + " AND n_finalised > 0"

SQL["kpi_acceptance"] = _with(FACT) + f"""
SELECT {_pct('SUM(n_accepted)', 'SUM(n_finalised)', 2)} AS acceptance_pct, {_total('n_accepted', 'accepted')},
       {_total('n_rejected', 'rejected')}, {_total('n_pending', 'pending')}, {_total('n_finalised', 'finalised')},
       {_N} AS requests, {_pct('SUM(n_rejected)', 'SUM(n_finalised)', 2)} AS rejection_pct FROM fact"""
SQL["kpi_acceptance_finalised"] = _with(FACT) + f"""
SELECT {_pct('SUM(n_accepted)', 'SUM(n_finalised)', 2)} AS acceptance_pct, {_total('n_accepted', 'accepted')},
       {_total('n_finalised', 'finalised')}, {_N} AS requests FROM fact WHERE n_finalised > 0"""

_TREND = f"""
SELECT d.year, d.month, d.month_name_fr, d.quarter, {_N} AS requests, {_total('n_priority', 'priority_requests')},
       CAST({_N} - SUM(n_priority) AS BIGINT) AS normal_requests, {_pct('SUM(n_priority)', _N, 2)} AS priority_pct,
       {_MONEY}, {_JOBS}, {_AVG_DAYS}
FROM fact f JOIN dim_date d ON f.creation_date_key = d.date_key GROUP BY 1, 2, 3, 4"""
SQL["kpi_priority_trend"] = _with(FACT, DIM_DATE) + _TREND

SQL["kpi_volume"] = _with(FACT) + f"""
SELECT {_N} AS requests, {_total('n_pending', 'pending')}, {_total('n_accepted', 'accepted')},
       {_total('n_rejected', 'rejected')}, {_total('n_finalised', 'finalised')},
       {_total('n_priority', 'priority_requests')}, {_total('n_in_zone', 'in_zone')},
       {_total('n_out_of_zone', 'out_of_zone')}, {_pct('SUM(n_priority)', _N, 1)} AS priority_pct,
       {_pct('SUM(n_in_zone)', _N, 1)} AS in_zone_pct FROM fact"""

_FINANCIAL = f"""
SELECT {_N} AS requests, {_MONEY}, {_mean('financing', 0)} AS avg_financing, {_JOBS}, {_mean('jobs', 1)} AS avg_jobs,
       {_round('CAST(SUM(financing) AS DOUBLE) / NULLIF(SUM(jobs), 0)', 0)} AS cost_per_job,
       {_total(_when('financing > 0'), 'requests_with_financing')}, {_total(_when('jobs > 0'), 'requests_with_jobs')},
       {_pct(f"SUM({_when('financing > 0')})", _N, 1)} AS with_financing_pct
FROM fact WHERE n_accepted > 0"""
SQL["kpi_financial_performance"] = _with(FACT) + _FINANCIAL

_MONTHLY = f"""
SELECT strftime(created_at, '%Y-%m') AS period, CAST(year(created_at) AS INTEGER) AS year,
       CAST(month(created_at) AS INTEGER) AS month, {_N} AS requests, {_total('n_accepted', 'accepted')},
       {_total('n_rejected', 'rejected')}, {_total('n_priority', 'priority_requests')}, {_AVG_DAYS}, {_MONEY}, {_JOBS},
       {_pct('SUM(n_accepted)', 'SUM(n_finalised)', 1)} AS acceptance_pct,
       {_pct('SUM(n_priority)', _N, 1)} AS priority_pct
FROM fact WHERE created_at IS NOT NULL GROUP BY 1, 2, 3"""
SQL["kpi_monthly"] = _with(FACT) + _MONTHLY
SQL["kpi_last_12_months"] = _with(FACT) + f"SELECT * FROM ({_MONTHLY}) ORDER BY period DESC LIMIT 12"
SQL["kpi_monthly_summary"] = _with(FACT) + (
    f"SELECT period, requests, accepted, acceptance_pct, financing FROM ({_MONTHLY})")

_ZONE = _share(f"""
SELECT z.zone_name, z.zone_code, z.region, {_N} AS requests, {_total('n_accepted', 'accepted')},
       {_total('n_pending', 'pending')}, {_total('n_priority', 'priority_requests')}, {_AVG_DAYS}, {_MONEY}, {_JOBS},
       {_pct('SUM(n_accepted)', 'SUM(n_finalised)', 1)} AS acceptance_pct
FROM fact f JOIN dim_zone z ON f.zone_key = z.zone_key GROUP BY 1, 2, 3""", digits=1)
SQL["kpi_by_zone"] = _with(FACT, DIM_ZONE) + _ZONE
SQL["kpi_zone_summary"] = _with(FACT, DIM_ZONE) + (
    f"SELECT zone_name, zone_code, requests, accepted, financing, jobs FROM ({_ZONE})")
SQL["kpi_top_zones"] = _with(FACT, DIM_ZONE) + (
    f"SELECT zone_name, requests, acceptance_pct, financing FROM ({_ZONE}) ORDER BY requests DESC, zone_name LIMIT 5")

_EXECUTIVE = f"""
SELECT *, CASE WHEN acceptance_pct < 30 THEN 'ALERTE: Taux acceptation faible'
               WHEN avg_days > 15 THEN 'ALERTE: Délai traitement élevé' ELSE 'NORMAL' END AS alert_status
FROM (SELECT {_N} AS requests, {_total('n_pending', 'pending')}, {_total('n_finalised', 'finalised')},
       {_pct('SUM(n_accepted)', 'SUM(n_finalised)', 2)} AS acceptance_pct,
       {_mean('CASE WHEN n_finalised > 0 THEN processing_days END', 1)} AS avg_days,
       {_total('n_priority', 'priority_requests')}, {_pct('SUM(n_priority)', _N, 1)} AS priority_pct,
       {_MONEY}, {_mean('financing', 0)} AS avg_financing, {_JOBS}, {_total('n_in_zone', 'in_zone')},
       {_total('n_out_of_zone', 'out_of_zone')} FROM fact)"""
SQL["kpi_executive"] = _with(FACT) + _EXECUTIVE

SQL["kpi_summary_row"] = _with(FACT) + f"""
SELECT e.requests, e.pending, e.finalised, e.acceptance_pct, e.avg_days, e.financing, e.jobs, e.alert_status,
       f.requests AS accepted_requests, f.financing AS accepted_financing, f.avg_financing, f.jobs AS accepted_jobs,
       f.cost_per_job, f.with_financing_pct, d.avg_days AS finalised_avg_days, d.median_days, d.min_days, d.max_days,
       d.up_to_7_days, d.from_8_to_15_days, d.over_15_days
FROM ({_EXECUTIVE}) e, ({_FINANCIAL}) f, ({_DELAY} AND n_finalised > 0) d"""

# --- star analysis ---------------------------------------------------------------------------------

_FACT_STATUS = _with(FACT, DIM_STATUS)
_JOIN_STATUS = "FROM fact f JOIN dim_status s ON f.status_key = s.status_key"
SQL["an_by_status"] = _FACT_STATUS + _share(
    f"SELECT s.status_label, s.status, COUNT(*) AS requests {_JOIN_STATUS} GROUP BY 1, 2")
SQL["an_by_type"] = _FACT_STATUS + _share(
    f"SELECT s.type_label, s.request_type, COUNT(*) AS requests {_JOIN_STATUS} GROUP BY 1, 2")
SQL["an_by_entity_left"] = _STAR + f"""
SELECT z.zone_name, p.plot_number, c.company_name, COUNT(*) AS requests, {_MONEY}, {_JOBS}
FROM fact f LEFT JOIN dim_zone z ON f.zone_key = z.zone_key LEFT JOIN dim_plot p ON f.plot_key = p.plot_key
LEFT JOIN dim_company c ON f.company_key = c.company_key GROUP BY 1, 2, 3"""
_PRIORITY_LABEL = "CASE WHEN n_priority = 1 THEN 'Prioritaire' ELSE 'Normale' END AS priority_label"
SQL["an_priority"] = _with(FACT) + f"""
SELECT {_PRIORITY_LABEL}, COUNT(*) AS requests, {_mean('financing', 2)} AS avg_financing,
       {_mean('jobs', 0)} AS avg_jobs, {_AVG_DAYS} FROM fact GROUP BY 1"""
SQL["an_priority_short"] = _with(FACT) + f"""
SELECT {_PRIORITY_LABEL}, COUNT(*) AS requests, {_mean('financing', 0)} AS avg_financing, {_AVG_DAYS}
FROM fact GROUP BY 1"""
SQL["an_delay_by_status_type"] = _FACT_STATUS + f"""
SELECT s.status_label, s.type_label, COUNT(*) AS requests, {_AVG_DAYS}, MIN(processing_days) AS min_days,
       MAX(processing_days) AS max_days, {_round('quantile_cont(processing_days, 0.5)', 1)} AS median_days
{_JOIN_STATUS} WHERE processing_days > 0 GROUP BY 1, 2"""
SQL["an_delay_by_status"] = _FACT_STATUS + f"""
SELECT s.status_label, COUNT(*) AS requests, {_AVG_DAYS}, MIN(processing_days) AS min_days,
       MAX(processing_days) AS max_days {_JOIN_STATUS} WHERE processing_days > 0 GROUP BY 1"""
SQL["an_acceptance_by_type"] = _FACT_STATUS + f"""
SELECT s.type_label, COUNT(*) AS requests, {_total('n_accepted', 'accepted')}, {_total('n_rejected', 'rejected')},
       {_total('n_finalised', 'finalised')}, {_total('n_pending', 'pending')},
       COALESCE({_pct('SUM(n_accepted)', 'SUM(n_finalised)', 2)}, 0) AS acceptance_pct,
       {_pct('SUM(n_finalised)', 'COUNT(*)', 2)} AS finalisation_pct {_JOIN_STATUS} GROUP BY 1"""
SQL["an_priority_trend"] = _with(FACT, DIM_DATE) + f"""
SELECT d.year, d.month_name_fr, d.year_month, {_total('n_priority', 'priority_requests')},
       CAST(COUNT(*) - SUM(n_priority) AS BIGINT) AS normal_requests, COUNT(*) AS requests,
       {_pct('SUM(n_priority)', 'COUNT(*)', 2)} AS priority_pct
FROM fact f JOIN dim_date d ON f.creation_date_key = d.date_key GROUP BY d.year, d.month, d.month_name_fr, d.year_month"""
SQL["an_top_zones"] = _with(FACT, DIM_ZONE) + f"""
SELECT z.zone_name, z.zone_code, z.status_label, COUNT(*) AS requests, {_total('n_accepted', 'accepted')}, {_MONEY},
       {_JOBS}, {_AVG_DAYS}
FROM fact f JOIN dim_zone z ON f.zone_key = z.zone_key GROUP BY 1, 2, 3
ORDER BY requests DESC, zone_code, zone_name LIMIT 10"""
SQL["an_monthly_full"] = _with(FACT, DIM_DATE) + f"""
SELECT d.year_month, COUNT(*) AS requests, {_total('n_in_zone', 'in_zone')}, {_total('n_out_of_zone', 'out_of_zone')},
       {_total('n_priority', 'priority')}, {_total('n_accepted', 'accepted')}, {_total('n_rejected', 'rejected')},
       {_total('n_pending', 'pending')}, {_AVG_DAYS}, {_MONEY}, {_JOBS}
FROM fact f JOIN dim_date d ON f.creation_date_key = d.date_key GROUP BY 1"""
SQL["an_total"] = _with(FACT) + "SELECT COUNT(*) AS requests FROM fact"
SQL["an_type_financing"] = _FACT_STATUS + f"""
SELECT s.type_label, COUNT(*) AS requests, {_MONEY}, {_mean('jobs')} AS avg_jobs {_JOIN_STATUS} GROUP BY 1"""

# --- collections and payments --------------------------------------------------------------------------

_PAY = _with(PAYMENTS)
_PAID = "CAST(SUM(amount_paid) AS DOUBLE) AS amount"
_SUCCESS = "payment_status IN ('PAYE_COMPLET', 'PAYE_PARTIEL', 'RECOUVRE')"
_COMPLETE = "COUNT(*) FILTER (WHERE is_complete)"
_LATE = "COUNT(*) FILTER (WHERE is_late)"
_PERIOD = "CAST(date_trunc('month', payment_date) AS DATE) AS period"
SQL["fin_total_payments"] = _PAY + f"SELECT {_PAID}, COUNT(*) AS payments FROM payments WHERE amount_paid > 0"
SQL["fin_net_revenue"] = _PAY + f"""
SELECT CAST(SUM(amount_net) AS DOUBLE) AS net_amount, COUNT(*) AS payments, {_mean('amount_net', 2)} AS avg_net_amount
FROM payments WHERE {_SUCCESS}"""
SQL["fin_dashboard"] = _PAY + f"""
SELECT 1 AS position, '1. Montant Total Paiements' AS kpi,
       CAST(CAST(CAST(SUM(amount_paid) AS DOUBLE) / 1000000 AS DECIMAL(20,1)) AS VARCHAR) || 'M FCFA' AS value_text,
       COUNT(*) || ' transactions' AS detail FROM payments WHERE amount_paid > 0
UNION ALL
SELECT 2, '2. Revenus Nets Réussis',
       CAST(CAST(CAST(SUM(amount_net) AS DOUBLE) / 1000000 AS DECIMAL(20,1)) AS VARCHAR) || 'M FCFA',
       COUNT(*) || ' paiements' FROM payments WHERE {_SUCCESS}"""
SQL["fin_collections_monthly"] = _PAY + f"""
SELECT {_PERIOD}, COUNT(*) AS payments, {_PAID}, {_mean('amount_paid', 6)} AS avg_amount
FROM payments WHERE transaction_type = 'COLLECTE' GROUP BY 1"""
SQL["fin_agent_performance"] = _PAY + f"""
SELECT agent_id, COUNT(*) AS payments, {_PAID}, {_COMPLETE} AS complete, {_pct(_COMPLETE, 'COUNT(*)', 2)} AS success_pct
FROM payments WHERE agent_id IS NOT NULL GROUP BY 1"""
SQL["fin_recovery_by_zone"] = _PAY + f"""
SELECT zone_key, COUNT(*) AS payments, {_PAID}, {_LATE} AS late, {_pct(_LATE, 'COUNT(*)', 2)} AS late_pct
FROM payments WHERE transaction_type = 'RECOUVREMENT' GROUP BY 1"""
SQL["fin_monthly_by_type"] = _PAY + f"""
SELECT {_PERIOD}, transaction_type, COUNT(*) AS payments, {_PAID} FROM payments GROUP BY 1, 2"""
SQL["fin_by_method"] = _PAY + f"""
SELECT payment_method, COUNT(*) AS payments, {_PAID}, {_mean('amount_paid', 2)} AS avg_amount FROM payments GROUP BY 1"""
SQL["fin_global_dashboard"] = _PAY + f"""
SELECT COUNT(*) AS payments, {_PAID}, COUNT(*) FILTER (WHERE transaction_type = 'COLLECTE') AS collections,
       COUNT(*) FILTER (WHERE transaction_type = 'RECOUVREMENT') AS recoveries, {_COMPLETE} AS complete,
       {_LATE} AS late, {_pct(_COMPLETE, 'COUNT(*)', 2)} AS success_pct FROM payments"""
SQL["fin_load_stats"] = _PAY + f"""
SELECT payment_method, COUNT(*) AS payments, {_PAID}, {_COMPLETE} AS complete, {_LATE} AS late FROM payments GROUP BY 1
UNION ALL SELECT 'ALL', COUNT(*), {_PAID}, {_COMPLETE}, {_LATE} FROM payments"""
SQL["kpi_receivables_summary"] = _with(FACT_RECEIVABLES, AGENTS, DIM_DATE) + f"""
SELECT d.date, a.agent_name, substr(r.type_key, 5) AS category,
       CASE r.status_key WHEN 'STAT_RECOUVREE' THEN 'Recouvrée' WHEN 'STAT_NON_RECOUVREE' THEN 'Non recouvrée'
            WHEN 'STAT_PART_RECOUVREE' THEN 'Partiellement recouvrée' END AS status_label,
       COUNT(*) AS receivables, CAST(SUM(amount_due) AS DOUBLE) AS amount_due,
       CAST(SUM(amount_collected) AS DOUBLE) AS amount_collected,
       CAST(SUM(amount_remaining) AS DOUBLE) AS amount_remaining, {_mean('recovery_rate', 8)} AS avg_recovery_rate,
       {_mean('recovery_days')} AS avg_recovery_days, {_LATE} AS late,
       COUNT(*) FILTER (WHERE r.status_key = 'STAT_RECOUVREE') AS closed
FROM (SELECT {_LATENESS} FROM fact_receivables) r LEFT JOIN dim_date d ON r.created_date_key = d.date_key
LEFT JOIN agents a ON r.agent_id = a.agent_id GROUP BY 1, 2, 3, 4"""

# --- several loads --------------------------------------------------------------------------------------

SQL["payments_over_batches"] = _PAY + f"""
SELECT 'total' AS kpi, CAST(NULL AS VARCHAR) AS label, COUNT(*) AS payments, {_PAID} FROM payments
WHERE amount_paid > 0
UNION ALL SELECT 'net', NULL, COUNT(*), CAST(SUM(amount_net) AS DOUBLE) FROM payments WHERE {_SUCCESS}
UNION ALL SELECT 'monthly', strftime(date_trunc('month', payment_date), '%Y-%m-%d'), COUNT(*), {_PAID} FROM payments
          WHERE transaction_type = 'COLLECTE' GROUP BY 2
UNION ALL SELECT 'method', payment_method, COUNT(*), {_PAID} FROM payments GROUP BY 2
UNION ALL SELECT 'complete', NULL, {_COMPLETE}, {_PAID} FROM payments
UNION ALL SELECT 'zone', zone_key, {_LATE}, {_PAID} FROM payments WHERE transaction_type = 'RECOUVREMENT' GROUP BY 2
UNION ALL SELECT 'moved', transaction_type, COUNT(*), {_PAID} FROM payments GROUP BY 2
UNION ALL SELECT 'moved_net', NULL, COUNT(*), CAST(SUM(amount_net) AS DOUBLE) FROM payments"""
SQL["late_parents"] = _with(FACT_RECOVERIES) + """
SELECT CASE WHEN receivable_fact_key IS NULL THEN 'without' ELSE 'with' END AS parent, COUNT(*) AS actions,
       CAST(SUM(effectiveness) AS DOUBLE) AS effectiveness, CAST(SUM(days_since_receivable) AS BIGINT) AS days,
       CAST(SUM(receivable_fact_key) AS BIGINT) AS ids FROM fact_recoveries GROUP BY 1
UNION ALL SELECT 'waiting', COUNT(*), NULL, NULL, CAST(SUM(receivable_id) AS BIGINT) FROM fact_recoveries
          WHERE receivable_fact_key IS NULL AND receivable_id IS NOT NULL HAVING COUNT(*) > 0"""
SQL["recoveries_late_and_future"] = """
SELECT batch, read_from, read_until, actions, ids
FROM (VALUES ('B1', NULL, '2024-01-10'), ('B2', '2024-01-07', '2024-01-20'), ('B3', '2024-01-17', '2024-01-31'))
     AS reads(batch, read_from, read_until)
FULL JOIN (SELECT CASE WHEN event_id % 1000 = 1 OR ts >= TIMESTAMP '2024-01-17' THEN 'B3'
                       WHEN ts >= TIMESTAMP '2024-01-07' THEN 'B2' ELSE 'B1' END AS batch,
                  COUNT(*) AS actions, CAST(SUM(event_id) AS BIGINT) AS ids
           FROM events WHERE ts < TIMESTAMP '2024-01-31' GROUP BY 1) USING (batch)"""
SQL["summary_by_deltas"] = _with(FACT_RECEIVABLES, SOURCE_AGENTS, DIM_DATE) + f"""
SELECT d.date, a.nom || ' C' AS agent_name, 'RECOUVREMENT' AS category,
       CASE r.status_key WHEN 'STAT_RECOUVREE' THEN 'Recouvrée' WHEN 'STAT_NON_RECOUVREE' THEN 'Non recouvrée'
            WHEN 'STAT_PART_RECOUVREE' THEN 'Partiellement recouvrée' END AS status_label,
       COUNT(*) AS receivables, CAST(SUM(amount_due) AS DOUBLE) AS amount_due,
       CAST(SUM(amount_collected) AS DOUBLE) AS amount_collected,
       CAST(SUM(amount_remaining) AS DOUBLE) AS amount_remaining, {_mean('recovery_rate', 8)} AS avg_recovery_rate,
       CAST(NULL AS DOUBLE) AS avg_recovery_days,
       COUNT(*) FILTER (WHERE amount_collected < amount_due AND due_on < DATE '2024-01-31') AS late,
       COUNT(*) FILTER (WHERE r.status_key = 'STAT_RECOUVREE') AS closed
FROM fact_receivables r LEFT JOIN dim_date d ON r.created_date_key = d.date_key
LEFT JOIN source_agents a ON r.agent_id = a.agent_id GROUP BY 1, 2, 3, 4"""
SQL["facts_by_agent_version"] = _with(RECOVERIES) + """
SELECT name, version, kind, COUNT(*) AS actions, CAST(SUM(payment) AS DOUBLE) AS amount FROM (
  SELECT payment, CASE WHEN unnamed THEN NULL WHEN second THEN 'B' ELSE 'A' END AS name,
         CAST(CASE WHEN unnamed THEN NULL WHEN NOT second THEN 1 WHEN kind = 0 THEN 3 ELSE 2 END AS INTEGER) AS version,
         kind
  FROM (SELECT payment, agent_id % 3 AS kind,
               s_suppkey IS NULL OR action_on < DATE '2024-01-10' AS unnamed,
               action_on >= CASE WHEN agent_id % 3 = 0 THEN DATE '2024-01-15' ELSE DATE '2024-01-20' END AS second
        FROM recoveries LEFT JOIN supplier ON agent_id = s_suppkey))
GROUP BY 1, 2, 3"""
SQL["extract_changes"] = """
WITH flags AS (
  SELECT o_orderkey AS id, o_orderkey % 11 <> 3 AS earlier, o_orderkey % 13 <> 5 AS later,
         o_orderkey % 7 = 2 OR (o_orderkey % 17 = 5 AND EXISTS (
             SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) AS different
  FROM orders)
SELECT CASE WHEN NOT earlier THEN 'inserted' WHEN NOT later THEN 'deleted' ELSE 'changed' END AS change,
       COUNT(*) AS requests, CAST(SUM(id) AS BIGINT) AS ids
FROM flags WHERE (earlier OR later) AND (NOT earlier OR NOT later OR different) GROUP BY 1
UNION ALL SELECT 'merged', COUNT(*), CAST(SUM(id) AS BIGINT) FROM flags WHERE later
UNION ALL SELECT 'left', 0, NULL"""

SQL["published_views"] = _with(FACT) + f"""
SELECT 'statut' AS vue, status AS libelle, requests AS nombre_demandes FROM ({_BY_STATUS})
UNION ALL SELECT 'type', zone_type, requests FROM ({_BY_TYPE})"""
SQL["date_keys_with_default"] = _with(FACT_RECEIVABLES) + """
SELECT COALESCE(recovered_date_key, 20240101) AS date_key, COUNT(*) AS receivables FROM fact_receivables GROUP BY 1"""
_ACTIVITY = _with(REQUESTS, """
activity AS (
  SELECT request_id, status, date_trunc('month', created_at) AS month FROM requests
  UNION ALL SELECT request_id, status, date_trunc('month', modified_at) FROM requests)""")
SQL["distinct_by_bitmap"] = _ACTIVITY + """
SELECT 'month' AS level, strftime(month, '%Y-%m') AS period, status, COUNT(DISTINCT request_id) AS requests
FROM activity GROUP BY 2, 3
UNION ALL SELECT 'year', strftime(month, '%Y'), status, COUNT(DISTINCT request_id) FROM activity GROUP BY 2, 3
UNION ALL SELECT 'all', 'all', status, COUNT(DISTINCT request_id) FROM activity GROUP BY 3"""
SQL["median_by_counters"] = _with(REQUESTS) + """
SELECT strftime(created_at, '%Y-%m') AS month, CAST(NULL AS VARCHAR) AS status,
       CAST(median(processing_days) AS DOUBLE) AS median, COUNT(processing_days) AS rows
FROM requests WHERE processing_days IS NOT NULL GROUP BY 1
UNION ALL SELECT NULL, status, CAST(median(processing_days) AS DOUBLE), COUNT(processing_days)
          FROM requests WHERE processing_days IS NOT NULL GROUP BY 2
UNION ALL SELECT NULL, NULL, CAST(median(processing_days) AS DOUBLE), COUNT(processing_days) FROM requests"""
SQL["recon_differences"] = """
SELECT MIN(o_orderkey) AS request_id, 'changed' AS change FROM orders
UNION ALL SELECT (MIN(o_orderkey) + MAX(o_orderkey)) // 2, 'deleted' FROM orders
UNION ALL SELECT MAX(o_orderkey), 'inserted' FROM orders"""
SQL["alert_episodes"] = _with(FACT) + f"""
, wide AS (
  SELECT CAST(date_trunc('month', created_at) AS DATE) AS as_of, {_pct('SUM(n_accepted)', 'COUNT(*)', 2)} AS acceptance,
         {_pct('SUM(n_priority)', 'COUNT(*)', 2)} AS priority FROM fact GROUP BY 1),
history AS (
  SELECT as_of, 'acceptance_rate' AS kpi, acceptance AS value, 36 AS opens, 33 AS closes FROM wide
  UNION ALL SELECT as_of, 'priority_rate', priority, 42, 39 FROM wide),
states AS (
  SELECT *, COALESCE(last_value(CASE WHEN value >= opens THEN 1 WHEN value < closes THEN 0 END IGNORE NULLS)
                     OVER (PARTITION BY kpi ORDER BY as_of), 0) AS state FROM history),
spans AS (
  SELECT *, row_number() OVER (PARTITION BY kpi ORDER BY as_of)
            - row_number() OVER (PARTITION BY kpi, state ORDER BY as_of) AS span,
         MAX(as_of) OVER (PARTITION BY kpi) AS latest FROM states)
SELECT kpi, MIN(as_of) AS first_day, MAX(as_of) AS last_day, COUNT(*) AS days, MAX(value) AS worst,
       MAX(as_of) = MAX(latest) AS is_open
FROM spans WHERE state = 1 GROUP BY kpi, span"""

# --- combined KPIs, quality, monitoring ------------------------------------------------------------------

SQL["dash_status_priority"] = _with(FACT) + f"""
SELECT 'Statuts' AS category, status AS label, requests AS value, share_pct AS pct FROM ({_BY_STATUS})
UNION ALL SELECT 'Priorités', priority_level, requests, share_pct FROM ({_BY_PRIORITY})"""
SQL["kpi_cross"] = _with(FACT) + f"""
SELECT s.status, s.requests AS status_requests, t.zone_type, t.requests AS zone_type_requests
FROM ({_BY_STATUS}) s, ({_BY_TYPE}) t"""
SQL["requests_per_company"] = _with(FACT, DIM_COMPANY) + """
SELECT c.company_name, COUNT(f.request_id) AS requests FROM fact f JOIN dim_company c ON f.company_key = c.company_key
GROUP BY 1 ORDER BY requests DESC, company_name LIMIT 10"""
SQL["business_totals"] = _with(FACT) + f"""
SELECT COUNT(DISTINCT company_key) AS companies, {_MONEY}, {_JOBS} FROM fact"""
SQL["star_row_counts"] = _with(FACT, DIM_COMPANY, DIM_ZONE, DIM_PLOT, DIM_STATUS) + """
SELECT 'fact_requests' AS "table", COUNT(*) AS "rows" FROM fact
UNION ALL SELECT 'dim_company', COUNT(*) FROM dim_company UNION ALL SELECT 'dim_zone', COUNT(*) FROM dim_zone
UNION ALL SELECT 'dim_plot', COUNT(*) FROM dim_plot UNION ALL SELECT 'dim_request_status', COUNT(*) FROM dim_status"""
SQL["kpi_health"] = _with(FACT, DIM_ZONE, DIM_PLOT, DIM_COMPANY, DIM_DATE) + "\nUNION ALL ".join(
    f"SELECT '{name}' AS kpi, COUNT(*) AS \"rows\" FROM ({query})" for name, query in {
        "kpi_by_status": _BY_STATUS, "kpi_by_zone_type": _BY_TYPE, "kpi_by_entity": _ENTITY,
        "kpi_priority_split": _BY_PRIORITY, "kpi_delay_stats": _DELAY, "kpi_priority_trend": _TREND,
        "kpi_delay_finalised": _DELAY + " AND n_finalised > 0", "kpi_financial_performance": _FINANCIAL,
        "kpi_monthly": _MONTHLY, "kpi_by_zone": _ZONE, "kpi_executive": _EXECUTIVE,
        "kpi_acceptance": "SELECT COUNT(*) FROM fact", "kpi_acceptance_finalised": "SELECT COUNT(*) FROM fact",
        "kpi_volume": "SELECT COUNT(*) FROM fact",
    }.items())

_MONITORED = f"""
SELECT 'acceptance_rate' AS kpi, (SELECT {_pct('SUM(n_accepted)', 'SUM(n_finalised)', 2)} FROM fact) AS v,
       30 AS lo, 80 AS hi, '%' AS unit
UNION ALL SELECT 'average_processing_days',
  (SELECT {_mean('processing_days', 1)} FROM fact WHERE n_finalised > 0 AND processing_days > 0), 5, 15, 'days'
UNION ALL SELECT 'total_demands', (SELECT {_N} FROM fact), 1, 1000, 'demands'
UNION ALL SELECT 'pending_demands', (SELECT SUM(n_pending) FROM fact), 0, 50, 'demands'"""
_RATED = f"""
SELECT *, CAST(v AS DECIMAL(20,2)) AS value,
       CASE WHEN v IS NULL THEN 'NULL' WHEN v < lo THEN 'LOW' WHEN v > hi THEN 'HIGH' ELSE 'NORMAL' END AS state
FROM ({_MONITORED})"""
SQL["kpi_alerts"] = _with(FACT) + f"""
SELECT kpi, CAST(value AS DOUBLE) AS value, CAST(CASE state WHEN 'LOW' THEN lo WHEN 'HIGH' THEN hi END AS DOUBLE) AS threshold,
       state AS alert_type, unit,
       CASE state
         WHEN 'NULL' THEN kpi || ': no value could be computed, check the input'
         WHEN 'LOW' THEN kpi || ': ' || value || ' ' || unit || ', expected at least ' || CAST(lo AS DECIMAL(20,2)) || ' ' || unit
         ELSE kpi || ': ' || value || ' ' || unit || ', expected at most ' || CAST(hi AS DECIMAL(20,2)) || ' ' || unit
       END AS message
FROM ({_RATED}) WHERE state <> 'NORMAL'"""
SQL["kpi_snapshot"] = _with(FACT) + f"""
SELECT DATE '2001-12-31' AS as_of, kpi, CAST(value AS DOUBLE) AS value, state AS detail FROM ({_RATED})"""


def _rule_queries() -> str:
    rules = (  # table, column, unique, not null
        ("requests", "requests", "request_id", 1, 1), ("companies", "companies", "company_id", 1, 1),
        ("plots", "plots", "plot_id", 1, 1), ("zones", "zones", "zone_id", 1, 1),
        ("dim_company", "dim_company", "company_key", 1, 1), ("dim_company", "dim_company", "company_id", 1, 1),
        ("dim_company", "dim_company", "company_name", 0, 1),
        ("dim_zone", "dim_zone", "zone_key", 1, 1), ("dim_zone", "dim_zone", "zone_id", 1, 1),
        ("dim_zone", "dim_zone", "zone_code", 1, 1),
        ("dim_plot", "dim_plot", "plot_key", 1, 1), ("dim_plot", "dim_plot", "plot_id", 1, 1),
        ("dim_plot", "dim_plot", "plot_number", 0, 1),
        ("dim_request_status", "dim_status", "status_key", 1, 1), ("dim_request_status", "dim_status", "status", 0, 1),
        ("dim_request_status", "dim_status", "request_type", 0, 1),
        ("dim_date", "data_dates", "date_key", 1, 1), ("dim_date", "data_dates", "date", 1, 1),
        ("fact_requests", "fact", "request_id", 1, 1), ("fact_requests", "fact", "creation_date_key", 0, 1),
        ("fact_requests", "fact", "status_key", 0, 1), ("fact_requests", "fact", "request_count", 0, 1),
    )
    parts = []
    for label, source, column, unique, filled in rules:
        head = f"'{label}' AS \"table\", '{column}' AS \"column\""
        if unique:
            parts.append(f"SELECT 'unique' AS \"check\", {head}, COUNT(*) AS violations FROM (SELECT {column} FROM {source} "
                         f"WHERE {column} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)")
        if filled:
            parts.append(f"SELECT 'not_null' AS \"check\", {head}, COUNT(*) AS violations FROM {source} WHERE {column} IS NULL")
    return "\nUNION ALL ".join(parts)


SQL["dq_rules"] = _with(FACT, DIM_COMPANY, DIM_PLOT, DIM_ZONE, DIM_STATUS, DATA_DAYS, f"""
data_dates AS (SELECT {_DATE_COLUMNS} FROM data_days)""") + _rule_queries()


def _range(table: str, source: str, column: str, rule: str) -> str:
    return (f"SELECT 'range' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", "
            f"COUNT(*) FILTER (WHERE NOT ({rule})) AS violations FROM {source}")


SQL["dq_checks"] = _with(FACT_RECOVERIES) + "\nUNION ALL ".join([
    _range("fact_receivables", "fact_receivables_all", "amount_due", "amount_due >= 0"),
    _range("fact_receivables", "fact_receivables_all", "amount_collected", "amount_collected >= 0"),
    _range("fact_receivables", "fact_receivables_all", "recovery_rate", "recovery_rate BETWEEN 0 AND 1"),
    _range("fact_recoveries", "fact_recoveries", "payment", "payment >= 0"),
    _range("fact_recoveries", "fact_recoveries", "fee", "fee >= 0"),
])


def _orphans(fact: str, source: str, key: str, dimension: str, members: str, null_too: bool = False) -> str:
    missing = f"m.k IS NULL" + ("" if null_too else f" AND f.{key} IS NOT NULL")
    return (f"SELECT '{fact}' AS fact, '{key}' AS \"key\", '{dimension}' AS dimension, COUNT(*) AS orphans "
            f"FROM {source} f LEFT JOIN ({members}) m ON f.{key} = m.k WHERE {missing}")


_AGENT_KEYS = f"SELECT {_hash_agent('agent_id')} AS k FROM agents"
SQL["dq_orphans"] = _with(FACT, DIM_COMPANY, DIM_STATUS, FACT_RECOVERIES, AGENTS) + "\nUNION ALL ".join([
    _orphans("fact_receivables", "fact_receivables", "agent_key", "dim_agent", _AGENT_KEYS),
    _orphans("fact_receivables", "fact_receivables", "type_key", "dim_receivable_type",
             "SELECT unnest(['TYP_RECOUVREMENT','TYP_REDEVANCE','TYP_IMPOT','TYP_TAXE','TYP_AMENDE']) AS k"),
    _orphans("fact_receivables", "fact_receivables", "status_key", "dim_receivable_status",
             "SELECT unnest(['STAT_EN_COURS','STAT_RECOUVREE','STAT_PART_RECOUVREE','STAT_NON_RECOUVREE',"
             "'STAT_ANNULEE','STAT_SUSPENDUE']) AS k"),
    _orphans("fact_recoveries", "fact_recoveries", "receivable_id", "fact_receivables",
             "SELECT receivable_id AS k FROM fact_receivables"),
    _orphans("fact_recoveries", "fact_recoveries", "agent_key", "dim_agent", _AGENT_KEYS),
    _orphans("fact_requests", "fact", "creation_date_key", "dim_date",
             "SELECT creation_date_key AS k FROM fact WHERE creation_date_key IS NOT NULL", True),
    _orphans("fact_requests", "fact", "company_id", "dim_company", "SELECT company_id AS k FROM dim_company", True),
    _orphans("fact_requests", "fact", "status_key", "dim_request_status", "SELECT status_key AS k FROM dim_status", True),
])
SQL["dq_missing_keys"] = _with(FACT) + """
SELECT 'Demandes sans zone' AS problem, COUNT(*) FILTER (WHERE zone_key IS NULL) AS requests FROM fact
UNION ALL SELECT 'Demandes sans entreprise', COUNT(*) FILTER (WHERE company_key IS NULL) FROM fact"""
SQL["recon_counts"] = _with(FACT) + """
SELECT 'Source' AS side, COUNT(*) AS requests FROM orders UNION ALL SELECT 'DWH', COUNT(*) FROM fact"""
SQL["recon_status"] = _with(FACT, DIM_STATUS) + f"""
SELECT COALESCE(a.status, b.status) AS status, COALESCE(a.n, 0) AS source_requests,
       COALESCE(b.n, 0) AS warehouse_requests, COALESCE(a.n, 0) - COALESCE(b.n, 0) AS difference
FROM (SELECT CASE o_orderstatus WHEN 'O' THEN 'EN_COURS' WHEN 'F' THEN 'ACCEPTEE' WHEN 'P' THEN 'REJETEE'
             ELSE 'INCONNU' END AS status, COUNT(*) AS n FROM orders GROUP BY 1) a
FULL JOIN (SELECT s.status, COUNT(*) AS n {_JOIN_STATUS} GROUP BY 1) b ON a.status = b.status"""
