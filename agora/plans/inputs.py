"""Raw-shaped inputs derived from the driver's tables.

The pipeline reads dirty all-text files.  To exercise it on the driver's
parquet tables, each raw file is *derived* from a table by a projection
that writes its values as text with the same kinds of dirt (blank cells,
``NA`` / ``S`` markers, decimal commas, padding, non-numbers).  Values
are built from integer columns only, so every engine renders the same
strings.  A derivation is a table name plus SQL select-list items: Spark
runs them with ``selectExpr`` over the whole table (the oracle SQL uses
the very same items), so the work grows with the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from agora.sources.raw import read_testdata, spread_rows


@dataclass(frozen=True)
class Derivation:
    table: str
    items: tuple[str, ...]
    #: Columns the items read, if they make so much of a row that the rows are dealt out first.
    spread: tuple[str, ...] = ()

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = read_testdata(spark, sf_dir, self.table)
        if self.spread:
            rows = spread_rows(rows.select(*self.spread))
        return rows.selectExpr(*self.items)

    def sql(self) -> str:
        return f"SELECT {', '.join(self.items)} FROM {self.table}"


def _q(c: str) -> str:
    return f"CAST(CAST(FLOOR({c}) AS BIGINT) AS STRING)"


# lineitem -> dirty numeric text (C20 / C21) ----------------------------------
LI_DIRTY_DOUBLE = (
    "CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN 'S' WHEN 3 THEN ' NA ' WHEN 4 THEN NULL "
    "WHEN 5 THEN 'x' || CAST(l_partkey AS STRING) "
    f"WHEN 6 THEN ' ' || {_q('l_quantity')} || '.25' "
    f"ELSE '  ' || {_q('l_quantity')} || ',5 ' END")
LI_DIRTY_INT = (
    "CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN 'S' "
    f"WHEN 3 THEN {_q('l_quantity')} || ',5' WHEN 4 THEN NULL "
    f"ELSE ' ' || {_q('l_quantity')} || '.7 ' END")
LINEITEM_DIRTY = Derivation("lineitem", (
    "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
    f"{LI_DIRTY_DOUBLE} AS d_text", f"{LI_DIRTY_INT} AS i_text"))

# orders -> three association files (B1) ---------------------------------------
ASSOC_BRANCHES = [("'1-URGENT'", "'2-HIGH'"), ("'3-MEDIUM'",), ("'4-NOT SPECIFIED'", "'5-LOW'")]
ASSOC_ITEMS = ("CAST(o_custkey AS STRING) AS adrs_codeinsee", "o_orderstatus AS position",
               "o_orderpriority")
ASSOC_PREFIXES = ("1", "2", "3")
ASSOC_ACTIVE = "F"
ASSOC_SOURCE = "orders.parquet"

# events -> crime file (B2) -----------------------------------------------------
EV_CENTS = "CAST(ROUND(value * 100) AS BIGINT)"
EVENTS_CRIME = Derivation("events", (
    "CAST(user_id AS STRING) AS CODGEO_2025",
    "CASE WHEN event_id % 97 = 0 THEN 'n/a' WHEN event_id % 10 = 0 THEN '2023' "
    "ELSE CAST(YEAR(ts) AS STRING) END AS annee",
    "event_type AS indicateur",
    f"CASE WHEN event_id % 11 = 0 THEN 'NA' WHEN event_id % 13 = 0 THEN '' "
    f"ELSE ' ' || CAST(CAST(FLOOR({EV_CENTS} / 100) AS BIGINT) AS STRING) || ',' || "
    f"LPAD(CAST({EV_CENTS} % 100 AS STRING), 2, '0') || ' ' END AS taux_pour_mille"))
CRIME_YEAR = 2024
CRIME_PREFIXES = ("2", "3", "4", "5", "6", "7", "8", "9")
CRIME_INDICATORS = {"click": "taux_cambriolage", "purchase": "taux_violence_famille",
                    "signup": "taux_violence_sexuelle", "view": "taux_vols_armes"}
CRIME_SOURCE = "events.parquet"
PATCH_CODE = "0"

# lineitem -> election general results (B5) -------------------------------------
LQ = "CAST(l_quantity AS BIGINT)"
LINEITEM_ELECTIONS = Derivation("lineitem", (
    "l_returnflag AS code_departement", "l_linestatus AS libelle_departement",
    "CAST(l_suppkey AS STRING) AS code_commune", "'S' || CAST(l_suppkey AS STRING) AS libelle_commune",
    f"CASE WHEN l_suppkey = 7 THEN 'NA' WHEN l_suppkey = 3 THEN '0' WHEN l_linenumber = 1 THEN '' "
    f"ELSE CAST({LQ} * 10 AS STRING) END AS inscrits",
    f"CAST({LQ} * 3 AS STRING) AS abstentions",
    f"CASE WHEN l_suppkey = 3 THEN '0' WHEN l_suppkey = 5 THEN CAST({LQ} * 12 AS STRING) "
    f"ELSE CAST({LQ} * 7 AS STRING) END AS votants",
    "CAST(l_linenumber AS STRING) || ',0' AS blancs",
    "CASE WHEN l_linenumber = 2 THEN 'NA' ELSE CAST(l_linenumber % 3 AS STRING) END AS nuls",
    f"CAST({LQ} * 7 - l_linenumber AS STRING) AS exprimes"))
ELECTION_PREFIXES = ("A", "R")
ELECTIONS_SOURCE = "lineitem.parquet"

# orders -> candidate results (B6) ----------------------------------------------
ORDERS_CANDIDATES = Derivation("orders", (
    "SUBSTR(o_orderpriority, 1, 1) AS code_departement", "o_orderpriority AS libelle_departement",
    "CAST(o_custkey AS STRING) AS code_commune", "'C' || CAST(o_custkey AS STRING) AS libelle_commune",
    "' ' || o_orderstatus || ' ' AS prenom",
    "CASE o_orderkey % 6 WHEN 0 THEN ' automobile' WHEN 1 THEN 'Building ' WHEN 2 THEN 'FURNITURE' "
    "WHEN 3 THEN ' household ' WHEN 4 THEN 'machinery' ELSE 'Nobody' END AS nom",
    "CASE WHEN o_custkey % 50 = 0 THEN '0' WHEN o_custkey % 77 = 0 THEN 'NA' "
    "WHEN o_orderkey % 17 = 0 THEN '' "
    "ELSE ' ' || CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 1000 AS STRING) || '.0 ' END AS voix"))
CANDIDATE_DEPARTMENTS = ("1", "2", "3")
CANDIDATES_SOURCE = "orders.parquet"
UNKNOWN_CANDIDATE = (0, "APPLICABLE")

# customer -> socio-demographic file (B4) ---------------------------------------
# Rule-built columns: value = base + (c_custkey * mult) % mod, written as
# text; a cell is 'S' (secret) when c_custkey % secret == 0.  Double
# columns get a decimal comma and one decimal digit.
K = "c_custkey"


def _int_text(base: int, mult: int, mod: int, secret: int | None = None) -> str:
    v = f"CAST({base} + ({K} * {mult}) % {mod} AS STRING)"
    return f"CASE WHEN {K} % {secret} = 0 THEN 'S' ELSE {v} END" if secret else v


def _dbl_text(base: int, mult: int, mod: int, secret: int | None = None) -> str:
    v = (f"CAST({base} + ({K} * {mult}) % {mod} AS STRING) || ',' || "
         f"CAST(({K} * {mult}) % 10 AS STRING)")
    return f"CASE WHEN {K} % {secret} = 0 THEN 'S' ELSE {v} END" if secret else v


POP = f"(1000 + ({K} * 7) % 5000)"
MEN = f"(500 + ({K} * 7) % 2500)"
SOCIO_ITEMS = [
    f"CAST({K} AS STRING) AS CODGEO",
    f"CASE WHEN {K} % 23 = 0 THEN 'S' WHEN {K} % 61 = 0 THEN '-5' "
    f"ELSE CAST(15000 + ({K} * 37) % 20000 AS STRING) || ',5' END AS MED21",
    f"{_dbl_text(5, 7, 40)} AS TP6021",
    f"{_dbl_text(5, 3, 40, 19)} AS TP60AGE121",
    f"{_dbl_text(5, 5, 40)} AS TP60AGE221",
    f"{_dbl_text(5, 11, 40)} AS TP60AGE321",
    f"{_dbl_text(5, 13, 40)} AS TP60AGE421",
    f"{_dbl_text(5, 17, 40)} AS TP60AGE521",
    f"{_dbl_text(5, 19, 40, 17)} AS TP60AGE621",
    f"{_int_text(8000, 3, 4000, 31)} AS D121",
    f"{_int_text(30000, 7, 20000)} AS D921",
    f"{_dbl_text(60, 3, 30)} AS PACT21",
    f"{_dbl_text(5, 7, 10)} AS PBEN21",
    f"{_dbl_text(2, 11, 5)} AS PPAT21",
    f"{_dbl_text(10, 13, 15)} AS PPSOC21",
    f"{_dbl_text(1, 17, 7)} AS PPLOGT21",
    f"CASE WHEN {K} % 211 = 0 THEN 'S' WHEN {K} % 223 = 0 THEN '' WHEN {K} % 227 = 0 THEN '0' "
    f"ELSE CAST({POP} AS STRING) END AS P22_POP",
    f"{_int_text(180, 13, 600)} AS P22_POP0014",
    f"{_int_text(200, 3, 900)} AS P22_POP1529",
    f"{_int_text(220, 17, 900)} AS P22_POP3044",
    f"{_int_text(150, 5, 800)} AS P22_POP4559",
    f"{_int_text(100, 11, 700)} AS P22_POP6074",
    f"{_int_text(50, 19, 300)} AS P22_POP7589",
    f"{_int_text(0, 23, 40)} AS P22_POP90P",
    f"CAST({MEN} AS STRING) AS P22_POPH",
    f"CAST({POP} - {MEN} + CASE WHEN {K} % 41 = 0 THEN 5 ELSE 0 END AS STRING) AS P22_POPF",
    f"{_int_text(0, 3, 50)} AS P22_CHOM1524",
    f"{_int_text(0, 7, 150, 43)} AS P22_CHOM2554",
    f"{_int_text(0, 11, 40)} AS P22_CHOM5564",
    f"CASE WHEN {K} % 53 = 0 THEN '0' WHEN {K} % 59 = 0 THEN '10' "
    f"ELSE CAST(400 + ({K} * 7) % 2000 AS STRING) END AS P22_ACT15P",
    f"{_int_text(300, 5, 1500)} AS P22_ACTOCC15P",
    f"{_int_text(250, 3, 1200)} AS P22_SAL15P",
    f"{_int_text(20, 7, 200)} AS P22_NSAL15P",
    f"{_int_text(300, 1, 1000)} AS P22_EMPLT_SAL",
    f"{_int_text(10, 1, 100)} AS P22_EMPLT_NSAL",
    f"{_int_text(0, 1, 30)} AS ENCTOT24",
    f"{_int_text(50, 13, 400)} AS ETNTOT23",
    f"{_int_text(100, 17, 3000)} AS ETPTOT24",
    f"{_int_text(500, 7, 2500)} AS P22_LOG",
    f"{_int_text(0, 3, 200)} AS P22_LOGVAC",
    f"{_int_text(0, 11, 600, 47)} AS P22_RP_LOCHLMV",
]
CUSTOMER_SOCIO = Derivation("customer", tuple(SOCIO_ITEMS), spread=(K,))
SOCIO_PREFIXES = ("1", "2", "3", "4", "5", "6", "7", "8", "9")
SOCIO_SOURCE = "customer.parquet"

# orders -> commune labels (label source of the commune dimension) --------------
ORDERS_LABELS = Derivation("orders", (
    "CAST(o_custkey AS STRING) AS code_commune",
    "CASE WHEN o_custkey % 100 = 7 THEN 'Commune ' || CAST(o_custkey AS STRING) || '-' || o_orderstatus "
    "ELSE 'Commune ' || CAST(o_custkey AS STRING) END AS libelle_commune"))
CUSTOMER_COMMUNES = Derivation("customer", ("CAST(c_custkey AS STRING) AS code_commune",))

# pages -> ingest manifest (I1) -------------------------------------------------
PAGE_PATH = "regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1)"
PAGES_MANIFEST = Derivation("pages", (
    "page_id",
    f"split_part({PAGE_PATH}, '/', 2) AS category",
    f"regexp_extract({PAGE_PATH}, '([^/]*)$', 1) AS filename",
    "url"))
# entries that were announced and never landed: one file per nation
NATIONS_MANIFEST = Derivation("nation", (
    "CAST(-1 - n_nationkey AS BIGINT) AS page_id", "'nation' AS category", "n_name || '.csv' AS filename",
    "'absent://nation/' || CAST(n_nationkey AS STRING) AS url"))
PAGES_LANDED = Derivation("pages", ("url", "octet_length(html) AS length"))
BUCKET = "datalake"
RAW_PREFIX = "raw_2"
