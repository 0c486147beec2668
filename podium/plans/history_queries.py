"""Queries of problem 1: the history of account attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.operators.bitemporal import as_of, as_recorded, bitemporal_ledger
from podium.session import table

ATTRIBUTES = ["commander", "alliance", "server"]


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitemporal_ledger(table(spark, sf_dir, "roster_scans"), "account_id", "scan_id", "ingested_at", ATTRIBUTES)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of an account by what is known now."""
    return as_recorded(_ledger(spark, sf_dir)).select("account_id", "valid_from", F.coalesce("valid_to", F.lit("open")).alias("valid_to"))


def p1_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ledger, superseded rows included."""
    return _ledger(spark, sf_dir)


def p1_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current versions with their attributes."""
    return as_recorded(_ledger(spark, sf_dir)).select("account_id", *ATTRIBUTES, "valid_from", F.coalesce("valid_to", F.lit("open")).alias("valid_to"))


def p1_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who belonged where at the scan of 1 February 2027, by what was recorded by 15 February 2027."""
    return as_of(_ledger(spark, sf_dir), F.lit("20270201T000000"), F.lit("2027-02-15 00:00:00").cast("timestamp")).select("account_id", *ATTRIBUTES, "valid_from")


_VERSIONS = """
WITH one AS (
  SELECT account_id, scan_id, nullif(commander, '') AS commander, nullif(alliance, '') AS alliance, nullif(server, '') AS server
  FROM roster_scans {where}
  QUALIFY row_number() OVER (PARTITION BY account_id, scan_id ORDER BY ingested_at DESC, commander DESC NULLS LAST, alliance DESC NULLS LAST, server DESC NULLS LAST) = 1
), filled AS (
  SELECT account_id, scan_id,
    last_value(commander IGNORE NULLS) OVER w AS commander,
    last_value(alliance IGNORE NULLS) OVER w AS alliance,
    last_value(server IGNORE NULLS) OVER w AS server
  FROM one WINDOW w AS (PARTITION BY account_id ORDER BY scan_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), flagged AS (
  SELECT *, row_number() OVER w AS n,
    lag(commander) OVER w AS pc, lag(alliance) OVER w AS pa, lag(server) OVER w AS ps
  FROM filled WINDOW w AS (PARTITION BY account_id ORDER BY scan_id)
), versions AS (
  SELECT account_id, commander, alliance, server, scan_id AS valid_from,
    lead(scan_id) OVER (PARTITION BY account_id ORDER BY scan_id) AS valid_to
  FROM flagged
  WHERE n = 1 OR commander IS DISTINCT FROM pc OR alliance IS DISTINCT FROM pa OR server IS DISTINCT FROM ps
)
"""

QUERIES = {"p1_found": p1_found, "p1_ledger": p1_ledger, "p1_versions": p1_versions, "p1_as_of": p1_as_of}

ORACLE = {
    "p1_found": _VERSIONS.format(where="") + "SELECT account_id, valid_from, coalesce(valid_to, 'open') AS valid_to FROM versions",
    # The versions as known at each time something of the account was recorded; a row lasts while they follow one another.
    "p1_ledger": """
WITH facts AS (
  SELECT account_id, scan_id, ingested_at, nullif(commander, '') AS commander, nullif(alliance, '') AS alliance, nullif(server, '') AS server FROM roster_scans
  WHERE account_id IS NOT NULL AND scan_id IS NOT NULL AND ingested_at IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY account_id, scan_id, ingested_at ORDER BY nullif(commander, '') DESC NULLS LAST, nullif(alliance, '') DESC NULLS LAST, nullif(server, '') DESC NULLS LAST) = 1
), times AS (
  SELECT account_id, ingested_at AS at, row_number() OVER (PARTITION BY account_id ORDER BY ingested_at) AS k FROM (SELECT DISTINCT account_id, ingested_at FROM facts)
), known AS (
  SELECT t.k, f.* FROM times t JOIN facts f ON f.account_id = t.account_id AND f.ingested_at <= t.at
  QUALIFY row_number() OVER (PARTITION BY t.account_id, t.k, f.scan_id ORDER BY f.ingested_at DESC) = 1
), filled AS (
  SELECT account_id, k, scan_id, last_value(commander IGNORE NULLS) OVER w AS commander, last_value(alliance IGNORE NULLS) OVER w AS alliance, last_value(server IGNORE NULLS) OVER w AS server
  FROM known WINDOW w AS (PARTITION BY account_id, k ORDER BY scan_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), flagged AS (
  SELECT *, row_number() OVER w AS n, lag(commander) OVER w AS pc, lag(alliance) OVER w AS pa, lag(server) OVER w AS ps FROM filled WINDOW w AS (PARTITION BY account_id, k ORDER BY scan_id)
), versions AS (
  SELECT account_id, k, commander, alliance, server, scan_id AS valid_from, lead(scan_id) OVER (PARTITION BY account_id, k ORDER BY scan_id) AS valid_to
  FROM flagged WHERE n = 1 OR commander IS DISTINCT FROM pc OR alliance IS DISTINCT FROM pa OR server IS DISTINCT FROM ps
), runs AS (
  SELECT *, k - row_number() OVER (PARTITION BY account_id, commander, alliance, server, valid_from, valid_to ORDER BY k) AS run FROM versions
), ledger AS (
  SELECT account_id, commander, alliance, server, valid_from, valid_to, min(k) AS k0, max(k) + 1 AS k1 FROM runs GROUP BY account_id, commander, alliance, server, valid_from, valid_to, run
)
SELECT l.account_id, commander, alliance, server, valid_from, valid_to, a.at AS recorded_from, b.at AS recorded_to
FROM ledger l JOIN times a ON a.account_id = l.account_id AND a.k = k0 LEFT JOIN times b ON b.account_id = l.account_id AND b.k = k1""",
    "p1_versions": _VERSIONS.format(where="") + "SELECT account_id, commander, alliance, server, valid_from, coalesce(valid_to, 'open') AS valid_to FROM versions",
    "p1_as_of": _VERSIONS.format(where="WHERE ingested_at <= TIMESTAMPTZ '2027-02-15 00:00:00+00'")
    + "SELECT account_id, commander, alliance, server, valid_from FROM versions WHERE valid_from <= '20270201T000000' AND (valid_to IS NULL OR valid_to > '20270201T000000')",
}
