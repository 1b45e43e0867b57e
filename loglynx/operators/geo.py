"""Geo enrichment from a cache table.

Live lookups against an outside service are not a Spark job; the cache is a
table (an append log of lookups, latest wins) and ``geo_misses`` lists the
addresses an outside loader still has to fetch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import is_private

# ---------------------------------------------------------------------------
# Cache lifetime and the texts used for private / unknown rows.
# ---------------------------------------------------------------------------
CACHE_TTL_DAYS = 7
PRIVATE_GEO = {"country": "Private", "country_code": "LAN", "city": "LAN", "org": "Private Network"}
UNKNOWN_GEO = {"country": "Unknown", "country_code": "??", "city": "Unknown", "org": "Unknown"}
# ---------------------------------------------------------------------------

GEO_FIELDS = ("country", "country_code", "city", "org")


def geo_latest(geo_log: DataFrame) -> DataFrame:
    """K4: one row per address, the newest lookup wins (ties: larger org, country...).

    ``max(struct(cached_at, ...))`` is a partial aggregate, so the log is
    combined map-side before the shuffle."""
    best = F.max(F.struct("cached_at", "org", "country", "country_code", "city", "is_private")).alias("b")
    g = geo_log.groupBy("ip").agg(best)
    return g.select("ip", *[F.col(f"b.{c}").alias(c) for c in GEO_FIELDS],
                    F.col("b.is_private").alias("is_private"), F.col("b.cached_at").alias("cached_at"))


def geo_enrich(df: DataFrame, geo: DataFrame, ip_col: str = "ip", at: Column | str | None = None,
               ttl_days: int = CACHE_TTL_DAYS) -> DataFrame:
    """Attach country / code / city / org / is_private to ``df``.

    Private addresses short-circuit to the LAN texts; otherwise a cache row
    younger than the TTL (strictly) at time ``at`` is used; otherwise the
    unknown texts.  ``at`` is a column or timestamp literal (default: the
    cache row always counts as fresh).
    """
    g = geo.select(F.col("ip").alias("_gip"), *[F.col(c).alias(f"_g_{c}") for c in GEO_FIELDS],
                   F.col("cached_at").alias("_g_at"))
    cond = df[ip_col] == F.col("_gip")
    if at is not None:
        at_c = at if isinstance(at, Column) else (F.col(at) if at in df.columns else F.lit(at).cast("timestamp"))
        cond = cond & (at_c - F.make_dt_interval(days=F.lit(ttl_days)) < F.col("_g_at"))
    j = df.join(g, cond, "left")
    priv = is_private(F.col(ip_col))
    cols = [F.col(c) for c in df.columns]
    for c in GEO_FIELDS:
        cols.append(F.when(priv, F.lit(PRIVATE_GEO[c]))
                    .otherwise(F.coalesce(F.col(f"_g_{c}"), F.lit(UNKNOWN_GEO[c]))).alias(c))
    cols.append(priv.alias("is_private"))
    return j.select(*cols)


def geo_label(ip: Column, private: Column, cc: Column, city: Column, org: Column) -> Column:
    """N17: '' for no address, '[LAN]' for private, else '[CC / City / Org]'."""
    return (F.when(ip.isNull() | (ip == ""), F.lit(""))
            .when(private, F.lit("[LAN]"))
            .otherwise(F.concat(F.lit("["), cc, F.lit(" / "), city, F.lit(" / "), org, F.lit("]"))))


def geo_misses(ips: DataFrame, geo: DataFrame, as_of, ip_col: str = "ip",
               ttl_days: int = CACHE_TTL_DAYS) -> DataFrame:
    """Distinct external addresses without a fresh cache row -> work list."""
    a = F.lit(as_of).cast("timestamp")
    ext = ips.select(F.col(ip_col).alias("ip")).filter(
        F.col("ip").isNotNull() & (F.col("ip") != "") & ~is_private(F.col("ip"))).distinct()
    fresh = geo.filter(a - F.make_dt_interval(days=F.lit(ttl_days)) < F.col("cached_at")).select(
        F.col("ip").alias("_gip"))
    return ext.join(fresh, ext["ip"] == F.col("_gip"), "left_anti")


def geo_of(geo: DataFrame, ip: str, at=None, ttl_days: int = CACHE_TTL_DAYS) -> DataFrame:
    """Geo attributes of one address (private / cached / unknown)."""
    one = geo.sparkSession.createDataFrame([(ip,)], "ip string")
    return geo_enrich(one, geo.filter(F.col("ip") == ip), "ip", at, ttl_days)
