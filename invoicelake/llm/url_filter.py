"""URL filter by a temporal list join.

A list is a history of dated entries that add or remove a domain. Each entry is valid from its date to
the next entry of the same domain on the same list, so the history of a list becomes disjoint validity
intervals; those of several lists may overlap. A capture is held against the intervals of its host and
of all parent domains that contain its fetch time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from invoicelake.llm.shared import named_apart

HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def host_of(url: Column) -> Column:
    """The host in lower case without port, user and last dot; null if the URL has none."""
    host = F.rtrim(F.regexp_extract(url, HOST, 1), F.lit("."))
    return F.when(host != "", F.lower(host))


def domains_of(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    parts = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )


def validity(entries: DataFrame) -> DataFrame:
    """(domain, reason, valid_from, valid_to) from (domain, listed, dated, reason) and maybe `list`.

    Entries with a column `list` are the histories of several lists, each by itself (null is a list
    too): none takes off what another one named. Without it all are one list, whatever their reason.
    `listed` false takes the domain off. Of entries of one domain and date, removals come first and
    reasons in order, so the last one counts. An open interval ends never (null). Entries without
    domain or date are left out.
    """
    history = [c for c in ("domain", "list") if c in entries.columns]
    in_history = Window.partitionBy(*history).orderBy(
        "dated", F.col("listed").asc(), F.col("reason").asc_nulls_first())
    known = entries.filter("domain IS NOT NULL AND dated IS NOT NULL AND listed IS NOT NULL")
    spans = known.select(*history, "listed", "dated", "reason").distinct().withColumn("valid_to", F.lead("dated").over(in_history))
    return spans.filter("listed AND (valid_to IS NULL OR valid_to > dated)").select(
        "domain", "reason", F.col("dated").alias("valid_from"), "valid_to")


def judged(captures: DataFrame, entries: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, url, host, fetched, n_active, domain, reason, blocked) of captures (key, url, fetched).

    `n_active` counts the listings that hold, one for each list and domain. `domain` is the longest of
    them and `reason` that of its latest listing, the last in order of several. Captures without host or fetch
    time, and hosts that no entry names, are not blocked. Repeated rows are answered once each. An
    empty list blocks nothing. Other columns are not read.
    """
    named_apart(captures, key, "url", "fetched")
    rows = captures.groupBy(key, "url", "fetched").agg(F.count("*").alias("_rows")).withColumn(
        "host", host_of(F.col("url")))
    asked = rows.select(key, "url", "fetched", F.explode(domains_of(F.col("host"))).alias("domain"))
    # Intervals of one list are disjoint: a capture meets one of them at most for each domain.
    hits = asked.join(validity(entries), "domain").filter(
        "fetched >= valid_from AND (valid_to IS NULL OR fetched < valid_to)")
    best = hits.groupBy(key, "url", "fetched").agg(
        F.count("*").alias("n_active"),
        F.max(F.struct(F.length("domain").alias("size"), "domain", "valid_from", "reason"))
        .alias("best"))
    found = rows.alias("r").join(
        best.alias("b"),
        F.expr(f"r.`{key}` <=> b.`{key}` AND r.url = b.url AND r.fetched = b.fetched"), "left")
    return found.select(
        F.explode(F.array_repeat(F.lit(0), F.col("_rows").cast("int"))).alias("_copy"),
        F.col(f"r.{key}"), F.col("r.url"), "host", F.col("r.fetched"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.col("best.domain").alias("domain"), F.col("best.reason").alias("reason"),
        F.col("n_active").isNotNull().alias("blocked"),
    ).drop("_copy")
