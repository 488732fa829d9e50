"""Market snapshots: validity, hash, sizes, latest payload and its symbols."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.functions.arguments import one_of, require
from candlemill.operators.keyed import latest_snapshots
from candlemill.schema import MARKETS, QUOTE_ASSET, SNAPSHOT, SNAPSHOT_ENDPOINT, STABLE_BASES, SYMBOL_ENTRY

ENVELOPE = ("pulled_at", "source_url", "status_code", "latency_ms", "err_msg")
_KEY = ["market", "endpoint", "pulled_at", "payload_hash"]


# --------------------------------------------------------------------- ingest

def payload_hash(payload: Column) -> Column:
    return F.sha2(payload, 256)


def is_json(payload: Column) -> Column:
    """Does the whole text hold one JSON document, by the rules of Python's reader.

    Repeated keys, ``NaN`` and infinities are fine; trailing text, single quotes, control characters in
    strings and nesting without end are not. Spark's own readers stop after the document and take single
    quotes, so this one function runs in Python, batch by batch. A NULL holds none.
    """

    def judged(texts: pd.Series) -> pd.Series:
        import json

        def holds(text) -> bool:
            try:
                json.loads(text)
            except (ValueError, TypeError, RecursionError):
                return False
            return True

        return texts.map(holds).astype(bool)

    return F.pandas_udf(judged, "boolean")(payload)


def with_envelope(documents: DataFrame, envelopes: DataFrame) -> DataFrame:
    """Pulled documents with what is known of each pull; a pull that brought no document is kept.

    ``documents`` (market, name, pulled_at, source_url, payload) and ``envelopes`` (market, name and any of
    pulled_at, source_url, status_code, latency_ms, err_msg, NULL where not told) meet on market and
    name. A document without envelope was pulled well, status 200; an envelope without document has an
    empty payload, and status 0 where it tells none.
    """
    known = envelopes.select("market", "name", *[F.col(c).alias(f"_{c}") for c in ENVELOPE])
    both = documents.withColumn("_document", F.lit(True)).join(known, ["market", "name"], "full_outer")
    status = F.when(F.col("_document"), F.lit(200)).otherwise(F.lit(0))
    return both.select(
        F.coalesce("_pulled_at", "pulled_at").alias("pulled_at"), "market", "name",
        F.coalesce("_source_url", "source_url").alias("source_url"),
        F.coalesce(F.col("_status_code"), status).cast("int").alias("status_code"),
        F.coalesce(F.col("_latency_ms"), F.lit(0)).cast("long").alias("latency_ms"),
        F.coalesce("payload", F.lit("")).alias("payload"), F.col("_err_msg").alias("err_msg"),
    )


def broken_pulls(pulls: DataFrame) -> DataFrame:
    """Pulls that say they went well but brought no JSON document."""
    return pulls.filter((F.col("status_code") == 200) & ~is_json(F.col("payload")))


def payload_sizes(snapshots: DataFrame) -> DataFrame:
    """How many symbols and assets each payload lists; 0 where the array is absent."""
    arrays = F.from_json("payload", "symbols array<string>, assets array<string>")
    return snapshots.withColumn("_arrays", arrays).select(
        *[c for c in snapshots.columns if c != "payload"],
        _size("symbols").alias("symbols_count"),
        _size("assets").alias("assets_count"),
    )


def snapshot_rows(landed: DataFrame, ingest_version: Column | None = None) -> DataFrame:
    """Landed payloads as table rows, with their hash; the error message is that of the pull, if any."""
    version = ingest_version if ingest_version is not None else F.unix_millis(F.current_timestamp())
    if "err_msg" not in landed.columns:
        landed = landed.withColumn("err_msg", F.lit(None).cast("string"))
    return (
        landed.withColumn("endpoint", F.lit(SNAPSHOT_ENDPOINT))
        .withColumn("payload_hash", payload_hash(F.col("payload")))
        .withColumn("ingest_version", version)
        .select(*[F.col(f.name).cast(f.dataType) for f in SNAPSHOT.fields])
    )


# -------------------------------------------------------------------- queries

def good_snapshots(snapshots: DataFrame) -> DataFrame:
    """Current rows of the endpoint that were fetched successfully."""
    rows = snapshots.filter(F.col("endpoint") == SNAPSHOT_ENDPOINT)
    return latest_snapshots(rows).filter(F.col("status_code") == 200)


def latest_payloads(snapshots: DataFrame, markets: Sequence[str]) -> DataFrame:
    """The newest good snapshot of each of the markets.

    It is found without the payload column. The broadcast side is one narrow row per
    listed market, and its partition month limits which payloads are read at all.
    """
    rows = snapshots.filter(F.col("market").isin(list(markets)))
    key = [c for c in ("month", *_KEY) if c in rows.columns]
    newest = Window.partitionBy("market").orderBy(
        F.col("pulled_at").desc(), F.col("payload_hash").desc()
    )
    picked = (
        good_snapshots(rows.drop("payload", "err_msg"))
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .select(*key)
    )
    return (
        rows.select(*key, "payload")
        .join(F.broadcast(picked), key)
        .groupBy(*key)
        .agg(F.first("payload").alias("payload"))
    )


def listed_symbols(payloads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per entry of the payload's symbol array; missing fields are '' or 0.

    Entries are read one by one, so an odd one spoils no other; one that is no object lacks all.
    """
    raw = F.explode(F.from_json("payload", "symbols array<string>")["symbols"])
    entries = payloads.select(*keep, raw.alias("_raw")).withColumn(
        "_entry", F.from_json("_raw", SYMBOL_ENTRY)
    )
    text = lambda name: F.coalesce(F.col(f"_entry.{name}"), F.lit("")).alias(name)
    number = lambda name: F.coalesce(F.col(f"_entry.{name}"), F.lit(0)).cast("long").alias(name)
    return entries.select(
        *keep, text("symbol"), text("quoteAsset"), number("onboardDate"), number("deliveryDate"),
        text("underlyingType"), text("status"), text("baseAsset"),
    )


def filter_symbols(
    symbols: DataFrame, quote_asset: str | None = None, exclude_stable_base: bool = False
) -> DataFrame:
    if quote_asset is not None:
        wanted = quote_asset.strip().upper()
        require(re.fullmatch(QUOTE_ASSET, wanted), f"no quote asset is named {quote_asset!r}")
        symbols = symbols.filter(F.col("quoteAsset") == wanted)
    if exclude_stable_base:
        symbols = symbols.filter(~F.col("baseAsset").isin(*STABLE_BASES))
    return symbols.drop("baseAsset")


def query_symbols(
    snapshots: DataFrame,
    market: str = "um",
    quote_asset: str | None = None,
    exclude_stable_base: bool = False,
) -> DataFrame:
    """Symbols in the newest good snapshot of one market, by name."""
    payloads = latest_payloads(snapshots, [one_of(market, MARKETS, "market")])
    listed = filter_symbols(listed_symbols(payloads), quote_asset, exclude_stable_base)
    return listed.orderBy("symbol")


def _size(name: str) -> Column:
    return F.greatest(F.coalesce(F.size(F.col(f"_arrays.{name}")), F.lit(0)), F.lit(0))
