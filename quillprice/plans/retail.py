"""Retail shop survey procedure.

Registries are returned as new versions (old rows + new rows); the feed
enrichment returns the enriched feed. The reference reads a view of the
registries that is not part of it; ``parts_view`` is the inferred join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillprice.functions import dates, text
from quillprice.functions.collation import union_into
from quillprice.operators.aggregates import conditional_max, price_sums, stats_of_sums
from quillprice.operators.joins import anti_join, lookup_join
from quillprice.operators.windows import global_row_number, partition_row_number

KEYS = ["RETAIL_XMFG", "CLEANPRODUCTBRAND", "CLEANPRODUCTNUMBER"]
# Joins and groups name the part number first: rows that are sorted by it are told
# apart by their first key, not by the last one after a few retailers and brands.
_BY_NUMBER = KEYS[::-1]
BRAND_COLUMNS = ("BrandID", "RetailXmfg", "PRODUCTBRAND", "CLEANPRODUCTBRAND", "AltXmfg")
PART_COLUMNS = ("BrandID", "PRODUCTNUMBER", "PartName", "CLEANPRODUCTNUMBER")

# Own-brand competitor codes and the part classes (LFC first digit).
OWN_BRANDS = {"ACI": "ACI", "PRO": "PRO", "HDC": "Hayden"}
LFC_PREFIXES = ("2", "3", "4")


def _priced(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("PRICE") > 0)


# --- X4: brands ----------------------------------------------------------------------

def new_brands(feed: DataFrame, brands: DataFrame) -> DataFrame:
    """Distinct (retailer, brand) of priced rows with a brand, not yet registered."""
    cand = (_priced(feed).filter(text.not_blank(F.col("PRODUCTBRAND")))
            .select(F.col("RETAIL_XMFG").alias("RetailXmfg"), "PRODUCTBRAND").distinct())
    return anti_join(cand, brands, [("RetailXmfg", "RetailXmfg"), ("PRODUCTBRAND", "PRODUCTBRAND")])


def assign_brand_ids(new: DataFrame, brands: DataFrame) -> DataFrame:
    """Identity-style ids continuing after the highest registered id.

    Ids follow (RetailXmfg, PRODUCTBRAND) order; the highest registered id is
    a one-row aggregate fed into the numbering's running sum (no driver trip).
    """
    top = brands.agg(F.max("BrandID").alias("top"))
    return global_row_number(new, ["RetailXmfg", "PRODUCTBRAND"], "BrandID", start=top)


def brand_registry_update(feed: DataFrame, brands: DataFrame) -> DataFrame:
    """Registry + newly seen brands (clean brand and alt code unset)."""
    added = assign_brand_ids(new_brands(feed, brands), brands).select(
        "BrandID", "RetailXmfg", "PRODUCTBRAND",
        F.lit(None).cast("string").alias("CLEANPRODUCTBRAND"),
        F.lit(None).cast("string").alias("AltXmfg"))
    return union_into(brands.select(*BRAND_COLUMNS), added)


def parts_view(brands: DataFrame, parts: DataFrame) -> DataFrame:
    """The registry view: brands joined to their parts on BrandID (inferred).

    One brand can own a large share of the parts: both registries are stored
    tables, so the brands are broadcast when small and AQE splits the brand otherwise.
    """
    return parts.join(brands, "BrandID").select(
        "RetailXmfg", "PRODUCTBRAND", "PRODUCTNUMBER", "CLEANPRODUCTBRAND", "CLEANPRODUCTNUMBER",
        "PartName", "AltXmfg")


# --- X5: parts -----------------------------------------------------------------------

def candidate_parts(feed: DataFrame) -> DataFrame:
    return (_priced(feed).filter(text.not_blank(F.col("PRODUCTNUMBER"))
                                 & text.not_blank(F.col("PRODUCTBRAND")))
            .select("RETAIL_XMFG", "PRODUCTBRAND", "PRODUCTNUMBER", "PRODUCTNAME").distinct())


def unregistered_parts(feed: DataFrame, brands: DataFrame, parts: DataFrame,
                       one_name_per_part: bool = False) -> DataFrame:
    """(retailer, brand, number, name) of priced rows that the registry lacks.

    A part with two names is new twice (SURVEY Q15). ``one_name_per_part=True``
    keeps the lowest name per part instead (an aggregate, so a part with many
    names is combined map-side).
    """
    view = parts_view(brands, parts)
    cand = candidate_parts(feed)
    if one_name_per_part:
        cand = cand.groupBy("PRODUCTNUMBER", "PRODUCTBRAND", "RETAIL_XMFG").agg(
            F.min("PRODUCTNAME").alias("PRODUCTNAME")).select(*cand.columns)
    return anti_join(cand, view,
                     [("PRODUCTNUMBER", "PRODUCTNUMBER"), ("PRODUCTBRAND", "PRODUCTBRAND"),
                      ("RETAIL_XMFG", "RetailXmfg")])


def new_parts(feed: DataFrame, brands: DataFrame, parts: DataFrame,
              one_name_per_part: bool = False) -> DataFrame:
    """The unregistered parts, numbered per key.

    RN partitions by all four columns of a distinct set, so it is always 1 and
    never filtered; the registry update does without it.
    """
    return partition_row_number(unregistered_parts(feed, brands, parts, one_name_per_part),
                                ["RETAIL_XMFG", "PRODUCTBRAND", "PRODUCTNUMBER", "PRODUCTNAME"],
                                ["PRODUCTNAME"], "RN")


def part_registry_update(feed: DataFrame, brands: DataFrame, parts: DataFrame,
                         one_name_per_part: bool = False) -> DataFrame:
    """Registry + new parts under their (possibly new) brand, with a clean number."""
    fresh = unregistered_parts(feed, brands, parts, one_name_per_part)
    b = brands.select("BrandID", F.col("RetailXmfg").alias("__x"), F.col("PRODUCTBRAND").alias("__b"))
    added = fresh.join(b, (fresh["RETAIL_XMFG"] == b["__x"]) & (fresh["PRODUCTBRAND"] == b["__b"])) \
                 .select("BrandID", "PRODUCTNUMBER", F.col("PRODUCTNAME").alias("PartName"),
                         F.trim(text.clean_part_number(F.col("PRODUCTNUMBER")))
                         .alias("CLEANPRODUCTNUMBER"))
    return union_into(parts.select(*PART_COLUMNS), added)


# --- M03: enrich the feed --------------------------------------------------------------

def enrich_clean_keys(feed: DataFrame, view: DataFrame) -> DataFrame:
    """Copy clean brand / number from the registry onto matching feed rows.

    The registry is reduced to one row per key first (MIN of each clean value,
    SURVEY Q11), so the UPDATE-with-join cannot pick arbitrarily. Matched rows
    take the registry value even when it is NULL. The join is a
    ``lookup_join``: a product (or the rows with a NULL key) holding a large
    share of the feed is split over several tasks when the registry is too
    big to broadcast.
    """
    v = view.groupBy(F.col("PRODUCTNUMBER").alias("__n"), F.col("PRODUCTBRAND").alias("__b"),
                     F.col("RetailXmfg").alias("__x")).agg(
        F.min("CLEANPRODUCTBRAND").alias("__cb"), F.min("CLEANPRODUCTNUMBER").alias("__cn"))
    j = lookup_join(feed, v, [("PRODUCTNUMBER", "__n"), ("PRODUCTBRAND", "__b"),
                              ("RETAIL_XMFG", "__x")], "left")
    hit = F.col("__x").isNotNull()
    out = [F.when(hit, F.col("__cb")).otherwise(feed["CLEANPRODUCTBRAND"]).alias(c)
           if c == "CLEANPRODUCTBRAND" else
           F.when(hit, F.col("__cn")).otherwise(feed["CLEANPRODUCTNUMBER"]).alias(c)
           if c == "CLEANPRODUCTNUMBER" else feed[c] for c in feed.columns]
    return j.select(*out)


# --- X6: latest shop day -------------------------------------------------------------

def latest_shop_day(feed: DataFrame) -> DataFrame:
    """CONVERT(DATE, MAX(DATE_CREATED)) per key over priced rows (NULL keys included)."""
    return (_priced(feed).groupBy(*_BY_NUMBER).agg(F.to_date(F.max("DATE_CREATED")).alias("LastShop"))
                         .select(*KEYS, "LastShop"))


def latest_day_rows(feed: DataFrame) -> DataFrame:
    """Priced rows on their key's latest shop day.

    The latest day per key is a small aggregate, joined back on (key, day)
    with ``lookup_join``, so a key with a large share of the rows is split
    over several tasks when the aggregate is too big to broadcast.
    """
    last = latest_shop_day(feed).filter(
        F.col("CLEANPRODUCTBRAND").isNotNull() & F.col("CLEANPRODUCTNUMBER").isNotNull()
        & F.col("RETAIL_XMFG").isNotNull()).select(
        *[F.col(k).alias(f"__l{i}") for i, k in enumerate(KEYS)], "LastShop")
    rows = _priced(feed).withColumn("__day", dates.day_of(F.col("DATE_CREATED")))
    j = lookup_join(rows, last, [(k, f"__l{i}") for i, k in reversed(list(enumerate(KEYS)))]
                    + [("__day", "LastShop")], "inner")
    return j.select(*KEYS, "PRICE", "COREPRICE", "ZIPCODE", "LastShop")


def shop_sums(feed: DataFrame) -> DataFrame:
    """Extremes, sums and counts of the priced rows by key, day and zip code.

    NULL keys cannot join back in the reference and are dropped first (SURVEY Q14).
    """
    keyed = _priced(feed).filter(F.col("RETAIL_XMFG").isNotNull()
                                 & F.col("CLEANPRODUCTBRAND").isNotNull()
                                 & F.col("CLEANPRODUCTNUMBER").isNotNull())
    return price_sums(keyed.withColumn("LastShop", dates.day_of(F.col("DATE_CREATED"))),
                      _BY_NUMBER + ["LastShop"])


def newest_stats(sums: DataFrame) -> DataFrame:
    """Statistics of each key's latest day from its sums, in one shuffle by key."""
    newest = F.max("LastShop").over(Window.partitionBy(*_BY_NUMBER))
    last = sums.withColumn("__newest", newest).filter(F.col("LastShop") == F.col("__newest"))
    stats = stats_of_sums(last, _BY_NUMBER + ["LastShop"])
    return stats.select(*KEYS, *[c for c in stats.columns if c not in KEYS])


def last_shop_stats(feed: DataFrame) -> DataFrame:
    """A06 + A07: statistics of each key's latest shop day, in one pass.

    Sums by (key, day, zip code) come first; the latest day is then picked with
    a window over them and its sums are added up where they are, so the feed is
    scanned once, never self-joined, and what it becomes is shuffled twice.
    """
    return newest_stats(shop_sums(feed))


def last_shop_summary(feed: DataFrame, view: DataFrame) -> DataFrame:
    """Latest-day statistics with the registry's name and alt code."""
    return named_stats(last_shop_stats(feed), view)


def named_stats(stats: DataFrame, view: DataFrame) -> DataFrame:
    """Latest-day statistics joined to the registry (A07's outer query)."""
    v = view.select(F.col("RetailXmfg").alias("__x"), F.col("CLEANPRODUCTBRAND").alias("__cb"),
                    F.col("CLEANPRODUCTNUMBER").alias("__cn"), "PartName", "AltXmfg")
    j = stats.join(v, (stats["CLEANPRODUCTNUMBER"] == v["__cn"])
                   & (stats["CLEANPRODUCTBRAND"] == v["__cb"]) & (stats["RETAIL_XMFG"] == v["__x"]))
    return j.select(F.col("__x").alias("RetailXmfg"), F.col("__cb").alias("CLEANPRODUCTBRAND"),
                    F.col("__cn").alias("CLEANPRODUCTNUMBER"), "PartName", "MinPrice", "MaxPrice",
                    "AvgPrice", "AvgCore", "ShopCnt", "LastShop", "AltXmfg")


# --- X7: own-brand part numbers per base part ------------------------------------------

def own_brand_parts(price_new: DataFrame, sheets: DataFrame, xref: DataFrame) -> DataFrame:
    """Current (rank 1) own-brand sheet parts mapped to base parts, distinct."""
    s = (sheets.filter(F.col("XMfg").isin(*OWN_BRANDS) & (F.col("SheetRank") == 1))
               .select("psID", F.col("XMfg").alias("__sx")))
    x = xref.select(F.col("XMfg").alias("__xx"), "CompPart", "FS_Part")
    j = price_new.join(s, "psID").join(
        x, (F.col("XMfgPart") == x["CompPart"]) & (F.col("__sx") == x["__xx"]))
    return j.select(F.col("__sx").alias("XMfg"), F.col("FS_Part").alias("BasePart"),
                    F.col("XMfgPart").alias("BrandPart")).distinct()


def ranked_base_parts(ranks: DataFrame) -> DataFrame:
    """Base parts whose class starts with 2, 3 or 4."""
    lfc = F.col("LFC")
    cond = lfc.startswith(LFC_PREFIXES[0])
    for p in LFC_PREFIXES[1:]:
        cond = cond | lfc.startswith(p)
    return ranks.filter(cond)


def base_parts_with_brands(ranks: DataFrame, own: DataFrame) -> DataFrame:
    """Base parts LEFT JOIN own-brand parts."""
    r = ranked_base_parts(ranks).select("BasePart")
    return r.join(own, "BasePart", "left").select("BasePart", "XMfg", "BrandPart")


def brand_part_map(price_new: DataFrame, sheets: DataFrame, xref: DataFrame,
                   ranks: DataFrame) -> DataFrame:
    """One row per base part with its ACI, PRO and Hayden part numbers."""
    c1 = base_parts_with_brands(ranks, own_brand_parts(price_new, sheets, xref))
    return c1.groupBy("BasePart").agg(
        *[conditional_max("BrandPart", "XMfg", code).alias(name) for code, name in OWN_BRANDS.items()])


# --- X8: comparison --------------------------------------------------------------------

COMPARISON_COLUMNS = ("BasePart", "ACI", "ProSource", "Hayden", "RetailXmfg", "ALTXMFG", "MfgPart",
                      "MfgBrand", "MfgDescription", "MinPrice", "MaxPrice", "AvgPrice", "AvgCore",
                      "ShopCnt", "LastShop", "D_I")


def retail_price_comparison(last_shop: DataFrame, xref: DataFrame, brand_map: DataFrame) -> DataFrame:
    """Latest-day retail prices per own base part, with own-brand numbers."""
    x = xref.select(F.col("XMfg").alias("__xx"), "CompClean", "FS_Part", "D_I")
    j = (last_shop.join(x, (last_shop["CLEANPRODUCTNUMBER"] == x["CompClean"])
                        & (last_shop["AltXmfg"] == x["__xx"]))
                  .join(brand_map, F.col("FS_Part") == brand_map["BasePart"]))
    return j.select(
        F.col("FS_Part").alias("BasePart"), "ACI", F.col("PRO").alias("ProSource"), "Hayden",
        "RetailXmfg", F.col("AltXmfg").alias("ALTXMFG"), F.col("CLEANPRODUCTNUMBER").alias("MfgPart"),
        F.col("CLEANPRODUCTBRAND").alias("MfgBrand"), F.col("PartName").alias("MfgDescription"),
        "MinPrice", "MaxPrice", "AvgPrice", "AvgCore", "ShopCnt", "LastShop", "D_I").distinct()


# --- the whole procedure ----------------------------------------------------------------

def retail_state(feed: DataFrame, brands: DataFrame, parts: DataFrame, publish=None):
    """Registers brands, then parts (seeing the new brands), then enriches the feed.

    ``publish`` (DataFrame -> DataFrame) stores each new registry version and
    returns it read back, as the reference writes its tables between
    statements; later steps then read the stored version, not the lineage.
    """
    keep = publish or (lambda df: df)
    brands2 = keep(brand_registry_update(feed, brands))
    parts2 = keep(part_registry_update(feed, brands2, parts))
    view = parts_view(brands2, parts2)
    return brands2, parts2, view, enrich_clean_keys(feed, view)
