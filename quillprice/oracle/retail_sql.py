"""DuckDB oracle SQL for the retail survey (X4-X8 and their parts).

Written independently of the Spark plan: anti joins as NOT EXISTS, the
latest shop day as a window over the priced rows, own-brand columns as
FILTER aggregates. Step order follows the procedure: brands, parts (which
see the new brands), feed enrichment, latest-day statistics, comparison.
"""

from __future__ import annotations

RETAIL_FIXTURES = ("retail_import", "brand_registry", "part_registry", "price_new", "price_sheets",
                   "xref", "base_ranks")

_KEYS = "RETAIL_XMFG, CLEANPRODUCTBRAND, CLEANPRODUCTNUMBER"

CTES = [
    # Priced rows with a brand whose (retailer, brand) is unknown
    """new_brands AS (
    SELECT DISTINCT r.RETAIL_XMFG AS RetailXmfg, r.PRODUCTBRAND
    FROM retail_import r
    WHERE r.PRICE > 0 AND rtrim(r.PRODUCTBRAND) <> ''
      AND NOT EXISTS (SELECT 1 FROM brand_registry k
                      WHERE k.RetailXmfg = r.RETAIL_XMFG AND k.PRODUCTBRAND = r.PRODUCTBRAND))""",
    # Ids continue after the highest registered one, in key order
    """new_brand_ids AS (
    SELECT n.RetailXmfg, n.PRODUCTBRAND,
           hi.top + CAST(row_number() OVER (ORDER BY n.RetailXmfg NULLS FIRST,
                                            n.PRODUCTBRAND NULLS FIRST) AS BIGINT) AS BrandID
    FROM new_brands n CROSS JOIN (SELECT coalesce(max(BrandID), 0) AS top FROM brand_registry) hi)""",
    """brands2 AS (
    SELECT BrandID, RetailXmfg, PRODUCTBRAND, CLEANPRODUCTBRAND, AltXmfg FROM brand_registry
    UNION ALL
    SELECT BrandID, RetailXmfg, PRODUCTBRAND, NULL::VARCHAR, NULL::VARCHAR FROM new_brand_ids)""",
    """view1 AS (
    SELECT g.RetailXmfg, g.PRODUCTBRAND, q.PRODUCTNUMBER, g.CLEANPRODUCTBRAND,
           q.CLEANPRODUCTNUMBER, q.PartName, g.AltXmfg
    FROM part_registry q JOIN brands2 g USING (BrandID))""",
    # X5 / J09 / W02
    """c_parts AS (
    SELECT DISTINCT RETAIL_XMFG, PRODUCTBRAND, PRODUCTNUMBER, PRODUCTNAME
    FROM retail_import
    WHERE PRICE > 0 AND rtrim(PRODUCTNUMBER) <> '' AND rtrim(PRODUCTBRAND) <> '')""",
    """c1_parts AS (
    SELECT c.RETAIL_XMFG, c.PRODUCTBRAND, c.PRODUCTNUMBER, c.PRODUCTNAME,
           CAST(row_number() OVER (PARTITION BY c.RETAIL_XMFG, c.PRODUCTBRAND, c.PRODUCTNUMBER,
                                                c.PRODUCTNAME ORDER BY c.PRODUCTNAME) AS BIGINT) AS RN
    FROM c_parts c
    WHERE NOT EXISTS (SELECT 1 FROM view1 v WHERE v.RetailXmfg = c.RETAIL_XMFG
                      AND v.PRODUCTBRAND = c.PRODUCTBRAND AND v.PRODUCTNUMBER = c.PRODUCTNUMBER))""",
    """new_parts AS (
    SELECT g.BrandID, c.PRODUCTNUMBER, c.PRODUCTNAME AS PartName,
           trim(translate(c.PRODUCTNUMBER, ' -\\/.', '')) AS CLEANPRODUCTNUMBER
    FROM c1_parts c JOIN brands2 g
      ON g.RetailXmfg = c.RETAIL_XMFG AND g.PRODUCTBRAND = c.PRODUCTBRAND)""",
    """parts2 AS (
    SELECT BrandID, PRODUCTNUMBER, PartName, CLEANPRODUCTNUMBER FROM part_registry
    UNION ALL SELECT BrandID, PRODUCTNUMBER, PartName, CLEANPRODUCTNUMBER FROM new_parts)""",
    """view2 AS (
    SELECT g.RetailXmfg, g.PRODUCTBRAND, q.PRODUCTNUMBER, g.CLEANPRODUCTBRAND,
           q.CLEANPRODUCTNUMBER, q.PartName, g.AltXmfg
    FROM parts2 q JOIN brands2 g USING (BrandID))""",
    # Matched feed rows take the registry's (lowest) clean values
    """feed2 AS (
    SELECT r.RETAIL_XMFG, r.PRODUCTBRAND, r.PRODUCTNUMBER, r.PRODUCTNAME, r.PRICE, r.COREPRICE,
           r.ZIPCODE, r.DATE_CREATED,
           if(m.matched, m.cb, r.CLEANPRODUCTBRAND) AS CLEANPRODUCTBRAND,
           if(m.matched, m.cn, r.CLEANPRODUCTNUMBER) AS CLEANPRODUCTNUMBER
    FROM retail_import r
    LEFT JOIN (SELECT RetailXmfg, PRODUCTBRAND, PRODUCTNUMBER, true AS matched,
                      min(CLEANPRODUCTBRAND) AS cb, min(CLEANPRODUCTNUMBER) AS cn
               FROM view2 GROUP BY ALL) m
      ON m.RetailXmfg = r.RETAIL_XMFG AND m.PRODUCTBRAND = r.PRODUCTBRAND
     AND m.PRODUCTNUMBER = r.PRODUCTNUMBER)""",
    # Newest shop day per key (NULL keys form their own groups)
    f"""ls_c AS (
    SELECT {_KEYS}, max(DATE_CREATED)::DATE AS LastShop
    FROM feed2 WHERE PRICE > 0 GROUP BY ALL)""",
    # Priced rows of each key's newest day (keys must be known to match)
    f"""ls_c1 AS (
    SELECT {_KEYS}, PRICE, COREPRICE, ZIPCODE, shop_day AS LastShop
    FROM (SELECT *, DATE_CREATED::DATE AS shop_day,
                 max(DATE_CREATED::DATE) OVER (PARTITION BY {_KEYS}) AS newest
          FROM feed2
          WHERE PRICE > 0 AND RETAIL_XMFG IS NOT NULL AND CLEANPRODUCTBRAND IS NOT NULL
            AND CLEANPRODUCTNUMBER IS NOT NULL) d
    WHERE shop_day = newest)""",
    # A06 / A07
    f"""ls_c2 AS (
    SELECT {_KEYS}, LastShop,
           min(PRICE)::DOUBLE AS MinPrice, max(PRICE)::DOUBLE AS MaxPrice,
           if(count(PRICE) = 0, NULL, sum(PRICE)::DOUBLE / count(PRICE)) AS AvgPrice,
           if(count(COREPRICE) = 0, NULL,
              sum(COREPRICE)::DOUBLE / count(COREPRICE)) AS AvgCore,
           count(DISTINCT ZIPCODE) AS ShopCnt
    FROM ls_c1 GROUP BY ALL)""",
    # X6
    """last_shop AS (
    SELECT v.RetailXmfg, v.CLEANPRODUCTBRAND, v.CLEANPRODUCTNUMBER, v.PartName, s.MinPrice,
           s.MaxPrice, s.AvgPrice, s.AvgCore, s.ShopCnt, s.LastShop, v.AltXmfg
    FROM ls_c2 s JOIN view2 v
      ON v.RetailXmfg = s.RETAIL_XMFG AND v.CLEANPRODUCTBRAND = s.CLEANPRODUCTBRAND
     AND v.CLEANPRODUCTNUMBER = s.CLEANPRODUCTNUMBER)""",
    # J18, J17 (+P15), A12
    """bp_c0 AS (
    SELECT DISTINCT h.XMfg, x.FS_Part AS BasePart, n.XMfgPart AS BrandPart
    FROM price_new n JOIN price_sheets h USING (psID)
    JOIN xref x ON x.CompPart = n.XMfgPart AND x.XMfg = h.XMfg
    WHERE h.SheetRank = 1 AND h.XMfg IN ('ACI', 'PRO', 'HDC'))""",
    """bp_c1 AS (
    SELECT r.BasePart, o.XMfg, o.BrandPart
    FROM base_ranks r LEFT JOIN bp_c0 o ON o.BasePart = r.BasePart
    WHERE substr(r.LFC, 1, 1) IN ('2', '3', '4'))""",
    """bp_c2 AS (
    SELECT BasePart,
           max(BrandPart) FILTER (WHERE XMfg = 'ACI') AS ACI,
           max(BrandPart) FILTER (WHERE XMfg = 'PRO') AS PRO,
           max(BrandPart) FILTER (WHERE XMfg = 'HDC') AS Hayden
    FROM bp_c1 GROUP BY BasePart)""",
    # X8
    """comparison AS (
    SELECT DISTINCT x.FS_Part AS BasePart, b.ACI, b.PRO AS ProSource, b.Hayden, s.RetailXmfg,
           s.AltXmfg AS ALTXMFG, s.CLEANPRODUCTNUMBER AS MfgPart, s.CLEANPRODUCTBRAND AS MfgBrand,
           s.PartName AS MfgDescription, s.MinPrice, s.MaxPrice, s.AvgPrice, s.AvgCore, s.ShopCnt,
           s.LastShop, x.D_I
    FROM last_shop s
    JOIN xref x ON x.CompClean = s.CLEANPRODUCTNUMBER AND x.XMfg = s.AltXmfg
    JOIN bp_c2 b ON b.BasePart = x.FS_Part)""",
]
