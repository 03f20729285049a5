"""DuckDB oracle SQL for the competitor refresh (X9, X13), the pivots (X10,
X11, J19) and the OE export (X12), written independently of the Spark plan."""

from __future__ import annotations

COMP_FIXTURES = ("comp_feed", "line_map", "comp_sheet", "comp_xref")
EXPORT_FIXTURES = ("oe_list",)

# The pivot column lists (same order as the reference).
COMPETITORS = ("DOR", "VDO", "GAT", "GIL", "GPD", "MEI", "SNT", "SPI", "TAP", "UAC", "USM")
RETAILERS = ("AZR", "ADV", "ORY", "NAP", "PBR", "PAG", "ROC", "SMR", "AMZ")


def _clean(c: str) -> str:
    return f"translate({c}, ' -\\/.', '')"


_COMP_IN = ", ".join(f"'{c}'" for c in COMPETITORS)

COMP_CTES = [
    # feed rows of lines that map to a competitor code
    """mapped AS (
    SELECT n.*, lm.Xmfg FROM comp_feed n JOIN line_map lm ON lm.mfrline = n.MFRLINE
    WHERE lm.Xmfg IS NOT NULL)""",
    # Both marks; the gate is open only when the feed is strictly newer
    """marks AS (
    SELECT max(ts) FILTER (WHERE src = 1) AS new_mark, max(ts) FILTER (WHERE src = 2) AS old_mark
    FROM (SELECT Date_Created AS ts, 1 AS src FROM mapped
          UNION ALL SELECT PS_Date_Created, 2 FROM comp_sheet) u)""",
    # rows newer than the sheet's mark, with the sheet id and the parsed sheet date
    """c_batch AS (
    SELECT n.MFRLINE, n.MFRNAME,
           (year(n.Date_Created) * 10000 + month(n.Date_Created) * 100
            + day(n.Date_Created))::INTEGER AS new_psID,
           make_date(split_part(n.PSDATE, '/', 3)::INTEGER, split_part(n.PSDATE, '/', 1)::INTEGER,
                     split_part(n.PSDATE, '/', 2)::INTEGER) AS PSDATE,
           n.PARTNO, n.DESCRIP, n.POPCODE, n.UOM1, n.WD1, n.JOBBER1, n.Xmfg AS XMfg,
           n.Date_Created AS CreatDate
    FROM mapped n, marks k
    WHERE k.new_mark > k.old_mark AND n.Date_Created > k.old_mark)""",
    # Batch rows with the matched sheet columns (NULL when new)
    f"""staging_tb AS (
    SELECT b.*, s.XMfg AS XMfg_2, s.XMfgPartClean AS Flag, s.XMfgUOM, s.XMfgPOP, s.PriceWD,
           s.AcquisitionType, s.PriceJobber, s.PriceList, s.PriceRetail, s.psID AS old_psID,
           s.CoreCharge, s.DateEffective, s.XMfgPartType, s.XMfgPartCategory, s.XREFGroup
    FROM c_batch b LEFT JOIN comp_sheet s
      ON s.XMfg = b.XMfg AND s.XMfgPartClean = {_clean('b.PARTNO')})""",
    # one batch row per key: newest stamp, then highest price, then the other fields
    f"""best AS (
    SELECT * EXCLUDE (pick) FROM (
        SELECT b.*, {_clean('b.PARTNO')} AS clean,
               row_number() OVER w AS pick
        FROM c_batch b
        WINDOW w AS (PARTITION BY b.XMfg, {_clean('b.PARTNO')}
                     ORDER BY b.CreatDate DESC NULLS LAST, b.WD1 DESC NULLS LAST,
                              b.JOBBER1 DESC NULLS LAST, b.PARTNO DESC NULLS LAST,
                              b.DESCRIP DESC NULLS LAST, b.POPCODE DESC NULLS LAST,
                              b.UOM1 DESC NULLS LAST, b.PSDATE DESC NULLS LAST)) r
    WHERE pick = 1)""",
    """sheet_updated AS (
    SELECT s.* REPLACE (w.new_psID AS psID, w.DESCRIP AS XMfgPartType, w.POPCODE AS XMfgPOP,
                        w.UOM1 AS XMfgUOM, w.PSDATE AS DateEffective,
                        w.WD1::DOUBLE AS PriceAcquistion, w.JOBBER1::DOUBLE AS PriceJobber,
                        w.WD1::DOUBLE AS PriceWD, w.CreatDate AS PS_Date_Created)
    FROM comp_sheet s JOIN best w ON w.XMfg = s.XMfg AND w.clean = s.XMfgPartClean)""",
    """sheet_kept AS (
    SELECT s.* FROM comp_sheet s
    WHERE NOT EXISTS (SELECT 1 FROM best w WHERE w.XMfg = s.XMfg AND w.clean = s.XMfgPartClean))""",
    f"""sheet_inserted AS (
    SELECT new_psID AS psID, NULL::VARCHAR AS XREFGroup, NULL::VARCHAR AS XMfgPartCategory,
           DESCRIP AS XMfgPartType, XMfg, NULL::VARCHAR AS XMfgSKU, PARTNO AS XMfgPart,
           {_clean('PARTNO')} AS XMfgPartClean, NULL::VARCHAR AS XMfgPartSuper,
           NULL::VARCHAR AS XMfgPartSuperClean, POPCODE AS XMfgPOP, UOM1 AS XMfgUOM,
           PSDATE AS DateEffective, NULL::DOUBLE AS CoreCharge, 'WD Gross' AS AcquisitionType,
           WD1::DOUBLE AS PriceAcquistion, JOBBER1::DOUBLE AS PriceJobber, WD1::DOUBLE AS PriceWD,
           NULL::DOUBLE AS PriceList, NULL::DOUBLE AS PriceRetail, NULL::DOUBLE AS PriceProgramStart,
           CreatDate AS PS_Date_Created
    FROM staging_tb WHERE Flag IS NULL)""",
    """sheet2 AS (
    SELECT * FROM sheet_kept UNION ALL BY NAME SELECT * FROM sheet_updated
    UNION ALL BY NAME SELECT * FROM sheet_inserted)""",
    # Mean WD price per own part and competitor (stored prices have four decimals)
    f"""comp_c AS (
    SELECT x.FS_Part, s.XMfg AS CompXMfg,
           if(count(s.PriceWD) = 0, NULL,
              sum(s.PriceWD::DECIMAL(18,6))::DOUBLE / count(s.PriceWD)) AS WDPrice
    FROM sheet2 s JOIN comp_xref x ON x.XMfg = s.XMfg AND x.CompPart = s.XMfgPart
    WHERE s.XMfg IN ({_COMP_IN}) AND s.PriceWD <> 0 AND NOT starts_with(x.FS_Part, 'N')
    GROUP BY x.FS_Part, s.XMfg)""",
]

COMP_PIVOT = ("comp_pivot AS (SELECT FS_Part, "
              + ", ".join(f"avg(WDPrice) FILTER (WHERE CompXMfg = '{c}') AS {c}" for c in COMPETITORS)
              + " FROM comp_c GROUP BY FS_Part)")


RETAIL_PIVOT = ("retail_pivot AS (SELECT BasePart, "
                + ", ".join(f"avg(AvgPrice) FILTER (WHERE RETAIL_XMFG = '{r}') AS {r}" for r in RETAILERS)
                + " FROM (SELECT BasePart, RetailXmfg AS RETAIL_XMFG, AvgPrice FROM comparison "
                  "WHERE NOT starts_with(BasePart, 'N')) c GROUP BY BasePart)")

EXPORT_CTES = [
    # Global numbering by (Manufacturer, PartNumber), NULLs first
    """oe_body AS (
    SELECT Manufacturer, PartNumber,
           row_number() OVER (ORDER BY Manufacturer NULLS FIRST, PartNumber NULLS FIRST)::BIGINT AS id
    FROM oe_list)""",
    # A08
    """oe_mm AS (SELECT Manufacturer, min(id) AS MinID, max(id) AS MaxID FROM oe_body
    GROUP BY Manufacturer)""",
    # open tag one before the first id, close tag one after the last; a NULL
    # manufacturer matches nothing, so its tags carry NULL text and id
    """oe_tags AS (
    SELECT Manufacturer, concat_ws('', '<', Manufacturer, '>') AS PartNumber, MinID - 1 AS id
    FROM oe_mm WHERE Manufacturer IS NOT NULL
    UNION ALL
    SELECT Manufacturer, concat_ws('', '</', Manufacturer, '>'), MaxID + 1
    FROM oe_mm WHERE Manufacturer IS NOT NULL
    UNION ALL
    SELECT NULL, NULL, NULL FROM oe_mm WHERE Manufacturer IS NULL
    UNION ALL
    SELECT NULL, NULL, NULL FROM oe_mm WHERE Manufacturer IS NULL)""",
    """oe_export AS (
    SELECT DISTINCT Manufacturer, PartNumber, id
    FROM (SELECT * FROM oe_body UNION ALL SELECT * FROM oe_tags) u)""",
]
