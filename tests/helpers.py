"""Small hand-built inputs for the pricing routines."""

from __future__ import annotations

from decimal import Decimal

from quillprice.operators.routines import PricingInputs
from quillprice.sources.fixtures import RULES_CALC_SCHEMA, RULES_LIST_SCHEMA
from quillprice.sources.pricesheet import PRICE_SHEET_SCHEMA

LOAD_TS = "2017-09-04 17:53:00"


def d(v):
    return None if v is None else Decimal(str(v))


def sheet_rows(spark, rows):
    """rows: (xmfg, part, gross, pop, change, core)."""
    data = [(x, p, d(g), pop, ch, d(core), "PS1", None) for x, p, g, pop, ch, core in rows]
    return spark.createDataFrame(data, PRICE_SHEET_SCHEMA)


def calc_rows(spark, rows):
    """rows: (Brand, xmfg, BASE_WD, PriceGroup, pct, pog, flag, note[, jde, adj])."""
    data = []
    for r in rows:
        b, x, base, g, pct, pog, flag, note = r[:8]
        jde, adj = (r[8], r[9]) if len(r) > 8 else ("Y", "Y")
        data.append((b, x, base, "WD", g, d(pct), d(pog), flag, note, "Y", jde, adj))
    return spark.createDataFrame(data, RULES_CALC_SCHEMA)


def inputs(spark, load, calc, ranks=(), pdm0=(), setup=(), price_file=(), xref=(), pack=()):
    lst = spark.createDataFrame([("E", d("1.3500"), d("1.5000"), d("0.8000"))], RULES_LIST_SCHEMA)
    s = spark.createDataFrame
    return PricingInputs(
        load=load, rules_list=lst, rules_calc=calc,
        ranks=s(list(ranks), "BasePart string, Group1 string, LFC string"),
        pdm0=s(list(pdm0), "BasePart string, PDM1 string"),
        pdm1=s([(p,) for _, p in pdm0], "PDM1 string").distinct(),
        setup=s(list(setup), "PDM1 string, SRP3 string"),
        price_file=s([(i, p, 0, 0, 0, "U", 0, g) for i, p, g in price_file],
                     "BPLITM string, BPUPRC bigint, BPEFTJ int, BPEXDJ int, BPACRD int, "
                     "BPUSER string, BPUPMJ int, BPICID bigint"),
        price_group=s([(0, "HYFILTR"), (4, "OTHER")], "KIICID bigint, KICPGP string"),
        xref=s(list(xref), "XMfg string, CompPart string, CompClean string, FS_Part string, "
                           "D_I string"),
        pack=s(list(pack), "Basepart string, Info string, Type string"),
        load_ts=LOAD_TS)

