"""The nine pricing routines (R1-R9) and the net-price step.

Plan shape, chosen for one scan of the price sheet and one shuffle for all
nine de-duplications:

* the rule table is tiny: each customer rule is tagged with the routines it
  takes part in (a rule can be in two, SURVEY Q17) and exploded there, before
  any join, so the fan-out happens on the small side;
* price sheet x list rules x tagged rules are joined with size-checked
  broadcasts (no shuffle of the sheet);
* routines that need a lookup (ranks, taxonomy, competitor price, pack size)
  branch off and join it; the others need nothing more;
* all branches are unioned and de-duplicated once on the routine id plus the
  reference's GROUP BY columns (superset distinct, SURVEY Q6), so identical
  rows of two different routines both survive (U01).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillprice.functions import dates, pricing, text

ROUTINES = ("R1", "R2", "R3", "R4", "R5", "R6", "R7", "R8", "R9")

# Fixed values from the reference: routine notes, rank groups, taxonomy code,
# competitor brand/price group/manufacturer and the pack lookup type.
NOTE = {"R2": "Ceiling", "R3": "Washer_Pump", "R4": "Heater_Cores", "R5": "Balkamp",
        "R6": "NON A08", "R7": "A08", "R8": "UOM", "R9": "No_Ceiling_UOM"}
RANK_GROUP = {"R3": ("Washer Pump",), "R4": ("Heater Cores",),
              "R5": ("Blower Motor Wheels", "Blower Motors", "Cooling Fan Assemblies",
                     "Cooling Fan Motors", "Engine Coolant Components", "Fans, Spacers And Blades",
                     "Heater Fittings", "Heater Valves", "Oil Coolers", "Window Motor")}
A08 = "A08"
COMPETITOR_BRAND = "625"
COMPETITOR_PRICE_GROUP = "HYFILTR"
COMPETITOR_XMFG = "HDC"
PACK_TYPE = "Standard/MinimumOrderQuantity"

# Staging table layout (temp_price_load): name, Spark type, NOT NULL, max length.
STAGING_COLUMNS = (
    ("Brand", "string", True, 3),
    ("Xmfg", "string", True, 6),
    ("Cust_Part_Number", "string", True, 20),
    ("Price_Type", "string", True, 25),
    ("FS_WD", "double", True, None),
    ("PriceGroup", "string", True, 20),
    ("CalcPrice", "double", False, None),
    ("Percent_of_WD", "double", False, None),
    ("Percent_of_Gross", "double", False, None),
    ("PriceNet", "double", False, None),
    ("LoadDate", "timestamp_ntz", True, None),
    ("PriceList", "double", False, None),
    ("PriceJobber", "double", False, None),
    ("PriceDealer", "double", False, None),
    ("POP", "string", False, 10),
    ("ChangeCode", "string", False, 100),
    ("CorePrice", "double", False, None),
    ("Price_Sheet_Number", "string", False, 15),
    ("Effective_Date", "date", False, None),
)
STAGING_NAMES = [c[0] for c in STAGING_COLUMNS]
# The 17 columns every routine inserts (no Percent_of_Gross / PriceNet).
ROUTINE_NAMES = [c for c in STAGING_NAMES if c not in ("Percent_of_Gross", "PriceNet")]

_CALC = "__calc_dec"        # exact CalcPrice, kept until the net-price step
_LOAD_XMFG = "__load_xmfg"  # the extra GROUP BY key of every routine


@dataclass
class PricingInputs:
    load: DataFrame          # price sheet landing rows
    rules_list: DataFrame    # PopCode -> Jobber, Multiplier, Dealer
    rules_calc: DataFrame    # customer pricing rules
    ranks: DataFrame         # BasePart, Group1, LFC
    pdm0: DataFrame          # BasePart, PDM1
    pdm1: DataFrame          # PDM1
    setup: DataFrame         # PDM1, SRP3
    price_file: DataFrame    # ERP price file
    price_group: DataFrame   # KIICID, KICPGP
    xref: DataFrame          # XMfg, CompPart, FS_Part, ...
    pack: DataFrame          # Basepart, Info, Type
    # One stamp for the run, or {routine: stamp} to reproduce the per-statement
    # NOW() of the reference; None = current local time.
    load_ts: str | dict | None = None
    fix_pack_rounding: bool = False   # SURVEY Q5: round the unit price, then scale by pack
    # SURVEY Q2: compare rule texts (notes, flags, groups, codes) like a
    # case-insensitive, trailing-blank-insensitive server collation
    case_insensitive: bool = False
    # SURVEY Q4: leave competitor prices with a malformed item code to
    # ``rejected_codes``; by default they fail the job
    reject_bad_codes: bool = False

    @classmethod
    def from_fixtures(cls, fx, load_ts: str | None) -> "PricingInputs":
        return cls(load=fx.ps_load, rules_list=fx.rules_list, rules_calc=fx.rules_calc,
                   ranks=fx.base_ranks, pdm0=fx.tax_pdm0, pdm1=fx.tax_pdm1, setup=fx.tax_setup,
                   price_file=fx.price_file, price_group=fx.price_group, xref=fx.xref,
                   pack=fx.pack_lookup, load_ts=load_ts)


# --- rule tagging ---------------------------------------------------------------

def _flag_in(flag: Column, value: int) -> Column:
    return flag.isNull() | (flag == F.lit(value))


def text_eq(c: Column, value: str, case_insensitive: bool = False) -> Column:
    """c = value, binary by default; optionally ignoring case and trailing blanks."""
    if case_insensitive:
        return F.lower(F.rtrim(c)) == F.lit(value.rstrip().lower())
    return c == F.lit(value)


def text_in(c: Column, values, case_insensitive: bool = False) -> Column:
    if case_insensitive:
        return F.lower(F.rtrim(c)).isin(*[v.rstrip().lower() for v in values])
    return c.isin(*values)


def routine_membership(calc: DataFrame, case_insensitive: bool = False) -> Column:
    """Array of routines a customer rule row takes part in (rule-side filters)."""
    pct_ok = F.col("Percent_of_WD").isNotNull()
    flag = F.col("SpecialPriceRoutine")

    def note(r):
        return text_eq(F.col("SpecialPriceRoutine_Note"), NOTE[r], case_insensitive)
    members = {
        "R1": pct_ok & _flag_in(flag, 0),
        "R2": note("R2") & pct_ok,
        "R3": _flag_in(flag, 1) & pct_ok & note("R3"),
        "R4": _flag_in(flag, 1) & pct_ok & note("R4"),
        "R5": _flag_in(flag, 1) & pct_ok & note("R5"),
        "R6": note("R6"),
        "R7": note("R7"),
        "R8": note("R8"),
        "R9": note("R9"),
    }
    return F.array_compact(F.array(*[F.when(cond, F.lit(r)) for r, cond in members.items()]))


def tagged_rules(calc: DataFrame, routines=ROUTINES, case_insensitive: bool = False) -> DataFrame:
    """BrandType = 'Y' rules exploded to one row per (rule, routine)."""
    return (calc.filter(text_eq(F.col("BrandType"), "Y", case_insensitive))
                .withColumn("routine", F.explode(routine_membership(calc, case_insensitive)))
                .filter(F.col("routine").isin(*routines)))


def landing_trim(load: DataFrame) -> DataFrame:
    """UPDATE landing SET POP_Code = LTRIM(RTRIM(POP_Code))."""
    return load.withColumn("POP_Code", text.sql_trim(F.col("POP_Code")))


def rules_join(inp: PricingInputs) -> DataFrame:
    """J01 as written: price sheet x list rules x customer rules (no routine tagging)."""
    load = landing_trim(inp.load)
    lst = inp.rules_list
    calc = inp.rules_calc.withColumnRenamed("xmfg", "CalcXmfg")
    return (load.join(lst, load["POP_Code"] == lst["PopCode"])
                .join(calc, load["xmfg"] == calc["BASE_WD"]))


def priced_base(inp: PricingInputs, routines=ROUTINES) -> DataFrame:
    """price sheet x list rules x tagged customer rules."""
    load = landing_trim(inp.load)
    lst = inp.rules_list
    calc = tagged_rules(inp.rules_calc, routines, inp.case_insensitive)
    return (load.join(lst, load["POP_Code"] == lst["PopCode"])
                .join(calc, load["xmfg"] == calc["BASE_WD"])
                .select(load["xmfg"].alias(_LOAD_XMFG), load["Cust_Part_Number"],
                        load["Gross_Price"], load["POP_Code"], load["Change_Code"],
                        load["Core_Price"], load["Price_Sheet_Number"], load["Effective_Date"],
                        lst["Jobber"], lst["Multiplier"], lst["Dealer"],
                        calc["Brand"], calc["xmfg"].alias("Xmfg"), calc["Price_Type"],
                        calc["PriceGroup"], calc["Percent_of_WD"], calc["routine"]))


# --- lookups ----------------------------------------------------------------------

def taxonomy_dim(inp: PricingInputs) -> DataFrame:
    """(PDM0 x PDM1 x PDM1 setup) -> BasePart, SRP3 (J03, built before joining the sheet).

    PDM1 has few distinct values and the category tables one row for each, so
    the planner broadcasts them and the part-level PDM0 stays where it is.
    """
    return (inp.pdm0.join(inp.pdm1, "PDM1").join(inp.setup, "PDM1")
                    .select("BasePart", "SRP3"))


def competitor_codes(inp: PricingInputs) -> DataFrame:
    """Price file rows of brand 625 in the competitor price group."""
    groups = inp.price_group.filter(F.col("KICPGP") == COMPETITOR_PRICE_GROUP)
    brand, _, _ = text.item_code_parts(F.col("BPLITM"))
    return (inp.price_file.join(groups, F.col("BPICID") == F.col("KIICID"))
                          .filter(brand == COMPETITOR_BRAND))


def rejected_codes(inp: PricingInputs) -> DataFrame:
    """The reject table: competitor price rows whose item code is malformed."""
    _, _, valid = text.item_code_parts(F.col("BPLITM"))
    return competitor_codes(inp).filter(~F.coalesce(valid, F.lit(False))).select(*inp.price_file.columns)


def competitor_price(inp: PricingInputs, keep_unmatched: bool = False) -> DataFrame:
    """Competitor (brand 625, group HYFILTR) prices keyed by own part.

    The reference left-joins the cross-reference and then drops NULL prices
    and NULL part matches in WHERE (SURVEY Q13), so the routine uses inner
    joins; ``keep_unmatched`` gives the derived table as written (P04, J05).
    A malformed item code fails the job, as it fails the reference's statement;
    with ``inp.reject_bad_codes`` such rows are left to ``rejected_codes``.
    """
    brand, base, valid = text.item_code_parts(F.col("BPLITM"))
    codes = competitor_codes(inp)
    if inp.reject_bad_codes:
        codes = codes.filter(valid)
    else:
        # It names the group, so that it is evaluated after the join to the groups.
        base = F.when(valid, base).when(F.col("KICPGP") == COMPETITOR_PRICE_GROUP, F.raise_error(
            F.concat(F.lit("malformed item code: "), F.col("BPLITM"))).cast("string"))
    prices = codes.select(base.alias("BasePart"),
                          pricing.scaled_int_price(F.col("BPUPRC")).alias("HPrice"))
    xref = (inp.xref.filter(F.col("XMfg") == COMPETITOR_XMFG)
                    .select("CompPart", "FS_Part").distinct())
    how = "left" if keep_unmatched else "inner"
    return (prices.join(xref, prices["BasePart"] == xref["CompPart"], how)
                  .select("FS_Part", "HPrice"))


def pack_dim(inp: PricingInputs) -> DataFrame:
    """Distinct (Basepart, Info) of minimum-order-quantity rows."""
    return (inp.pack.filter(F.col("Type") == PACK_TYPE)
                    .select("Basepart", "Info").distinct())


# --- price expressions ------------------------------------------------------------

def _list_prices(price: Column) -> list[Column]:
    """ROUND(price * Jobber * Multiplier, 2), ROUND(price * Jobber, 2), ROUND(... * Dealer, 2)."""
    j, m, d = F.col("Jobber"), F.col("Multiplier"), F.col("Dealer")
    return [pricing.round_money(price * j * m).cast("double").alias("PriceList"),
            pricing.round_money(price * j).cast("double").alias("PriceJobber"),
            pricing.round_money(price * j * d).cast("double").alias("PriceDealer")]


def _stamp(load_ts) -> Column:
    if not isinstance(load_ts, dict):
        return dates.load_stamp(load_ts)
    expr = None
    for routine, ts in load_ts.items():
        cond = F.col("routine") == routine
        expr = F.when(cond, dates.load_stamp(ts)) if expr is None else expr.when(
            cond, dates.load_stamp(ts))
    return expr.otherwise(dates.load_stamp(None)) if expr is not None else dates.load_stamp(None)


def _routine_select(df: DataFrame, calc: Column, fs_wd: Column, list_base: Column,
                    load_ts) -> DataFrame:
    return df.select(
        "routine", _LOAD_XMFG, "Brand", "Xmfg", "Cust_Part_Number", "Price_Type",
        fs_wd.cast("double").alias("FS_WD"), "PriceGroup",
        calc.cast("decimal(28,8)").alias(_CALC),
        F.col("Percent_of_WD").cast("double").alias("Percent_of_WD"),
        _stamp(load_ts).alias("LoadDate"),
        *_list_prices(list_base),
        F.col("POP_Code").alias("POP"), F.col("Change_Code").alias("ChangeCode"),
        F.col("Core_Price").cast("double").alias("CorePrice"),
        "Price_Sheet_Number", "Effective_Date")


def _is(*names: str) -> Column:
    return F.col("routine").isin(*names)


def routine_rows(inp: PricingInputs, routines=ROUTINES) -> DataFrame:
    """All routine rows, de-duplicated per routine, with a ``routine`` column."""
    base = priced_base(inp, routines)
    gross = F.col("Gross_Price")
    u = pricing.pct_of(F.col("Percent_of_WD"), gross)
    branches = []

    plain = base.filter(_is("R1", "R2"))
    branches.append(_routine_select(
        plain, F.when(_is("R1"), pricing.round_money(u)).otherwise(pricing.ceiling_price(u)),
        gross, gross, inp.load_ts))

    if set(routines) & {"R3", "R4", "R5"}:
        ranked = base.filter(_is("R3", "R4", "R5")).join(
            inp.ranks.select("BasePart", "Group1"), F.col("Cust_Part_Number") == F.col("BasePart"))
        in_group = reduce(lambda a, b: a | b, [
            _is(r) & text_in(F.col("Group1"), groups, inp.case_insensitive)
            for r, groups in RANK_GROUP.items()])
        branches.append(_routine_select(ranked.filter(in_group), pricing.round_money(u),
                                        gross, gross, inp.load_ts))

    if set(routines) & {"R6", "R7"}:
        taxed = base.filter(_is("R6", "R7")).join(
            taxonomy_dim(inp), F.col("Cust_Part_Number") == F.col("BasePart"))
        srp3_a08 = text_eq(F.col("SRP3"), A08, inp.case_insensitive)
        non_a08 = taxed.filter(_is("R6") & ~srp3_a08)
        branches.append(_routine_select(non_a08, pricing.ceiling_price(u), gross, gross,
                                        inp.load_ts))
        if "R7" in routines:
            a08 = (taxed.filter(_is("R7") & srp3_a08
                                & F.col("Percent_of_WD").isNotNull())
                        .join(competitor_price(inp), F.col("Cust_Part_Number") == F.col("FS_Part")))
            h = F.col("HPrice")
            branches.append(_routine_select(
                a08, pricing.ceiling_price(pricing.pct_of(F.col("Percent_of_WD"), h)),
                gross, h, inp.load_ts))

    if set(routines) & {"R8", "R9"}:
        packed = base.filter(_is("R8", "R9")).join(
            pack_dim(inp), F.col("Cust_Part_Number") == F.col("Basepart"))
        pack = pricing.to_numeric(F.col("Info"), 5, 2)
        fs_wd = gross.cast("double") * F.col("Info").cast("double")
        low = (pricing.round_money(u) * pack if inp.fix_pack_rounding
               else pricing.round_dynamic_scale(u, F.lit(2) * pack))
        r8 = F.when(pricing.round_money(u) > pricing.dec(pricing.CEILING_THRESHOLD),
                    pricing.ceil_to_nickel(u, pack)).otherwise(low)
        r9 = pricing.round_money(u * pack)
        branches.append(_routine_select(packed, F.when(_is("R8"), r8).otherwise(r9),
                                        fs_wd, gross, inp.load_ts))

    union = reduce(DataFrame.unionByName, branches).filter(F.col("routine").isin(*routines))
    # One shuffle de-duplicates every routine: the routine id is part of the key.
    return union.distinct()


def routine_output(inp: PricingInputs, routine: str) -> DataFrame:
    """The rows one routine inserts into staging (17 columns)."""
    rows = routine_rows(inp, (routine,))
    return rows.withColumn("CalcPrice", F.col(_CALC).cast("double")).select(*ROUTINE_NAMES)


def net_price_rules(calc: DataFrame) -> DataFrame:
    """One Percent_of_Gross per (xmfg, Brand, PriceGroup): the highest."""
    return (calc.filter(F.col("Percent_of_Gross").isNotNull())
                .groupBy("xmfg", "Brand", "PriceGroup")
                .agg(F.max("Percent_of_Gross").alias("__pog")))


def apply_net_price(rows: DataFrame, calc: DataFrame) -> DataFrame:
    """PriceNet = ROUND(CAST(CalcPrice AS (7,2)) * CAST(pog AS (7,2)), 2).

    The percent is cast to two decimals as in the reference (SURVEY Q12).
    Rows without a rule keep NULL net price and percent; only rows with one are
    cast, so a price beyond numeric(7,2) is no error where no rule needs it.
    """
    rules = net_price_rules(calc)
    joined = rows.join(rules, (rows["Xmfg"] == rules["xmfg"]) & (rows["Brand"] == rules["Brand"])
                       & (rows["PriceGroup"] == rules["PriceGroup"]), "left")
    net = F.when(rules["__pog"].isNotNull(), pricing.round_money(
        pricing.to_numeric(rows[_CALC], 7, 2) * pricing.to_numeric(rules["__pog"], 7, 2)))
    return joined.select(
        *[rows[c] for c in rows.columns if c not in ("Percent_of_Gross", "PriceNet")],
        rules["__pog"].cast("double").alias("Percent_of_Gross"),
        net.cast("double").alias("PriceNet"))


def market_price_staging(inp: PricingInputs) -> DataFrame:
    """Nine routines + net price -> the 19-column staging table."""
    rows = apply_net_price(routine_rows(inp), inp.rules_calc)
    return rows.withColumn("CalcPrice", F.col(_CALC).cast("double")).select(*STAGING_NAMES)
