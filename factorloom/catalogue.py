"""Column catalogues, quality rules and table specifications, all plain data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = "decimal(20,4)"


@dataclass(frozen=True)
class Indicator:
    """One output column: where it comes from, its type and its row rules."""

    source: str
    alias: str
    type: str = MONEY
    required: bool = False
    non_negative: bool = False


def _parse(text: str, default_type: str = MONEY) -> tuple[Indicator, ...]:
    out = []
    for line in text.strip().splitlines():
        source, alias, *flags = line.split()
        kind = next((f for f in flags if f in ("double", "string", "boolean")), default_type)
        out.append(Indicator(source, alias, kind, "required" in flags, "nonneg" in flags))
    return tuple(out)


# Report indicator ids, their column names and flags.
INCOME_STATEMENT = _parse("""
1    gross_revenue       nonneg
2    revenue_deduction
3    net_revenue         required
4    cogs                required
5    gross_profit        required
6    financial_income
7    financial_expense
701  interest_expense
8    affiliate_profit
9    selling_expense
10   admin_expense
11   operating_profit    required
12   other_income
13   other_expense
14   other_profit
15   profit_before_tax   required
16   current_tax
17   deferred_tax
18   income_tax_expense
19   net_income          required
20   minority_interest
21   net_income_parent   required
""")

BALANCE_SHEET = _parse("""
2        total_assets             required nonneg
4        total_capital            required nonneg
101      current_assets           nonneg
102      long_term_assets         nonneg
301      total_liabilities        required nonneg
302      total_equity             required
30101    current_liabilities      nonneg
30102    long_term_liabilities    nonneg
10101    cash_and_equivalents     nonneg
3010105  income_taxes_payable
3020111  retained_earnings
3020114  minority_interest
10202    fixed_assets             nonneg
10103    short_term_receivables   nonneg
3010101  short_term_debt          nonneg
3010102  current_portion_lt_debt  nonneg
3010115  repo_transactions
3010206  long_term_debt
3010207  convertible_bonds
""")

CASH_FLOW_INDIRECT = _parse("""
104    cfo                   required
212    cfi
311    cff
4      net_cash_flow         required
10201  depreciation
201    capex
101    profit_before_tax_cf
10301  delta_receivables
10302  delta_inventory
10303  delta_payables
303    borrowings_received
304    debt_repaid
308    dividends_paid
5      beginning_cash        required nonneg
6      exchange_rate_effect
7      ending_cash           required nonneg
""")

HISTORICAL_QUOTES = _parse("""
priceBasic   price_basic   required nonneg
priceOpen    price_open    nonneg
priceHigh    price_high    nonneg
priceLow     price_low     nonneg
priceClose   price_close   required nonneg
totalVolume  total_volume  nonneg double
totalValue   total_value   nonneg double
""")

FUNDAMENTAL_1 = _parse("""
sharesOutstanding     shares_outstanding     required
freeShares            floating_shares
marketCap             market_cap             required
avgVolume3m           avg_volume_3m          required
insiderOwnership      insider_ownership
institutionOwnership  institution_ownership
foreignOwnership      foreign_ownership
""", default_type="double")

FUNDAMENTAL_2 = _parse("""
exchange   exchange    required string
isListing  is_listing  required boolean
""")

FUNDAMENTAL_QUARTER = _parse("""
PreferredStock        preferred_stock
MarketCapAtPeriodEnd  market_cap          required nonneg
ShareAtPeriodEnd      shares_outstanding  required nonneg
""")

DIVIDEND = _parse("""
cashDividend   cash_dividend   nonneg double
stockDividend  stock_dividend  nonneg double
""")


@dataclass(frozen=True)
class Identity:
    """``total`` must equal the signed sum of ``terms`` within 1 % of ``base``."""

    total: str
    terms: str
    base: str
    message: str


# Accounting identities and their messages.
INCOME_IDENTITIES = (
    Identity("net_revenue", "+gross_revenue -revenue_deduction", "net_revenue",
             "Err: ID 3 (Net Rev) != (1) - (2)"),
    Identity("gross_profit", "+net_revenue -cogs", "net_revenue",
             "Err: ID 5 (Gross Profit) != (3) - (4)"),
    Identity("operating_profit",
             "+gross_profit +financial_income -financial_expense +affiliate_profit"
             " -selling_expense -admin_expense", "net_revenue",
             "Err: ID 11 (Operating Profit) != (5)+(6)-(7)+(8)-(9)-(10)"),
    Identity("other_profit", "+other_income -other_expense", "net_revenue",
             "Err: ID 14 (Other Profit) != (12) - (13)"),
    Identity("profit_before_tax", "+operating_profit +other_profit", "net_revenue",
             "Err: ID 15 (Pre-tax Profit) != (11) + (14)"),
    Identity("income_tax_expense", "+current_tax +deferred_tax", "net_revenue",
             "Err: ID 18 (Tax Expense) != (16) + (17)"),
    Identity("net_income", "+profit_before_tax -income_tax_expense", "net_revenue",
             "Err: ID 19 (Net Income) != (15) - (18)"),
    Identity("net_income_parent", "+net_income -minority_interest", "net_revenue",
             "Err: ID 21 (Net Income Parent) != (19) - (20)"),
)
CASH_FLOW_IDENTITIES = (
    Identity("net_cash_flow", "+cfo +cfi +cff", "net_cash_flow",
             "Err: ID 4 (Net CF) != ID 104 + 212 + 311"),
    Identity("ending_cash", "+beginning_cash +net_cash_flow +exchange_rate_effect",
             "ending_cash", "Err: ID 7 (Ending Cash) != ID 5 + 4 + 6"),
)
BALANCE_IDENTITIES = (
    Identity("total_assets", "+total_capital", "total_assets",
             "Err: Lệch Cân đối (Tài sản != Nguồn vốn)"),
    Identity("total_assets", "+current_assets +long_term_assets", "total_assets",
             "Err: Tổng Tài sản != Ngắn hạn + Dài hạn"),
    Identity("total_capital", "+total_liabilities +total_equity", "total_capital",
             "Err: Tổng Nguồn vốn != Nợ phải trả + Vốn CSH"),
    Identity("total_liabilities", "+current_liabilities +long_term_liabilities",
             "total_liabilities", "Err: Nợ phải trả != Nợ ngắn hạn + Nợ dài hạn"),
)


@dataclass(frozen=True)
class Statement:
    data_type: str
    indicators: tuple[Indicator, ...]
    identities: tuple[Identity, ...]


STATEMENTS = {
    "income_statement": Statement(
        "income_statement_quarter", INCOME_STATEMENT, INCOME_IDENTITIES),
    "balance_sheet": Statement("balance_sheet_quarter", BALANCE_SHEET, BALANCE_IDENTITIES),
    "cash_flow": Statement(
        "cash_flow_indirect_quarter", CASH_FLOW_INDIRECT, CASH_FLOW_IDENTITIES),
}


@dataclass(frozen=True)
class TableSpec:
    """Columns, partition columns and sort order of a stored table."""

    name: str
    columns: str
    partition_by: tuple[str, ...] = ()
    sort_desc: tuple[str, ...] = ("bronze_ingested_time",)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


_META = ("batch_id string, data_type string, source string, url string, created_at_ts timestamp,"
         " message_processed_time timestamp, bronze_ingested_time timestamp")
_EAV = ("ticker string, year int, quarter int, indicator_id int, indicator_name string,"
        " value double")

# Landing tables with their columns, partitioning and order.
TABLES = {
    spec.name: spec
    for spec in (
        TableSpec("original_ticker_list", (
            "symbol string, organ_name string, icb_name3 string, icb_name2 string,"
            " icb_name4 string, com_type_code string, icb_code1 string, icb_code2 string,"
            " icb_code3 string, icb_code4 string, bronze_ingested_time timestamp"), (), ()),
        TableSpec("historical_quotes", (
            f"ticker string, year int, event_date date, data string, {_META}"), ("year",)),
        TableSpec("fundamental_1", (f"ticker string, data string, {_META}")),
        TableSpec("fundamental_2", (f"ticker string, data string, {_META}")),
        TableSpec("financial_reports_quarter", (f"{_EAV}, {_META}"),
                  ("year", "data_type")),
        TableSpec("financial_reports_year", (f"{_EAV}, {_META}"), ("year", "data_type")),
        TableSpec("fundamental_quarter", (
            f"ticker string, year int, quarter int, value string, {_META}"), ("year",)),
        TableSpec("dividend_year", (
            f"ticker string, year int, data string, {_META}"), ("year",)),
    )
}

# Freshness limits in days (warn after, error after) per landing table.
FRESHNESS_DAYS = {
    "fundamental_1": (35, 60),
    "fundamental_2": (35, 60),
    "financial_reports_quarter": (120, 180),
    "fundamental_quarter": (120, 180),
    "historical_quotes": (30, 60),
    "dividend_year": (365, 400),
}
