"""Codes, names, rules and field lists the results depend on.

Every table here is data that must equal the published conventions for results
to be right. All are small, of constant size, and used as literals in
expressions or as constant frames.
"""

from __future__ import annotations

# Futures month letters, January to December.
MONTH_CODES = "FGHJKMNQUVXZ"
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Dividend type alias -> bulk field.
DIVIDEND_TYPES = {
    "all": "DVD_Hist_All",
    "dvd": "DVD_Hist",
    "split": "Eqy_DVD_Hist_Splits",
    "gross": "Eqy_DVD_Hist_Gross",
    "adjust": "Eqy_DVD_Adjust_Fact",
    "adj_fund": "Eqy_DVD_Adj_Fund",
    "with_amt": "DVD_Hist_All_with_Amt_Status",
    "dvd_amt": "DVD_Hist_with_Amt_Status",
    "gross_amt": "DVD_Hist_Gross_with_Amt_Stat",
    "projected": "BDVD_Pr_Ex_Dts_DVD_Amts_w_Ann",
}

# Dividend column -> short name.
DIVIDEND_COLUMNS = {
    "Declared Date": "dec_date",
    "Ex-Date": "ex_date",
    "Record Date": "rec_date",
    "Payable Date": "pay_date",
    "Dividend Amount": "dvd_amt",
    "Dividend Frequency": "dvd_freq",
    "Dividend Type": "dvd_type",
    "Amount Status": "amt_status",
    "Adjustment Date": "adj_date",
    "Adjustment Factor": "adj_factor",
    "Adjustment Factor Operator Type": "adj_op",
    "Adjustment Factor Flag": "adj_flag",
    "Amount Per Share": "amt_ps",
    "Projected/Confirmed": "category",
}

# Fund holding column -> short name.
ETF_COLUMNS = {
    "Holding Name": "name",
    "Holding Ticker": "ticker",
    "Holding ISIN": "isin",
    "Holding Sedol": "sedol",
    "Holding CUSIP": "cusip",
    "Shares Held": "shares",
    "Market Value": "mkt_val",
    "Weight": "weight",
    "% Weight": "weight",
    "Sector": "sector",
    "Country": "country",
    "Asset Class": "asset_class",
    "Currency": "ccy",
    "Coupon": "coupon",
    "Maturity": "maturity",
    "id().position": "position",
    "ID": "holding",
}

# Yield type code or name -> flag.
YIELD_TYPES = {
    "YTM": 1,
    "YTC": 2,
    "YTR": 3,
    "YTP": 4,
    "YTW": 5,
    "YTWR": 6,
    "EYTW": 7,
    "EYTWR": 8,
    "YTAL": 9,
    "YIELD TO MATURITY": 1,
    "YIELD TO CALL": 2,
    "YIELD TO REFUNDING": 3,
    "YIELD TO PUT": 4,
    "YIELD TO NEXT PUT": 4,
    "YIELD TO WORST": 5,
    "YIELD TO WORST REFUNDING": 6,
    "EURO YIELD TO WORST": 7,
    "EURO YIELD TO WORST REFUNDING": 8,
    "YIELD TO AVERAGE LIFE": 9,
}

# Vendor field type -> engine type.
VENDOR_TYPES = {
    "boolean": "bool",
    "bool": "bool",
    "character": "string",
    "char": "string",
    "date": "date32",
    "dateortime": "string",
    "date_or_time": "string",
    "double": "float64",
    "real": "float64",
    "price": "float64",
    "float": "float64",
    "int32": "int64",
    "integer": "int64",
    "int64": "int64",
    "long": "int64",
    "string": "string",
    "longcharacter": "string",
    "stringorreal": "string",
    "time": "timestamp",
    "bulkformat": "string",
    "bulk": "string",
}

# Session rule by market identifier (MIC):
# (pre minutes, post minutes, lunch start, lunch end, continuous).
MIC_RULES = {
    "XNYS": (330, 240, None, None, False),
    "XNGS": (330, 240, None, None, False),
    "XASE": (330, 240, None, None, False),
    "ARCX": (330, 240, None, None, False),
    "BATS": (330, 240, None, None, False),
    "IEXG": (330, 240, None, None, False),
    "XTKS": (60, 30, 150, 210, False),
    "XOSE": (60, 30, 150, 210, False),
    "XNGO": (60, 30, 150, 210, False),
    "XFKA": (60, 30, 150, 210, False),
    "XSAP": (60, 30, 150, 210, False),
    "XHKG": (45, 15, 150, 210, False),
    "XSHG": (15, 0, 120, 210, False),
    "XSHE": (15, 0, 120, 210, False),
    "XKRX": (0, 15, None, None, False),
    "XKOS": (0, 15, None, None, False),
    "XTAI": (0, 10, None, None, False),
    "XASX": (0, 16, None, None, False),
    "XLON": (0, 30, None, None, False),
    "XETR": (0, 0, None, None, False),
    "XAMS": (0, 30, None, None, False),
    "XPAR": (0, 30, None, None, False),
    "XMAD": (0, 30, None, None, False),
    "XMIL": (0, 0, None, None, False),
    "XSWX": (0, 0, None, None, False),
    "XSTO": (0, 30, None, None, False),
    "XNSE": (0, 100, None, None, False),
    "XBOM": (0, 100, None, None, False),
    "XCME": (0, 0, None, None, True),
    "XCBT": (0, 0, None, None, True),
    "XCEC": (0, 0, None, None, True),
    "XNYM": (0, 0, None, None, True),
    "IFEU": (0, 0, None, None, True),
    "IFUS": (0, 0, None, None, True),
    "XEUR": (0, 0, None, None, True),
}

# Session rule by exchange code, same layout.
EXCHANGE_RULES = {
    "US": (330, 240, None, None, False),
    "UN": (330, 240, None, None, False),
    "UW": (330, 240, None, None, False),
    "UA": (330, 240, None, None, False),
    "JT": (60, 30, 150, 210, False),
    "JP": (60, 30, 150, 210, False),
    "HK": (45, 15, 150, 210, False),
    "CH": (15, 0, 120, 210, False),
    "CG": (15, 0, 120, 210, False),
    "CS": (15, 0, 120, 210, False),
    "KS": (0, 15, None, None, False),
    "TT": (0, 10, None, None, False),
    "AU": (0, 16, None, None, False),
    "LN": (0, 30, None, None, False),
    "GY": (0, 0, None, None, False),
    "FP": (0, 30, None, None, False),
    "IN": (0, 100, None, None, False),
    "IS": (0, 100, None, None, False),
    "IB": (0, 100, None, None, False),
    "CME": (0, 0, None, None, True),
    "CBT": (0, 0, None, None, True),
    "CMX": (0, 0, None, None, True),
    "NYM": (0, 0, None, None, True),
    "ICE": (0, 0, None, None, True),
    "EUX": (0, 0, None, None, True),
    "OSE": (0, 0, None, None, True),
    "SFE": (0, 0, None, None, True),
}

# ISO country -> IANA zone.
COUNTRY_ZONES = {
    "US": "America/New_York",
    "CA": "America/Toronto",
    "MX": "America/Mexico_City",
    "GB": "Europe/London",
    "DE": "Europe/Berlin",
    "FR": "Europe/Paris",
    "CH": "Europe/Zurich",
    "NL": "Europe/Amsterdam",
    "BE": "Europe/Brussels",
    "IT": "Europe/Rome",
    "ES": "Europe/Madrid",
    "PT": "Europe/Lisbon",
    "AT": "Europe/Vienna",
    "IE": "Europe/Dublin",
    "SE": "Europe/Stockholm",
    "NO": "Europe/Oslo",
    "DK": "Europe/Copenhagen",
    "FI": "Europe/Helsinki",
    "PL": "Europe/Warsaw",
    "CZ": "Europe/Prague",
    "HU": "Europe/Budapest",
    "GR": "Europe/Athens",
    "RU": "Europe/Moscow",
    "TR": "Europe/Istanbul",
    "JP": "Asia/Tokyo",
    "HK": "Asia/Hong_Kong",
    "SG": "Asia/Singapore",
    "CN": "Asia/Shanghai",
    "TW": "Asia/Taipei",
    "KR": "Asia/Seoul",
    "IN": "Asia/Kolkata",
    "AU": "Australia/Sydney",
    "NZ": "Pacific/Auckland",
    "TH": "Asia/Bangkok",
    "MY": "Asia/Kuala_Lumpur",
    "ID": "Asia/Jakarta",
    "PH": "Asia/Manila",
    "VN": "Asia/Ho_Chi_Minh",
    "PK": "Asia/Karachi",
    "BD": "Asia/Dhaka",
    "LK": "Asia/Colombo",
    "AE": "Asia/Dubai",
    "SA": "Asia/Riyadh",
    "IL": "Asia/Jerusalem",
    "QA": "Asia/Qatar",
    "KW": "Asia/Kuwait",
    "BH": "Asia/Bahrain",
    "OM": "Asia/Muscat",
    "ZA": "Africa/Johannesburg",
    "EG": "Africa/Cairo",
    "NG": "Africa/Lagos",
    "KE": "Africa/Nairobi",
    "MA": "Africa/Casablanca",
    "BR": "America/Sao_Paulo",
    "AR": "America/Buenos_Aires",
    "CL": "America/Santiago",
    "CO": "America/Bogota",
    "PE": "America/Lima",
    "VE": "America/Caracas",
}

# Credit-index tenors, and the ones a curve shows by default.
CDX_TENORS = ["1Y", "2Y", "3Y", "4Y", "5Y", "7Y", "10Y", "15Y", "20Y", "30Y"]
CDX_CURVE_TENORS = ["3Y", "5Y", "7Y", "10Y"]

# Fields of each bundle.
BUNDLES = {
    "bond_info": [
        "NAME", "SECURITY_DES", "CRNCY", "CPN_TYP", "CPN", "MATURITY", "PAR_AMT",
        "AMT_OUTSTANDING", "ISSUE_DT", "COUNTRY_ISO", "INDUSTRY_SECTOR", "BB_COMPOSITE",
        "RTG_SP", "RTG_MOODY", "RTG_FITCH", "CALLABLE", "PUTABLE", "SINKABLE",
    ],
    "bond_risk": [
        "DUR_ADJ_MID", "DUR_MID", "CNVX_MID", "DUR_ADJ_OAS_MID", "OAS_SPREAD_DUR_MID",
        "CNVX_OAS_MID", "RISK_MID", "RISK_OAS_MID", "YAS_MOD_DUR", "YAS_RISK",
    ],
    "bond_spreads": [
        "YAS_OAS_SPRD", "YAS_ZSPREAD", "YAS_ISPREAD", "YAS_ASW_SPREAD", "YAS_ISPREAD_TO_GOVT",
        "YAS_YLD_SPREAD", "Z_SPRD_MID", "OAS_SPREAD_MID", "YAS_BNCHMRK_BOND", "YAS_BNCHMRK_BOND_YLD",
    ],
    "bond_key_rates": [
        "KEY_RATE_DUR_1YR", "KEY_RATE_DUR_2YR", "KEY_RATE_DUR_3YR", "KEY_RATE_DUR_4YR",
        "KEY_RATE_DUR_5YR", "KEY_RATE_DUR_7YR", "KEY_RATE_DUR_8YR", "KEY_RATE_DUR_9YR",
        "KEY_RATE_DUR_10YR", "KEY_RATE_DUR_15YR", "KEY_RATE_DUR_20YR", "KEY_RATE_DUR_25YR",
        "KEY_RATE_DUR_30YR", "KEY_RATE_RISK_1Y", "KEY_RATE_RISK_2Y", "KEY_RATE_RISK_3Y",
        "KEY_RATE_RISK_5Y", "KEY_RATE_RISK_7Y", "KEY_RATE_RISK_10Y", "KEY_RATE_RISK_20Y",
        "KEY_RATE_RISK_30Y",
    ],
    "bond_curve": [
        "YAS_BOND_YLD", "YAS_MOD_DUR", "YAS_RISK", "YAS_ZSPREAD", "YAS_OAS_SPRD",
        "DUR_ADJ_MID", "CNVX_MID",
    ],
    "option_info": [
        "OPT_STRIKE_PX", "OPT_EXPIRE_DT", "OPT_PUT_CALL", "OPT_EXER_TYP", "OPT_UNDL_TICKER",
        "OPT_UNDL_PX", "OPT_CONT_SIZE", "OPT_MULTIPLIER", "NAME", "SECURITY_DES",
    ],
    "option_greeks": [
        "DELTA_MID", "GAMMA_MID", "VEGA_MID", "THETA_MID", "RHO_MID", "DELTA", "DELTA_BID",
        "DELTA_ASK", "GAMMA", "GAMMA_BID", "GAMMA_ASK", "VEGA", "VEGA_BID", "VEGA_ASK",
        "THETA_BID", "THETA_ASK", "RHO_BID", "RHO_ASK", "IVOL_MID", "IVOL_BID", "IVOL_ASK",
    ],
    "option_pricing": [
        "PX_LAST", "PX_BID", "PX_ASK", "OPT_INTRINSIC_VAL", "OPT_TRUE_INTRINSIC",
        "OPT_TIME_VAL", "OPEN_INT", "PX_VOLUME", "OPEN_INT_CHANGE",
    ],
    "option_screen": [
        "NAME", "SECURITY_DES", "OPT_STRIKE_PX", "OPT_EXPIRE_DT", "OPT_PUT_CALL", "OPT_EXER_TYP",
        "OPT_UNDL_TICKER", "OPT_UNDL_PX", "PX_LAST", "PX_BID", "PX_ASK", "IVOL_MID", "DELTA_MID",
        "GAMMA_MID", "VEGA_MID", "THETA_MID", "RHO_MID", "OPEN_INT", "PX_VOLUME",
    ],
    "cdx_info": [
        "ROLLING_SERIES", "VERSION", "ON_THE_RUN_CURRENT_BD_INDICATOR",
        "CDS_FIRST_ACCRUAL_START_DATE", "NAME", "NUM_CURRENT_COMPANIES_CCY_TKR",
        "NUM_ORIG_COMPANIES_CRNCY_TKR", "PX_LAST",
    ],
    "cdx_pricing": [
        "PX_LAST", "PX_BID", "PX_ASK", "UPFRONT_LAST", "UPFRONT_BID", "UPFRONT_ASK",
        "CDS_FLAT_SPREAD", "UPFRONT_FEE", "PV_CDS_PREMIUM_LEG", "PV_CDS_DEFAULT_LEG",
    ],
    "cdx_risk": [
        "SW_CNV_BPV", "SW_EQV_BPV", "CDS_SPREAD_MID_MODIFIED_DURATION",
        "CDS_SPREAD_MID_CONVEXITY", "RECOVERY_RATE_SEN", "CDS_RECOVERY_RT",
    ],
    "cdx_basis": [
        "CDS_INDEX_INTRINSIC_VALUE", "CDS_INDEX_INTRINSIC_BASIS_VALUE",
        "CDS_IDX_DUR_BASED_INTRINSIC_VAL", "CDS_INDEX_DUR_BASED_BASIS_VAL", "PX_LAST",
    ],
    "cdx_curve": ["PX_LAST", "UPFRONT_LAST", "CDS_FLAT_SPREAD", "SW_CNV_BPV", "CURRENT_TENOR"],
}

# Bundle fields kept as text, and those read as dates; all others are numbers.
TEXT_FIELDS = {
    "NAME", "SECURITY_DES", "CRNCY", "CPN_TYP", "COUNTRY_ISO", "INDUSTRY_SECTOR", "BB_COMPOSITE",
    "RTG_SP", "RTG_MOODY", "RTG_FITCH", "CALLABLE", "PUTABLE", "SINKABLE", "OPT_PUT_CALL",
    "OPT_EXER_TYP", "OPT_UNDL_TICKER", "ON_THE_RUN_CURRENT_BD_INDICATOR", "CURRENT_TENOR",
    "YAS_BNCHMRK_BOND",
}
DATE_FIELDS = {"MATURITY", "ISSUE_DT", "OPT_EXPIRE_DT", "CDS_FIRST_ACCRUAL_START_DATE"}

# Study alias -> study, and default parameters per study.
STUDY_ALIASES = {
    "sma": "smavg", "ema": "emavg", "wma": "wmavg", "tma": "tmavg", "mom": "momentum",
    "bb": "boll", "keltner": "kltn", "adx": "dmi", "stoch": "tas", "parabolic": "ptps",
    "sar": "ptps", "ichimoku": "goc", "williams": "wlpr",
}
STUDY_DEFAULTS = {
    "smavg": {"period": 20},
    "emavg": {"period": 20},
    "wmavg": {"period": 20},
    "tmavg": {"period": 20},
    "rsi": {"period": 14},
    "macd": {"fast": 12, "slow": 26, "signal": 9},
    "boll": {"period": 20, "upper": 2.0, "lower": 2.0},
    "dmi": {"period": 14},
    "atr": {"period": 14},
    "tas": {"period_k": 14, "period_d": 3, "period_ds": 3, "period_dss": 3},
}


def literal_map(pairs: dict[str, object]):
    """A constant map column; values are text or whole numbers."""
    from pyspark.sql import functions as F

    quote = lambda v: "'" + v.replace("'", "\\'") + "'" if isinstance(v, str) else str(v)
    return F.expr("map(" + ", ".join(f"{quote(k)}, {quote(v)}" for k, v in pairs.items()) + ")")


def rule_map(rules: dict[str, tuple]):
    """A constant map column from code to session rule."""
    from pyspark.sql import functions as F

    names = ("pre_minutes", "post_minutes", "lunch_start_min", "lunch_end_min", "is_continuous")
    kinds = ("int", "int", "int", "int", "boolean")
    entries = []
    for code, rule in rules.items():
        fields = ", ".join(
            f"'{n}', cast({'null' if v is None else str(v).lower()} as {k})" for n, k, v in zip(names, kinds, rule)
        )
        entries.append(f"'{code}', named_struct({fields})")
    return F.expr("map(" + ", ".join(entries) + ")")


def name_frame(spark, which: str):
    """A fixed name table as a frame: month_codes, dividend_types, dividend_columns, etf_columns, yield_types or country_zones."""
    tables = {
        "month_codes": dict(zip(MONTH_CODES, MONTH_NAMES)), "dividend_types": DIVIDEND_TYPES, "dividend_columns": DIVIDEND_COLUMNS,
        "etf_columns": ETF_COLUMNS, "yield_types": {k: str(v) for k, v in YIELD_TYPES.items()}, "country_zones": COUNTRY_ZONES,
    }
    if which not in tables:
        raise ValueError(f"unknown name table {which!r}; available: {', '.join(tables)}")
    return spark.createDataFrame(list(tables[which].items()), "key string, value string")
