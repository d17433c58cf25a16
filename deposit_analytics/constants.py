"""Fixed values of the deposit reports.

Everything in this module is data, not logic: product codes, calendar bounds,
tenure weights, thresholds and the column names of the stored tables. The jobs
take each of them as a parameter, with these values as defaults.
"""

# Product codes (first two characters of an account number).
# The two wealth jobs disagree about the second term code.
GROUP_JOB_CODES = {
    "interest_free": ("01", "03"),
    "short_term": ("02",),
    "term": ("04", "08"),
}
PIVOT_JOB_CODES = {
    "interest_free": ("01", "03"),
    "short_term": ("02",),
    "term": ("04", "05"),
}
LOOKBACK_CODES = {
    "interest_free": ("01", "03"),
    "short_term": ("02",),
    "term": ("04", "08"),
}

# Customer type the pivot job leaves out, and the century that
# six-digit opening dates imply.
EXCLUDED_TYPE = "02"
CENTURY = "13"

# Wealth thresholds. The pivot job keeps totals strictly above
# the first, the group job keeps sums from the second upwards.
PIVOT_THRESHOLD = 9999999999
GROUP_THRESHOLD = 10000000000

# Month lengths (months 1-6, 7-11, 12; a leap year adds one day to
# month 12).
LONG_MONTH = 31
SHORT_MONTH = 30
LAST_MONTH = 29

# Tenure weights in hundredths of a day (a year counts 365 days,
# a month 30.42 days), and the distance between the Gregorian and the Jalali
# day count under those weights (226746.26 days).
YEAR_HUNDREDTHS = 36500
MONTH_HUNDREDTHS = 3042
DAY_HUNDREDTHS = 100
GREGORIAN_OFFSET_HUNDREDTHS = 22674626

# Months the lookback reaches back.
LOOKBACK_MONTHS = 3

# Column names of the stored tables -> names used here.
BALANCE_COLUMNS = {
    "CUSTNO": "custno",
    "ACNO": "acno",
    "REMAININGAMOUNTEFFECTIVE": "remaining",
    "HISDATE": "snapshot",
}
CUSTOMER_COLUMNS = {
    "CUSTNO": "custno",
    "custype": "cust_type",
    "DATEOPN": "date_opened",
}

# Names used here -> column names of the stored result tables.
GROUP_EXPORT_NAMES = {
    "custno": "CUSTNO",
    "interest_free": "MandehGharz",
    "short_term": "MandehKootah",
    "term": "MandehModatdar",
    "tenure_days": "ghedmat",
    "snapshot": "tarikh",
}
PIVOT_EXPORT_NAMES = {
    "custno": "custno",
    "interest_free": "gharz",
    "short_term": "kotah",
    "term": "boland",
    "tenure_days": "ghedmat",
    "snapshot": "tarikh",
}

# Types for money columns. MONEY is exact for amounts with up to two decimals
# and 36 whole digits. WHOLE_MONEY halves the cost of the sums and fits tables
# that hold whole units only.
MONEY = "decimal(38,2)"
WHOLE_MONEY = "bigint"

# Decimals up to which a sum times a number of copies keeps all its digits in
# Spark's decimal arithmetic.
MOST_SCALE = 6
