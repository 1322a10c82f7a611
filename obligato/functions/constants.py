"""Fixed domain values.

FIXED VALUES — these must equal the published behaviour for results to match:
month order, month-code mapping, report line numbers, target agency list,
known exceptions, expected counts and thresholds.
"""

# Fiscal month order (October opens the fiscal year).
FISCAL_MONTHS = ["Oct", "Nov", "Dec", "Jan", "Feb", "Mar",
                 "Apr", "May", "Jun", "Jul", "Aug", "Sep"]

# Calendar month abbreviations, index 1..12.
CALENDAR_MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
                   "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Month order of the legacy summary: its latest month is the first of Aug, Jul, ... Oct, Sep with data.
LEGACY_MONTHS = ["Sep", "Oct", "Nov", "Dec", "Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug"]

MONTH_FULL = {
    "Oct": "October", "Nov": "November", "Dec": "December",
    "Jan": "January", "Feb": "February", "Mar": "March",
    "Apr": "April", "May": "May", "Jun": "June",
    "Jul": "July", "Aug": "August", "Sep": "September",
}

# Raw ledger amount columns -> month; AMT1..AMT4 are quarter-end columns.
RAW_MONTH_COLUMNS = {
    "AMT_OCT": "Oct", "AMT_NOV": "Nov", "AMT_DEC": "Dec", "AMT_JAN": "Jan",
    "AMT_FEB": "Feb", "AMT_MAR": "Mar", "AMT_APR": "Apr", "AMT_MAY": "May",
    "AMT_JUN": "Jun", "AMT_JUL": "Jul", "AMT_AUG": "Aug", "AMT_SEP": "Sep",
    "AMT1": "Dec", "AMT2": "Mar", "AMT3": "Jun", "AMT4": "Sep",
}

# Quarter-end month per fiscal quarter.
QUARTER_END = {"Q1": "Dec", "Q2": "Mar", "Q3": "Jun", "Q4": "Sep"}

# Metadata columns exempt from unit scaling.
UNIT_EXEMPT = ["LINENO", "RPT_YR", "TRAG", "TRACCT", "ALLOC", "FY1", "FY2",
               "SECTION_NO", "LINE_TYPE"]

# Report lines paired by the summaries.
LINE_UNOBLIGATED = 2490
LINE_BUDGET_AUTHORITY = 2500

# Standard report-line range.
LINE_MIN, LINE_MAX = 1000, 9999

OIA = "Other Independent Agencies"

# Target agencies in match order.
TARGET_AGENCIES = [
    "Legislative Branch",
    "Judicial Branch",
    "Department of Agriculture",
    "Department of Commerce",
    "Department of Defense-Military",
    "Department of Education",
    "Department of Energy",
    "Department of Health and Human Services",
    "Department of Homeland Security",
    "Department of Housing and Urban Development",
    "Department of the Interior",
    "Department of Justice",
    "Department of Labor",
    "Department of State",
    "Department of Transportation",
    "Department of the Treasury",
    "Department of Veterans Affairs",
    "Corps of Engineers-Civil Works",
    "Other Defense Civil Programs",
    "Environmental Protection Agency",
    "Executive Office of the President",
    "General Services Administration",
    "International Assistance Programs",
    "National Aeronautics and Space Administration",
    "National Science Foundation",
    "Office of Personnel Management",
    "Small Business Administration",
    "Social Security Administration",
    "Other Independent Agencies",
]

# Special agency matches: (target, all of these substrings, any of these substrings).
AGENCY_SPECIAL_CASES = [
    ("Department of Defense-Military", ["defense"], ["military", "dod"]),
    ("Corps of Engineers-Civil Works", ["corps of engineers", "civil"], []),
    ("Other Defense Civil Programs", ["other defense", "civil"], []),
]

# Expected summary rows per year for the snapshot check.
EXPECTED_SUMMARY_ROWS = {2018: 29988, 2019: 30164, 2020: 29641, 2021: 32790,
                         2022: 32651, 2023: 9474, 2024: 9557, 2025: 8557}

# Thresholds.
COVERAGE_THRESHOLD_PCT = 80.0
FDR_ALPHA = 0.05
NEAR_ZERO_M = 0.001

# Outlier report minimum budget (millions) per level.
MIN_BUDGET = {"agency": 100.0, "bureau": 50.0, "account": 10.0}

# Invalid display tokens.
INVALID_TOKEN_PATTERN = r"\$nanM|nan%|nanM"
