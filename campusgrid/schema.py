"""Schemas, name maps, code tables and limits.

Everything here is a fixed value: names, codes and thresholds that results
depend on. Functions take them as default arguments, so a caller can pass
others.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: record fields and their column names --------------------

FIELD_TO_COLUMN = {
    "id": "school_id",
    "school.name": "school_name",
    "school.state": "school_state",
    "school.city": "school_city",
    "school.zip": "school_zip",
    "school.school_url": "school_url",
    "school.ownership": "ownership",
    "school.region_id": "region_id",
    "school.locale": "locale",
    "school.operating": "operating",
    "latest.student.size": "student_size",
    "latest.student.grad_students": "grad_students",
    "latest.admissions.admission_rate.overall": "admission_rate_overall",
    "latest.completion.rate_suppressed.overall": "completion_rate_overall",
    "latest.completion.rate_suppressed.four_year": "completion_rate_4yr",
    "latest.cost.tuition.in_state": "tuition_in_state",
    "latest.cost.tuition.out_of_state": "tuition_out_of_state",
    "latest.aid.median_debt.completers.overall": "median_debt",
    "latest.earnings.10_yrs_after_entry.median": "earnings_10yr_median",
    "location.lat": "latitude",
    "location.lon": "longitude",
}

INTEGER_COLUMNS = (
    "school_id",
    "student_size",
    "grad_students",
    "ownership",
    "region_id",
    "locale",
    "operating",
    "tuition_in_state",
    "tuition_out_of_state",
    "median_debt",
    "earnings_10yr_median",
)

FLOAT_COLUMNS = (
    "admission_rate_overall",
    "completion_rate_overall",
    "completion_rate_4yr",
    "latitude",
    "longitude",
)

STRING_COLUMNS = (
    "school_name",
    "school_state",
    "school_city",
    "school_zip",
    "school_url",
)

# The wider record: the fields above without the operating flag, plus these eleven.
EXTENDED_FIELD_TO_COLUMN = {
    **{f: c for f, c in FIELD_TO_COLUMN.items() if c != "operating"},
    "school.carnegie_basic": "carnegie_basic",
    "school.degrees_awarded.predominant": "predominant_degree",
    "school.degrees_awarded.highest": "highest_degree",
    "latest.student.demographics.men": "demographics_men",
    "latest.student.demographics.women": "demographics_women",
    "latest.student.demographics.race_ethnicity.white": "demographics_white",
    "latest.student.demographics.race_ethnicity.black": "demographics_black",
    "latest.student.demographics.race_ethnicity.hispanic": "demographics_hispanic",
    "latest.student.demographics.race_ethnicity.asian": "demographics_asian",
    "latest.admissions.sat_scores.average.overall": "sat_average",
    "latest.admissions.act_scores.midpoint.cumulative": "act_midpoint",
}

EXTENDED_INTEGER_COLUMNS = (
    "school_id",
    "student_size",
    "grad_students",
    "tuition_in_state",
    "tuition_out_of_state",
    "sat_average",
    "act_midpoint",
    "ownership",
    "region_id",
    "locale",
    "carnegie_basic",
    "predominant_degree",
    "highest_degree",
)

EXTENDED_FLOAT_COLUMNS = (
    "admission_rate_overall",
    "completion_rate_overall",
    "completion_rate_4yr",
    "demographics_men",
    "demographics_women",
    "demographics_white",
    "demographics_black",
    "demographics_hispanic",
    "demographics_asian",
    "median_debt",
    "earnings_10yr_median",
    "latitude",
    "longitude",
)

PRIORITY_COLUMNS = (
    "school_id",
    "school_name",
    "school_state",
    "school_city",
    "student_size",
    "admission_rate_overall",
    "completion_rate_overall",
)

# --- fixed values: field groups and dataset presets -------------------------

FIELD_GROUPS = {
    "basic": (
        "id",
        "school.name",
        "school.city",
        "school.state",
        "school.zip",
        "school.school_url",
        "school.ownership",
        "school.locale",
        "school.region_id",
    ),
    "enrollment": (
        "latest.student.size",
        "latest.student.enrollment.all",
        "latest.student.enrollment.undergrad_12_month",
        "latest.student.enrollment.grad_12_month",
        "latest.student.part_time_share",
    ),
    "demographics": (
        "latest.student.demographics.race_ethnicity.white",
        "latest.student.demographics.race_ethnicity.black",
        "latest.student.demographics.race_ethnicity.hispanic",
        "latest.student.demographics.race_ethnicity.asian",
        "latest.student.demographics.age_entry",
        "latest.student.demographics.female_share",
        "latest.student.share_firstgeneration",
    ),
    "cost": (
        "latest.cost.tuition.in_state",
        "latest.cost.tuition.out_of_state",
        "latest.cost.avg_net_price.overall",
        "latest.cost.attendance.academic_year",
        "latest.aid.median_debt.completers.overall",
        "latest.aid.pell_grant_rate",
    ),
    "outcomes": (
        "latest.completion.rate_suppressed.overall",
        "latest.completion.rate_suppressed.four_year",
        "latest.earnings.10_yrs_after_entry.median",
        "latest.earnings.6_yrs_after_entry.median",
        "latest.admissions.admission_rate.overall",
        "latest.admissions.sat_scores.average.overall",
    ),
    "programs": (
        "latest.academics.program_percentage.education",
        "latest.academics.program_percentage.business_marketing",
        "latest.academics.program_percentage.health",
        "latest.academics.program_percentage.computer",
        "latest.academics.program_percentage.engineering",
    ),
}

DEFAULT_GROUPS = ("basic", "enrollment")

# preset name -> (field groups, fixed row filters)
PRESETS = {
    "all_institutions": (("basic", "enrollment", "cost", "outcomes"), {}),
    "public_universities": (("basic", "enrollment", "cost", "outcomes"), {"ownership": 1}),
    "private_nonprofit": (("basic", "enrollment", "cost", "outcomes"), {"ownership": 2}),
    "by_state": (("basic", "enrollment", "demographics"), {}),
    "enrollment_demographics": (("basic", "enrollment", "demographics"), {}),
    "costs_and_aid": (("basic", "cost"), {}),
    "outcomes_and_earnings": (("basic", "outcomes"), {}),
}

LARGE_ENROLLMENT = 10000

# --- fixed values: cleaning ------------------------------------------------

RATE_RENAMES = {
    "admission_rate_overall": "admission_rate",
    "completion_rate_overall": "completion_rate",
}

NULL_TOKENS = ("nan", "None", "NaN", "", "null", "NULL")
STATE_NULL_TOKENS = ("NAN", "NONE", "")
NUMERIC_EXPECTED = ("student_size", "admission_rate", "completion_rate")
NON_NEGATIVE_COLUMNS = (
    "student_size",
    "admission_rate",
    "completion_rate",
    "admission_rate_percentage",
    "completion_rate_percentage",
)

SMALL_BELOW = 5000
LARGE_ABOVE = 15000
SIZE_ORDER = ("large", "medium", "small")

OWNERSHIP_LABELS = {
    1: "Public",
    2: "Private nonprofit",
    3: "Private for-profit",
}

REGION_LABELS = {
    0: "U.S. Service Schools",
    1: "New England",
    2: "Mid East",
    3: "Great Lakes",
    4: "Plains",
    5: "Southeast",
    6: "Southwest",
    7: "Rocky Mountains",
    8: "Far West",
    9: "Outlying Areas",
}

# --- fixed values: quality checks ------------------------------------------

REQUIRED_COLUMNS = (
    "school_name",
    "school_state",
    "student_size",
    "admission_rate_overall",
    "completion_rate_overall",
)
CRITICAL_COLUMNS = ("school_name", "school_state")
NULL_THRESHOLD_PERCENT = 5.0
EXPECTED_TYPES = {
    "school_name": "string",
    "school_state": "string",
    "student_size": "numeric",
    "admission_rate_overall": "float",
    "completion_rate_overall": "float",
}
RANGES = {
    "admission_rate_overall": (0.0, 1.0),
    "completion_rate_overall": (0.0, 1.0),
    "student_size": (0, None),
}
DUPLICATE_KEY = ("school_name", "school_state")
COMPLETENESS_FIELDS = REQUIRED_COLUMNS

# Paths expected in a nested record.
NESTED_PATHS = {
    "school.name": "latest.school.name",
    "school.state": "latest.school.state",
    "latest.student.size": "latest.student.size",
    "latest.admissions.admission_rate.overall": "latest.admissions.admission_rate.overall",
    "latest.completion.rate_suppressed.overall": "latest.completion.rate_suppressed.overall",
}

# --- fixed values: surveys -------------------------------------------------

# code -> (name, description, frequency, file suffixes)
SURVEYS = {
    "HD": (
        "Directory Information",
        "Basic institutional information, location, control, level",
        "annual",
        (),
    ),
    "IC": (
        "Institutional Characteristics",
        "Tuition, fees, room & board, programs offered",
        "annual",
        (),
    ),
    "EFFY": (
        "Fall Enrollment - 12-month Unduplicated Headcount",
        "Unduplicated student enrollment counts",
        "annual",
        (),
    ),
    "EFIA": (
        "Fall Enrollment - Instructional Activity",
        "Credit and contact hours, FTE enrollment",
        "annual",
        (),
    ),
    "EF": (
        "Fall Enrollment",
        "Enrollment by race/ethnicity, gender, attendance status",
        "annual",
        ("A", "B", "C", "D"),
    ),
    "C": (
        "Completions",
        "Awards/degrees conferred by program, race, gender",
        "annual",
        ("A", "B", "C"),
    ),
    "GR": (
        "Graduation Rates",
        "Graduation rates for full-time, first-time students",
        "annual",
        (),
    ),
    "SFA": ("Student Financial Aid", "Financial aid, net price, Pell grants", "annual", ()),
    "SAL": ("Salaries", "Faculty salaries by rank and contract length", "annual", ("A", "B")),
    "S": ("Staff", "Employees by occupation, faculty status", "annual", ()),
    "F": ("Finance", "Revenues, expenses, assets, liabilities", "annual", ("1A", "2", "3")),
    "AL": (
        "Academic Libraries",
        "Library collections, expenditures, services",
        "biennial",
        (),
    ),
    "ADM": ("Admissions", "Admissions data, test scores, requirements", "annual", ()),
}
SURVEY_YEARS = range(2012, 2024)
SURVEY_KEY = "UNITID"
DEFAULT_SURVEYS = ("HD", "IC", "EFFY", "SFA")
SURVEY_SEED = 42

SAMPLE_STATES = ("CA", "TX", "NY", "FL", "IL", "PA", "OH", "MI", "NC", "GA")

# column -> (low, high), high excluded, for generated integers
SAMPLE_INTEGERS = {
    "HD": {
        "OBEREG": (1, 9),
        "SECTOR": (1, 7),
        "HLOFFER": (1, 10),
    },
    "IC": {
        "TUITION2": (5000, 60000),
        "TUITION3": (10000, 80000),
        "CHG4AY3": (8000, 20000),
        "CHG5AY3": (3000, 10000),
        "APPLCN": (1000, 100000),
        "ADMSSN": (500, 80000),
    },
    "EFFY": {
        "EFYTOTLT": (100, 50000),
        "EFYTOTLM": (50, 25000),
        "EFYTOTLW": (50, 25000),
        "EFYWHITT": (50, 20000),
        "EFYBKAAT": (10, 10000),
        "EFYHISPT": (10, 10000),
        "EFYASIAT": (10, 5000),
    },
    "SFA": {
        "SCUGRAD": (100, 30000),
        "UAGRNTN": (50, 20000),
        "UAGRNTA": (1000, 30000),
        "UPGRNTN": (50, 15000),
        "UPGRNTA": (500, 10000),
        "NPIST1": (5000, 50000),
        "NPIST2": (5000, 45000),
    },
    "GR": {
        "GRTOTLT": (100, 10000),
        "GRTOTLM": (50, 5000),
        "GRTOTLW": (50, 5000),
    },
}
SAMPLE_INTEGERS["EF"] = SAMPLE_INTEGERS["EFFY"]

# column -> (low, high) for generated rates with three decimals
SAMPLE_RATES = {"GR": {"GR4RT": (0.1, 0.8), "GR6RT": (0.2, 0.9)}}

# --- fixed values: sales sheets --------------------------------------------

INSTRUCTION_COLUMNS = (
    ("Row ID", T.LongType()),
    ("Instruction ID", T.StringType()),
    ("Instruction Date", T.DateType()),
    ("Transport Date", T.IntegerType()),
    ("Transport Mode", T.StringType()),
    ("Client ID", T.StringType()),
    ("Client Name", T.StringType()),
    ("Section", T.StringType()),
    ("Nation", T.StringType()),
    ("Town", T.StringType()),
    ("State or Province", T.StringType()),
    ("Postal Code", T.IntegerType()),
    ("Region", T.StringType()),
    ("Product ID", T.StringType()),
    ("Group", T.StringType()),
    ("Sub-Group", T.StringType()),
    ("Product Name", T.StringType()),
    ("Revenue", T.DoubleType()),
    ("Qty", T.IntegerType()),
    ("Reduction", T.DoubleType()),
    ("Turnover", T.DoubleType()),
)
REIMBURSEMENT_COLUMNS = (
    ("Reimbursed", T.StringType()),
    ("Instruction ID", T.StringType()),
)
GROUP_MEMBERS = ("Furniture", "Office Supplies", "Technology")
SHEET_STATES = (
    "Alabama",
    "Arizona",
    "Arkansas",
    "California",
    "Colorado",
    "Connecticut",
    "Delaware",
    "District of Columbia",
    "Florida",
    "Georgia",
    "Idaho",
    "Illinois",
    "Indiana",
    "Iowa",
    "Kansas",
    "Kentucky",
    "Louisiana",
    "Maine",
    "Maryland",
    "Massachusetts",
    "Michigan",
    "Minnesota",
    "Mississippi",
    "Missouri",
    "Montana",
    "Nebraska",
    "Nevada",
    "New Hampshire",
    "New Jersey",
    "New Mexico",
    "New York",
    "North Carolina",
    "North Dakota",
    "Ohio",
    "Oklahoma",
    "Oregon",
    "Pennsylvania",
    "Rhode Island",
    "South Carolina",
    "South Dakota",
    "Tennessee",
    "Texas",
    "Utah",
    "Vermont",
    "Virginia",
    "Washington",
    "West Virginia",
    "Wisconsin",
    "Wyoming",
)

# --- schemas ---------------------------------------------------------------


def _fields(pairs) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in pairs])


def _record_type(column: str) -> T.DataType:
    if column in INTEGER_COLUMNS:
        return T.LongType()
    return T.DoubleType() if column in FLOAT_COLUMNS else T.StringType()


# A record as it is landed. Numbers are read as text so that a bad value costs
# one cell, not the whole record; `records_to_table` casts them.
RECORD = _fields((field, T.StringType()) for field in FIELD_TO_COLUMN)

PAGE = _fields(
    [
        (
            "metadata",
            _fields(
                [
                    ("total", T.LongType()),
                    ("page", T.LongType()),
                    ("per_page", T.LongType()),
                ]
            ),
        ),
        ("results", T.ArrayType(RECORD, True)),
    ]
)

RECORD_TABLE = _fields((c, _record_type(c)) for c in FIELD_TO_COLUMN.values())

INSTITUTION = _fields(
    [
        ("school_id", T.LongType()),
        ("school_name", T.StringType()),
        ("school_city", T.StringType()),
        ("school_state", T.StringType()),
        ("school_zip", T.StringType()),
        ("school_url", T.StringType()),
        ("latitude", T.DoubleType()),
        ("longitude", T.DoubleType()),
        ("ownership", T.IntegerType()),
        ("region_id", T.IntegerType()),
        ("locale", T.IntegerType()),
        ("operating", T.IntegerType()),
        ("student_size", T.DoubleType()),
        ("grad_students", T.DoubleType()),
        ("size_category", T.StringType()),
        ("admission_rate", T.DoubleType()),
        ("admission_rate_percentage", T.DoubleType()),
        ("completion_rate", T.DoubleType()),
        ("completion_rate_percentage", T.DoubleType()),
        ("completion_rate_4yr", T.DoubleType()),
        ("tuition_in_state", T.DoubleType()),
        ("tuition_out_of_state", T.DoubleType()),
        ("median_debt", T.DoubleType()),
        ("earnings_10yr_median", T.DoubleType()),
        ("extracted_at", T.TimestampType()),
        ("source", T.StringType()),
    ]
)

INSTRUCTIONS = _fields(INSTRUCTION_COLUMNS)
REIMBURSEMENTS = _fields(REIMBURSEMENT_COLUMNS)

CATALOGUE = _fields(
    [
        ("source", T.StringType()),
        ("dataset", T.StringType()),
        ("version", T.StringType()),
        ("row_count", T.LongType()),
        ("column_count", T.IntegerType()),
        ("columns", T.ArrayType(T.StringType())),
        ("dtypes", T.MapType(T.StringType(), T.StringType())),
        ("created_at", T.TimestampType()),
        ("file_format", T.StringType()),
        ("params", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Columns that the merged survey table needs of each survey, by the names of the
# archives' own columns.
SURVEY_SCHEMAS = {
    "HD": _fields(
        [
            (SURVEY_KEY, T.LongType()),
            ("INSTNM", T.StringType()),
            ("CITY", T.StringType()),
            ("STABBR", T.StringType()),
            ("ZIP", T.StringType()),
            ("OBEREG", T.IntegerType()),
            ("SECTOR", T.IntegerType()),
            ("ICLEVEL", T.IntegerType()),
            ("CONTROL", T.IntegerType()),
            ("HLOFFER", T.IntegerType()),
            ("WEBADDR", T.StringType()),
        ]
    ),
    **{
        code: _fields(
            [
                (SURVEY_KEY, T.LongType()),
                *[(name, T.LongType()) for name in SAMPLE_INTEGERS.get(code, {})],
                *[(name, T.DoubleType()) for name in SAMPLE_RATES.get(code, {})],
            ]
        )
        for code in SURVEYS
        if code != "HD"
    },
}
