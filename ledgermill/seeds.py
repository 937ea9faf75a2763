"""Reference rows as DataFrames.

Everything below the "Fixed values" comments is data that results depend on and
is stated as plain text, one row per line, fields separated by ``|``. An empty
field is NULL. The frames are inline ``VALUES`` relations, so Spark knows their
exact size and broadcasts them without a hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# First and last seeded financial year and the running one.
FIRST_FY, LAST_FY, CURRENT_FY = 2023, 2026, 2025

# Document categories (id | name | group | description | deductible |
# reference | sort order).
TAX_CATEGORIES = """
1|Payment Summary / Group Certificate|Income|Annual income statement from employer|false|Item 1|1
2|Bank Interest Statement|Income|Interest earned on savings accounts|false|Item 10|2
3|Dividend Statement|Income|Share dividend payments|false|Item 11|3
4|Share Sale / CGT Event|Income|Capital gains from share disposals|false|Item 18|4
5|Work From Home — Internet|Deductions|Home internet bill (WFH portion deductible)|true|D5|10
6|Work From Home — Electricity/Gas|Deductions|Utility bill (WFH portion deductible)|true|D5|11
7|Work From Home — Insurance|Deductions|Home & contents insurance (home office portion)|true|D5|12
8|Technology Equipment|Deductions|Work-related tech: keyboards, mice, hard drives, monitors|true|D3|13
9|Software & Subscriptions|Deductions|Work-related software, LLM subscriptions, productivity tools|true|D5|14
10|Professional Development|Deductions|Training courses, certifications, conferences|true|D4|15
11|Professional Memberships|Deductions|Industry body memberships and subscriptions|true|D5|16
12|Income Protection Insurance|Deductions|Premiums for income protection policy — fully deductible|true|D12|20
13|Rental Income Statement|Property|Rental property income statements|false|Item 21|30
14|Property Depreciation Schedule|Property|Depreciation report from quantity surveyor|true|Item 21|31
15|ATO Notice / Assessment|Government|Tax assessment, payment or refund notice from ATO|false||40
16|HECS/HELP Statement|Government|Student loan balance and repayment statement|false|Item 14|41
17|Superannuation Statement|Super|Annual super fund statement|false||50
18|Super Contribution Notice|Super|Voluntary super contribution confirmation|false||51
19|Private Health Insurance Statement|Health|Annual PHI statement for Medicare Levy Surcharge assessment|false|Item M2|60
20|Invoice / Receipt — Other|Other|Unclassified invoice or receipt requiring manual review|false||99
21|Managed Fund Tax Statement|Income|Annual tax statement from managed fund|false||21
22|Employment Termination Payment|Income|ETP / lump sum payout from employer|false||22
23|Government / Centrelink Payment|Government|Centrelink, pension, or other government payments|false||23
24|Employee Share Scheme|Income|ESS documents from employer|false||24
25|Foreign Income|Income|Foreign income or overseas investment income|false||25
26|Cryptocurrency Tax Report|Income|Annual crypto tax summary or Koinly report|false||26
27|Business / Trust Distribution|Income|Distribution from business, trust, or partnership|false||27
28|Motor Vehicle / Logbook|Deductions|Vehicle logbook, odometer records, fuel receipts|true||28
29|Self-Education Expenses|Deductions|Course fees, textbooks, study materials|true||29
30|Donations|Deductions|Tax-deductible donation receipts|true||30
31|Work-Related Travel|Deductions|Work travel expenses excluding home-to-work|true||31
32|Tax Agent Fees|Deductions|Prior year accounting / tax agent invoice|true||32
33|Work-Related Assets|Deductions|Assets purchased for work use (>$300 threshold)|true||33
"""

# Spending categories (id | name | subcategory | income | tax relevant |
# deductible | sort order).
TRANSACTION_CATEGORIES = """
1|Income|Salary/Wages|true|true|false|1
2|Income|Freelance/Contract|true|true|false|2
3|Income|Interest|true|true|false|3
4|Income|Dividends|true|true|false|4
5|Income|Other|true|true|false|5
6|Housing|Mortgage/Rent|false|false|false|10
7|Housing|Rates & Strata|false|false|false|11
8|Housing|Electricity/Gas|false|true|true|12
9|Housing|Water|false|false|false|13
10|Housing|Internet|false|true|true|14
11|Housing|Insurance|false|true|true|15
12|Food|Groceries|false|false|false|20
13|Food|Dining Out|false|false|false|21
14|Food|Takeaway/Delivery|false|false|false|22
15|Transport|Fuel|false|false|false|30
16|Transport|Public Transport|false|false|false|31
17|Transport|Parking|false|false|false|32
18|Transport|Car Insurance|false|false|false|33
19|Transport|Car Registration|false|false|false|34
20|Transport|Tolls|false|false|false|35
21|Health|Private Health Insurance|false|false|false|40
22|Health|Medical/Dental|false|false|false|41
23|Health|Pharmacy|false|false|false|42
24|Health|Optical|false|false|false|43
25|Insurance|Income Protection|false|true|true|50
26|Insurance|Life Insurance|false|false|false|51
27|Insurance|Other|false|false|false|52
28|Technology|Hardware|false|true|true|60
29|Technology|Software/Subscriptions|false|true|true|61
30|Technology|Mobile Phone|false|false|false|62
31|Professional|Training & Education|false|true|true|70
32|Professional|Memberships|false|true|true|71
33|Professional|Books & Resources|false|true|true|72
34|Entertainment|Streaming Services|false|false|false|80
35|Entertainment|Hobbies|false|false|false|81
36|Entertainment|Social/Dining|false|false|false|82
37|Entertainment|Sport & Fitness|false|false|false|83
38|Savings|Savings Transfer|false|false|false|90
39|Savings|Investment Purchase|false|false|false|91
40|Savings|Super Contribution|false|false|false|92
41|Other|ATM/Cash|false|false|false|99
42|Other|Fees & Charges|false|false|false|99
43|Other|Uncategorised|false|false|false|99
"""

# Statement layouts (id | provider | date column | date format | amount column |
# debit column | credit column | description column | balance column | rows to skip).
STATEMENT_PROVIDERS = """
1|NAB|Date|%d %b %y|Amount|||Transaction Details|Balance|0
2|Bendigo|Date|%d/%m/%Y||Debit|Credit|Description|Balance|0
3|CommSec|Date|%d/%m/%Y||Debit|Credit|Description|Balance|0
"""

# Accounts (id | name | provider | type | currency | active | layout id).
ACCOUNTS = """
1|NAB Transaction Account|NAB|TRANSACTION|AUD|true|1
2|NAB Savings Account|NAB|SAVINGS|AUD|true|1
3|Bendigo Bank Account|Bendigo|TRANSACTION|AUD|true|2
4|Share Holdings|CommSec|INVESTMENT|AUD|true|3
5|Superannuation|TBD|SUPER|AUD|true|
"""

# Questions asked once per applicability group (group | question).
CHECKLIST_QUESTIONS = """
INTEREST|Did you earn interest income from bank or savings accounts this year?
SHARES|Did you receive dividends or distributions from shares or managed funds?
CGT|Did you sell any shares, ETFs, or other investments this year?
MANAGED_FUND|Did you receive income from a managed fund?
ETP|Did you finish employment or receive a lump sum payout this year?
CENTRELINK|Did you receive Centrelink or any government payments this year?
ESS|Are you involved in an Employee Share Scheme?
FOREIGN|Did you earn foreign income or hold overseas investments this year?
CRYPTO|Did you trade, sell, swap, or hold cryptocurrency this year?
BUSINESS|Did you receive a distribution from a business, trust, or partnership?
WFH|Did you work from home this year?
TECH|Did you purchase work-related technology or equipment this year?
SELF_ED|Did you have self-education or professional development expenses?
PROF_MEM|Did you pay work-related professional membership fees?
INCOME_PROT|Do you have income protection insurance paid outside your super fund?
VEHICLE|Did you use your personal vehicle for work purposes this year?
DONATIONS|Did you make any tax-deductible donations this year?
WORK_TRAVEL|Did you incur work-related travel costs (flights, accommodation, etc.)?
WORK_ASSETS|Did you purchase any work-related assets this year?
RENTAL|Do you own a rental property?
SUPER|Do you want to review super contributions or claim a deduction for personal contributions?
HEALTH|Do you have private health insurance (hospital or combined cover, not extras only)?
ATO|Did you receive any correspondence or notices from the ATO this year?
HECS|Do you have a HECS-HELP, VSL, SFSS, SSL, or TSL debt?
"""

# Checklist documents (id | section | name | description | always required |
# group | category id | sort order).
CHECKLIST_DOCUMENTS = """
1|Income|Payment Summary / PAYG from employer|Payment summary or income statement from each employer.|true||1|10
2|Income|Bank interest statement|Interest income from all bank or savings accounts.|false|INTEREST|2|20
3|Income|Dividend statement|Dividend or distribution statements from shares or ETFs.|false|SHARES|3|30
4|Income|Share sale / CGT event|Purchase and sale contracts for any shares or investments sold.|false|CGT|4|40
5|Income|Managed fund annual tax statement|Annual tax statement from managed fund provider.|false|MANAGED_FUND|21|50
6|Income|Employment termination payment (ETP)|ETP or lump sum payment documents from employer.|false|ETP|22|60
7|Income|Government / Centrelink payments|Centrelink, pension, or other government payment summaries.|false|CENTRELINK|23|70
8|Income|Employee Share Scheme (ESS) documents|ESS statements or discounts reported for tax.|false|ESS|24|80
9|Income|Foreign income|Foreign income or overseas investment income documentation.|false|FOREIGN|25|90
10|Income|Cryptocurrency annual tax report|Annual crypto tax summary or Koinly CGT report.|false|CRYPTO|26|100
11|Income|Business / trust / partnership distribution|Distribution statement from a business, trust, or partnership.|false|BUSINESS|27|110
12|Deductions|Work from home — electricity/gas bills|Energy bills for work-from-home claim (fixed rate or actual cost method).|false|WFH|6|200
13|Deductions|Work from home — internet bills|Internet plan invoices for work-from-home claim.|false|WFH|5|210
14|Deductions|Work from home — home/contents insurance|Insurance policy documents for work-from-home actual cost claim.|false|WFH|7|220
15|Deductions|Technology equipment receipts|Receipts for laptops, monitors, or other work-related tech.|false|TECH|8|300
16|Deductions|Software & subscription receipts|Receipts for work-related software or online subscriptions.|false|TECH|9|310
17|Deductions|Professional development / self-education receipts|Course fees, textbooks, or study material receipts.|false|SELF_ED|10|400
18|Deductions|Professional membership fees|Receipts for work-related professional association memberships.|false|PROF_MEM|11|410
19|Deductions|Income protection insurance (outside super)|Income protection insurance policy or premium statement.|false|INCOME_PROT|12|500
20|Deductions|Motor vehicle / logbook records|Logbook, odometer readings, or vehicle expense receipts.|false|VEHICLE|28|510
21|Deductions|Self-education expense receipts|Receipts for courses, textbooks, or study directly related to current work.|false|SELF_ED|29|520
22|Deductions|Donation receipts|Receipts for tax-deductible charitable donations.|false|DONATIONS|30|530
23|Deductions|Work-related travel expenses|Receipts or records for work travel (excluding home-to-work commute).|false|WORK_TRAVEL|31|540
24|Deductions|Tax agent fees — prior year invoice|Invoice from tax agent for prior year return preparation.|true||32|550
25|Deductions|Work-related assets purchased|Receipts for assets purchased for work use (e.g., tools, equipment).|false|WORK_ASSETS|33|560
26|Property|Rental income statement|Annual rental income statement from property manager or directly.|false|RENTAL|13|600
27|Property|Property depreciation schedule|Quantity surveyor depreciation schedule for rental property.|false|RENTAL|14|610
28|Super|Superannuation annual statement|Annual statement from super fund showing contributions and balance.|false|SUPER|17|700
29|Super|Super contribution notice (s290-170)|Notice of intent to claim personal super contributions as a deduction.|false|SUPER|18|710
30|Health|Private health insurance statement|Annual private health insurance tax statement from insurer.|false|HEALTH|19|800
31|Government|ATO notice / assessment|Any ATO correspondence or previous year notice of assessment.|false|ATO|15|900
32|Government|HECS-HELP / StudyAssist statement|ATO or MyGov HECS-HELP loan balance statement.|false|HECS|16|910
"""

# Checklist answers (id | section | name | description | format | sort order).
CHECKLIST_ANSWERS = """
100|Profile|Do you have a MyGov account?|Most ATO mail now goes to myGov inbox.|YES_NO|1000
101|Profile|Are you a foreign resident or working holiday maker?||YES_NO|1010
110|Work From Home|Total hours worked from home during the year|Required for Fixed Rate Method @ 70c/hr.|NUMERIC|1100
111|Work From Home|Internet plan monthly cost ($)|For Actual Cost Method.|NUMERIC|1110
112|Work From Home|Internet work-use percentage (%)|For Actual Cost Method.|NUMERIC|1120
113|Work From Home|Mobile phone monthly cost ($)|For Actual Cost Method.|NUMERIC|1130
114|Work From Home|Mobile phone work-use percentage (%)|For Actual Cost Method.|NUMERIC|1140
120|Motor Vehicle|Odometer reading as at 01/07/2024||NUMERIC|1200
121|Motor Vehicle|Odometer reading as at 30/06/2025||NUMERIC|1210
122|Motor Vehicle|Total work-related kilometres||NUMERIC|1220
123|Motor Vehicle|Is it a zero-emission electric vehicle?||YES_NO|1230
124|Motor Vehicle|Is it a plug-in hybrid electric vehicle?||YES_NO|1240
130|Self-Education|Total study hours during the year||NUMERIC|1300
140|Financial|Did you pay child support this year?||YES_NO|1400
141|Financial|Child support amount paid ($)||NUMERIC|1410
142|Financial|Spouse taxable income ($)|Only required if your spouse's return is not prepared by the same agent.|NUMERIC|1420
150|Medicare|Eligible for Medicare levy exemption (part or full year)?||YES_NO|1500
160|Health|Is health insurance policy extras-only cover?|Extras-only policies do not attract the Medicare Levy Surcharge offset.|YES_NO|1600
170|Estate|Have you appointed a Power of Attorney (POA)?||YES_NO|1700
171|Estate|Have you nominated a beneficiary for life insurance?||YES_NO|1710
172|Estate|Have you chosen an Executor?||YES_NO|1720
"""

# Order in which the questionnaire shows its sections.
SECTION_ORDER = ("Income", "Deductions", "Property", "Super", "Health", "Government")

# The two categories the utility views keep.
UTILITY_CATEGORIES = ("Work From Home — Electricity/Gas", "Work From Home — Internet")

# Category given to a document nothing else fits.
DEFAULT_CATEGORY = "Invoice / Receipt — Other"
FOLDER_DEFAULT_CATEGORY = "Other"

# Category -> archive path for the document path.
DOCUMENT_PATHS = """
Payment Summary / Group Certificate|income/payslips
Bank Interest Statement|income/interest
Dividend Statement|income/dividends
Share Sale / CGT Event|investments
Work From Home — Internet|deductions/work-related
Work From Home — Electricity/Gas|deductions/work-related
Work From Home — Insurance|deductions/insurance
Technology Equipment|deductions/work-related
Software & Subscriptions|deductions/work-related
Professional Development|deductions/work-related
Professional Memberships|deductions/work-related
Income Protection Insurance|deductions/insurance
Rental Income Statement|investments
Property Depreciation Schedule|investments
ATO Notice / Assessment|government
HECS/HELP Statement|government
Superannuation Statement|super
Super Contribution Notice|super
Private Health Insurance Statement|health
Invoice / Receipt — Other|receipts-and-bills/other
"""
DOCUMENT_DEFAULT_PATH = "receipts-and-bills/other"

# Category -> archive path for the drop-folder path, and its vocabulary.
FOLDER_PATHS = """
Payment Summary / Income Statement|01-income/payslips
Bank Interest|01-income/bank-interest
Dividends|01-income/dividends
Share Trade / CGT Event|03-investments/cgt-events
Work From Home — Electricity/Gas|02-deductions/work-from-home/utilities
Work From Home — Internet|02-deductions/work-from-home/internet
Technology Equipment|02-deductions/technology
Software & Subscriptions|02-deductions/technology
Professional Development|02-deductions/professional-dev
Income Protection Insurance|02-deductions/insurance
ATO Notice / Assessment|06-government/ato-notices
HECS-HELP|06-government/hecs-help
Superannuation|04-superannuation
Private Health Insurance|05-health
Rental Income|07-property
Property Depreciation|07-property
Utility Bill|08-receipts-bills/utilities
Motor Vehicle / Logbook|02-deductions/motor-vehicle
Donations|02-deductions/donations
Tax Agent Fees|02-deductions/tax-agent-fees
Work-Related Assets|02-deductions/work-assets
Other|08-receipts-bills/other
"""
FOLDER_DEFAULT_PATH = "08-receipts-bills/other"

# Slug vocabulary of the folder layout -> archive path.
SLUG_PATHS = """
payslip|01-income/payslips
bank-interest|01-income/bank-interest
dividend|01-income/dividends
share-trade|03-investments/share-trades
cgt-event|03-investments/cgt-events
work-from-home-utility|02-deductions/work-from-home/utilities
work-from-home-internet|02-deductions/work-from-home/internet
technology-receipt|02-deductions/technology
professional-development|02-deductions/professional-dev
insurance-income-protection|02-deductions/insurance
ato-notice|06-government/ato-notices
hecs-help|06-government/hecs-help
superannuation|04-superannuation
health-insurance|05-health
property-income|07-property
property-depreciation|07-property
utility-bill|08-receipts-bills/utilities
insurance-other|08-receipts-bills/insurance
bank-statement|09-bank-statements
other|08-receipts-bills/other
"""

# Our own table: folder vocabulary name -> seeded category name, for names that differ.
CATEGORY_ALIASES = """
Payment Summary / Income Statement|Payment Summary / Group Certificate
Bank Interest|Bank Interest Statement
Dividends|Dividend Statement
Share Trade / CGT Event|Share Sale / CGT Event
HECS-HELP|HECS/HELP Statement
Superannuation|Superannuation Statement
Private Health Insurance|Private Health Insurance Statement
Rental Income|Rental Income Statement
Property Depreciation|Property Depreciation Schedule
Utility Bill|Work From Home — Electricity/Gas
Other|Invoice / Receipt — Other
"""

# Words a mail search asks for.
MAIL_KEYWORDS = (
    "invoice",
    "statement",
    "receipt",
    "tax",
    "ATO",
    "deduction",
    "interest",
    "dividend",
    "insurance",
    "payslip",
    "group certificate",
    "HECS",
    "superannuation",
    "depreciation",
)

# File extensions a drop folder accepts.
STAGING_EXTENSIONS = ("pdf", "png", "jpg", "jpeg", "tiff", "docx")


def rows_of(block: str) -> list[list[str | None]]:
    """Lines of a text block as lists of fields; an empty field is ``None``."""
    return [
        [field or None for field in line.split("|")] for line in block.strip("\n").splitlines()
    ]


def path_map(block: str) -> dict[str, str]:
    return {name: path for name, path in rows_of(block)}


def sql_text(value: str | None) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def inline(spark: SparkSession, rows: list[list[str | None]], schema: str) -> DataFrame:
    """Text rows as an inline relation cast to ``schema`` (``name TYPE, ...``)."""
    fields = [field.strip().split(" ", 1) for field in schema.split(", ")]
    values = ", ".join("(" + ", ".join(sql_text(v) for v in row) + ")" for row in rows)
    names = ", ".join(name for name, _ in fields)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")


def fy_periods(
    spark: SparkSession, first: int = FIRST_FY, last: int = LAST_FY, current: int = CURRENT_FY
) -> DataFrame:
    """Financial years by rule: 1 July to 30 June, lodged by 31 October."""
    rows = [
        [
            str(y),
            f"FY{y}",
            f"{y - 1}-07-01",
            f"{y}-06-30",
            f"{y}-10-31",
            str(y == current).lower(),
        ]
        for y in range(first, last + 1)
    ]
    return inline(
        spark,
        rows,
        "fy_year SMALLINT, fy_label STRING, start_date DATE, end_date DATE, "
        "lodgement_deadline DATE, is_current BOOLEAN",
    )


def tax_categories(spark: SparkSession, base_only: bool = False) -> DataFrame:
    """All 33 categories, or the 20 of the first seed."""
    rows = rows_of(TAX_CATEGORIES)
    return inline(
        spark,
        rows[:20] if base_only else rows,
        "category_id INT, category_nme STRING, category_grp STRING, description STRING, "
        "is_deductible BOOLEAN, ato_reference STRING, sort_order INT",
    )


def transaction_categories(spark: SparkSession) -> DataFrame:
    return inline(
        spark,
        rows_of(TRANSACTION_CATEGORIES),
        "category_id INT, category_nme STRING, subcategory_nme STRING, is_income BOOLEAN, "
        "is_tax_relevant BOOLEAN, is_deductible BOOLEAN, sort_order INT",
    )


def statement_providers(spark: SparkSession) -> DataFrame:
    return inline(
        spark,
        rows_of(STATEMENT_PROVIDERS),
        "provider_id INT, provider_nme STRING, date_col STRING, date_format STRING, "
        "amount_col STRING, debit_col STRING, credit_col STRING, description_col STRING, "
        "balance_col STRING, skip_rows INT",
    )


def accounts(spark: SparkSession) -> DataFrame:
    return inline(
        spark,
        rows_of(ACCOUNTS),
        "account_id INT, account_nme STRING, provider STRING, account_type STRING, "
        "currency STRING, is_active BOOLEAN, csv_provider_id INT",
    )


def checklist_items(spark: SparkSession) -> DataFrame:
    """32 document items and 21 answer items."""
    questions = {group: question for group, question in rows_of(CHECKLIST_QUESTIONS)}
    documents = [
        [i, section, name, about, "DOCUMENT", required, group, questions.get(group), category,
         None, order]
        for i, section, name, about, required, group, category, order in rows_of(
            CHECKLIST_DOCUMENTS
        )
    ]
    answers = [
        [i, section, name, about, "RESPONSE", "false", None, None, None, kind, order]
        for i, section, name, about, kind, order in rows_of(CHECKLIST_ANSWERS)
    ]
    return inline(
        spark,
        documents + answers,
        "item_id INT, section STRING, item_name STRING, description STRING, item_type STRING, "
        "always_required BOOLEAN, applicability_group STRING, applicability_question STRING, "
        "category_id INT, response_format STRING, sort_order INT",
    ).withColumn("active", F.lit(True))


def checklist_responses(spark: SparkSession, fy_year: int = CURRENT_FY) -> DataFrame:
    """One unanswered response per item for a financial year."""
    return checklist_items(spark).select(
        "item_id",
        F.lit(fy_year).cast("smallint").alias("fy_year"),
        F.lit("UNKNOWN").alias("is_applicable"),
        F.lit(None).cast("string").alias("response_value"),
        F.lit(None).cast("timestamp").alias("responded_at"),
        F.lit("SYSTEM").alias("source"),
    )


def category_aliases(spark: SparkSession) -> DataFrame:
    return inline(spark, rows_of(CATEGORY_ALIASES), "alias STRING, category_nme STRING")
