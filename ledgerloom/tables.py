"""Dimension tables: fixed code lists, word lists that decide results, and a small rule seed.

The large brand list is an input table (``sources.tables.read_rules``); ``SEED_RULES`` is a
short list of our own for tests and first runs.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# --- fixed values: category codes -------------------------------------------

TAXONOMY = [
    ("EXP-001", "ATM Withdrawals"), ("EXP-002", "Automotive"), ("EXP-003", "Cash Advances"),
    ("EXP-004", "Childrens Retail and Gaming"), ("EXP-005", "Collection Agencies"),
    ("EXP-006", "Debt Interest Accrual"), ("EXP-007", "Department Stores"),
    ("EXP-008", "Dining Out"), ("EXP-009", "Dishonours"), ("EXP-010", "Donations"),
    ("EXP-011", "Education and Childcare"), ("EXP-012", "Entertainment"),
    ("EXP-013", "External Transfers"), ("EXP-014", "Gambling"),
    ("EXP-015", "Government & Council Services"), ("EXP-016", "Groceries"),
    ("EXP-017", "Gyms and memberships"), ("EXP-018", "Medical"),
    ("EXP-019", "Home Improvement"), ("EXP-020", "Insolvency"), ("EXP-021", "Insurance"),
    ("EXP-023", "Motor Finance"), ("EXP-024", "Online Retail"), ("EXP-025", "Other Finance"),
    ("EXP-026", "Peer to Peer Finance"), ("EXP-027", "Personal Care"), ("EXP-028", "Pet Care"),
    ("EXP-029", "Redraws"), ("EXP-030", "Rent"), ("EXP-031", "Retail"),
    ("EXP-032", "Returns & Refunds"), ("EXP-033", "Small Amount Lending"),
    ("EXP-034", "Superannuation"), ("EXP-035", "Subscription Media & Software"),
    ("EXP-036", "Telecommunication"), ("EXP-038", "Travel"), ("EXP-039", "Uncategorised Debits"),
    ("EXP-040", "Utilities"), ("EXP-041", "Vehicle and Transport"),
    ("EXP-043", "Charities and Donations"), ("EXP-051", "Alcohol and Tobacco"),
    ("EXP-052", "Sports and Hobbies"), ("EXP-054", "Other Categorised"),
    ("EXP-055", "Clothing and Footwear"), ("EXP-056", "Mortgage Repayments"),
    ("EXP-057", "Loan Repayments"), ("EXP-058", "Mortgage Transfers"),
    ("EXP-061", "Credit Card Repayments"), ("EXP-062", "Credit Card Transfers"),
    ("EXP-063", "Loan Transfers"),
    ("INC-001", "Benefits"), ("INC-002", "Child Support Income"), ("INC-003", "Insurance Credits"),
    ("INC-004", "Interest Income"), ("INC-005", "Investment Income"), ("INC-006", "Other Earnings"),
    ("INC-007", "Other Credits"), ("INC-008", "Rent & Board Income"), ("INC-009", "Salary"),
    ("INC-010", "Superannuation Credits"), ("INC-011", "Family Tax Benefit & Centrelink Payments"),
    ("INC-012", "Youth Allowance"), ("INC-013", "Rental Assistance"), ("INC-014", "Centrelink"),
    ("INC-015", "Medicare"), ("INC-016", "Jobseeker"), ("INC-018", "Pension"), ("INC-019", "Carers"),
    ("INC-020", "Education"), ("INC-021", "Crisis Support"),
    ("EXP-064", "Crypto Exchange"), ("EXP-065", "Dishonour Refunds"), ("OTH-001", "Notification"),
]

REQUIRED_CODES = ["EXP-034", "EXP-035", "EXP-039", "EXP-061", "INC-007"]

# --- fixed values: expense classes ------------------------------------------

CLASSES = {
    "non_discretionary": [
        "EXP-016", "EXP-036", "EXP-040", "EXP-030", "EXP-056", "EXP-018", "EXP-011",
        "EXP-021", "EXP-041", "EXP-002", "EXP-015"],
    "discretionary": [
        "EXP-008", "EXP-012", "EXP-014", "EXP-017", "EXP-027", "EXP-031", "EXP-051",
        "EXP-052", "EXP-038", "EXP-035", "EXP-055", "EXP-007", "EXP-024", "EXP-010",
        "EXP-043", "EXP-019", "EXP-028", "EXP-004"],
    "other_expenses": [
        "EXP-001", "EXP-003", "EXP-005", "EXP-006", "EXP-009", "EXP-013", "EXP-020",
        "EXP-023", "EXP-025", "EXP-026", "EXP-029", "EXP-032", "EXP-033", "EXP-034",
        "EXP-039", "EXP-054", "EXP-057", "EXP-058", "EXP-061", "EXP-062", "EXP-063",
        "EXP-064", "EXP-065"],
    "liabilities": ["EXP-056", "EXP-057", "EXP-061", "EXP-023", "EXP-033"],
    "high_cost_lenders": ["EXP-025", "EXP-026", "EXP-033"],
    "lender_categories": [
        "EXP-023", "EXP-025", "EXP-026", "EXP-033", "EXP-056", "EXP-057", "EXP-061"],
}

# --- fixed values: metric ids, names, types ---------------------------------

METRIC_DEFS = [
    ("ME001", "# of identified salary sources", "integer"),
    ("ME002", "Average monthly amount from salary", "money"),
    ("ME003", "Salary has been stable for (months)", "integer"),
    ("ME004", "Other possible income monthly", "money"),
    ("ME005", "Youth Allowance monthly", "money"),
    ("ME006", "Rental Assistance monthly", "money"),
    ("ME007", "Misc Government services monthly", "money"),
    ("ME008", "Average monthly amount to lenders", "money"),
    ("ME009", "# of identified lending companies", "integer"),
    ("ME010", "Total credit card limit", "money"),
    ("ME011", "Total credit card balance", "money"),
    ("ME012", "Monthly spend on non-discretionary expenses", "money"),
    ("ME013", "% of spend on non-discretionary expenses", "percent"),
    ("ME014", "Monthly spend on discretionary expenses", "money"),
    ("ME015", "% of spend on discretionary expenses", "percent"),
    ("ME016", "Monthly spend on other expenses", "money"),
    ("ME017", "# of SACC loans", "integer"),
    ("ME018", "% of income withdrawn via ATM", "percent"),
    ("ME019", "# of financial dishonours", "integer"),
    ("ME020", "% of income spent on High Risk Activities", "percent"),
    ("ME021", "Total spend on High Risk Activities", "money"),
    ("ME022", "Has recent changes to salary circumstances", "boolean"),
    ("ME023", "Has received crisis support payments", "boolean"),
    ("ME024", "Has superannuation credits", "boolean"),
    ("ME025", "Has cash advances", "boolean"),
    ("ME026", "Has redraws", "boolean"),
    ("ME027", "Has High-Cost Finance", "boolean"),
    ("ME028", "Missing non-discretionary expenses: groceries", "boolean"),
    ("ME029", "Missing non-discretionary expenses: telecommunication", "boolean"),
    ("ME030", "Missing non-discretionary expenses: utilities", "boolean"),
    ("ME031", "Has Unemployment Benefit", "boolean"),
    ("ME032", "Receives Child Support", "boolean"),
    ("ME033", "Average Income monthly (salary only)", "money"),
    ("ME034", "Average Outgoings monthly", "money"),
    ("ME035", "Total Income has been stable for (months)", "integer"),
    ("ME036", "Median monthly amount from Salary", "money"),
    ("ME037", "Median Income monthly (salary only)", "money"),
    ("ME039", "Average outgoings excluding liabilities", "money"),
    ("ME040", "Average Monthly Credits", "money"),
    ("ME041", "Average Monthly Debits", "money"),
    ("ME042", "# of recent income sources", "integer"),
    ("ME043", "# of ongoing regular income sources", "integer"),
    ("ME045", "Total Income has been secure for (months)", "integer"),
    ("ME046", "Average monthly ongoing amount to lenders", "money"),
    ("ME047", "Has unshared mortgage account", "boolean"),
    ("ME048", "Ongoing Monthly Mortgage Repayment", "money"),
]

# --- fixed values: income words (whole words, in this order) -----------------

INCOME_GROUPS = [
    ("INC-009", 0.99, "Salary keyword", [
        "wage", "wages", "salary", "salaries", "pay from", "payment from", "payroll",
        "fortnightly pay", "weekly pay", "monthly pay", "net pay", "gross pay",
        "employer payment", "employment income"]),
    ("INC-012", 0.99, "Benefit keyword", ["youth allowance", "austudy", "abstudy"]),
    ("INC-014", 0.99, "Benefit keyword", [
        "centrelink", "services australia", "family tax benefit", "ftb",
        "parenting payment", "carer payment"]),
    ("INC-016", 0.99, "Benefit keyword", ["jobseeker", "newstart", "job seeker"]),
    ("INC-017", 0.99, "Benefit keyword", ["age pension", "aged pension"]),
    ("INC-018", 0.99, "Benefit keyword", ["disability support", "dsp", "disability pension"]),
    ("EXP-032", 0.98, "Refund keyword", [
        "refund", "return", "reversal", "reversed", "credit adjustment", "chargeback",
        "reimbursement", "rebate"]),
    ("INC-001", 0.98, "Income keyword", [
        "invoice payment", "client payment", "payment received", "stripe transfer",
        "paypal transfer", "square deposit", "eftpos settlement"]),
    ("INC-002", 0.98, "Income keyword", ["child support", "child maintenance"]),
    ("INC-005", 0.98, "Income keyword", [
        "dividend", "div payment", "stock dividend", "share dividend", "distribution"]),
    ("INC-008", 0.98, "Income keyword", ["rental income", "rent received", "property income"]),
    ("INC-010", 0.98, "Income keyword", [
        "super payment", "superannuation payment", "pension payment", "annuity"]),
    ("INC-013", 0.98, "Income keyword", [
        "interest credit", "interest received", "investment return", "bond payment"]),
    ("INC-015", 0.98, "Income keyword", [
        "medicare benefit", "mcare benefit", "health insurance rebate"]),
    ("INC-019", 0.98, "Income keyword", [
        "inheritance", "estate payment", "insurance payout", "settlement"]),
    ("INC-020", 0.98, "Income keyword", [
        "commission payment", "sales commission", "referral fee", "affiliate payment"]),
    ("INC-021", 0.98, "Income keyword", [
        "bonus payment", "performance bonus", "annual bonus", "incentive payment"]),
]

# --- fixed values: contextual rules ------------------------------------------
# (start words, words of which one must occur, second such list, words that must not occur,
#  code, confidence, reason). Plain substrings of the lower-cased text, first rule wins.

_SQUARE = ["^sq *", " sq *"]
_EZI = ["^ezi*", "^ezidebit"]
_ZLR = ["^zlr*"]
_ANY: list[str] = []

CONTEXT_RULES = [
    (_SQUARE, ["coffee", "cafe", "espresso", "barista"], _ANY, _ANY,
     "EXP-008", 0.95, "Small business cafe (Square payment)"),
    (_SQUARE, ["bakery", "bread", "pastry"], _ANY, _ANY,
     "EXP-008", 0.95, "Small business bakery (Square payment)"),
    (_SQUARE, ["restaurant", "kitchen", "grill", "burger"], _ANY, _ANY,
     "EXP-008", 0.95, "Small business restaurant (Square payment)"),
    (_EZI, ["gym", "fitness"], _ANY, _ANY, "EXP-017", 0.95, "Gym membership (Ezidebit)"),
    (_EZI, ["ortho", "dental", "medical", "physio"], _ANY, _ANY,
     "EXP-018", 0.95, "Medical subscription (Ezidebit)"),
    (_ZLR, ["hotel", "motel", "inn", "resort"], _ANY, _ANY,
     "EXP-038", 0.95, "Accommodation (Zeller payment)"),
    (_ZLR, ["cafe", "coffee", "restaurant"], _ANY, _ANY, "EXP-008", 0.95, "Dining (Zeller payment)"),
    (_ANY, ["ortho", "orthodont", "dental", "dentist"], _ANY, _ANY,
     "EXP-018", 0.96, "Dental/orthodontic from description"),
    (_ANY, ["physio", "physiotherapy", "chiro", "osteo"], _ANY, _ANY,
     "EXP-018", 0.95, "Allied health from description"),
    (_ANY, ["medical centre", "medical center", "clinic", "doctor"], _ANY, _ANY,
     "EXP-018", 0.95, "Medical practice from description"),
    (_ANY, [" uni ", "university", "tafe", "college"], ["fee", "payment", "tuition"], _ANY,
     "EXP-011", 0.97, "University/education fees"),
    (_ANY, ["childcare", "child care", "kindergarten", "kindy", "preschool"], _ANY, _ANY,
     "EXP-011", 0.96, "Childcare from description"),
    (_ANY, ["hotel", "motel", "inn", "resort", "accommodation"], _ANY, ["bottle"],
     "EXP-038", 0.95, "Accommodation from description"),
    (_ANY, ["real estate", "realestate", "property manag"], _ANY, _ANY,
     "EXP-030", 0.96, "Rent payment to real estate agent"),
    (_ANY, ["warehouse"], ["chemist", "pharmacy"], _ANY, "EXP-018", 0.97, "Chemist Warehouse"),
    (_ANY, ["warehouse"], ["pet", "animal"], _ANY, "EXP-028", 0.96, "Pet warehouse"),
    (_ANY, ["warehouse"], ["kitchen", "home"], _ANY, "EXP-019", 0.95, "Home/kitchen warehouse"),
    (_ANY, ["warehouse"], _ANY, _ANY, "EXP-031", 0.93, "Warehouse retail store"),
    (_ANY, ["council", "shire", "city of"], _ANY, _ANY, "EXP-015", 0.96, "Council rates/fees"),
    (_ANY, ["vicroads", "rta nsw", "service nsw", "qld transport"], _ANY, _ANY,
     "EXP-015", 0.97, "State government service"),
    (_ANY, ["interest charge", "debit interest", "interest fee"], _ANY, _ANY,
     "EXP-006", 0.96, "Bank interest charge"),
]

# (words, code, confidence, what was matched)
CONTEXT_WORDS = [
    (["woolworths", "coles", "aldi"], "EXP-016", 0.97, "supermarket"),
    (["dan murphy", "bws", "liquorland", "first choice liquor"], "EXP-051", 0.98, "alcohol retailer"),
    (["commonwealth bank", "commbank", "cba "], "EXP-056", 0.98, "CBA mortgage/loan"),
    (["westpac "], "EXP-056", 0.98, "Westpac mortgage/loan"),
    (["anz bank", "anz australia", " anz "], "EXP-056", 0.98, "ANZ mortgage/loan"),
    (["macquarie bank", "macquarie "], "EXP-056", 0.97, "Macquarie Bank"),
    (["ing bank", "ing direct"], "EXP-056", 0.97, "ING Bank"),
    (["bankwest"], "EXP-056", 0.97, "Bankwest"),
    (["st george bank", "st.george"], "EXP-056", 0.97, "St George Bank"),
    (["bank of melbourne"], "EXP-056", 0.97, "Bank of Melbourne"),
    (["bank of queensland", " boq "], "EXP-056", 0.97, "Bank of Queensland"),
    (["suncorp bank"], "EXP-056", 0.96, "Suncorp Bank"),
    (["amp bank"], "EXP-056", 0.96, "AMP Bank"),
    (["bendigo bank"], "EXP-056", 0.96, "Bendigo Bank"),
    (["latitude", "latitude financial"], "EXP-057", 0.96, "Latitude Financial"),
    (["pepper money"], "EXP-057", 0.96, "Pepper Money"),
    (["wisr "], "EXP-057", 0.95, "Wisr loans"),
    (["harmoney"], "EXP-057", 0.95, "Harmoney loans"),
    (["plenti"], "EXP-057", 0.95, "Plenti loans"),
    (["ray white"], "EXP-030", 0.98, "Ray White real estate"),
    (["lj hooker"], "EXP-030", 0.98, "LJ Hooker real estate"),
    (["century 21"], "EXP-030", 0.97, "Century 21 real estate"),
    (["harcourts"], "EXP-030", 0.97, "Harcourts real estate"),
    (["mcgrath"], "EXP-030", 0.97, "McGrath real estate"),
    (["belle property"], "EXP-030", 0.97, "Belle Property"),
    (["first national real"], "EXP-030", 0.96, "First National real estate"),
    (["prd nationwide", "prd real"], "EXP-030", 0.96, "PRD Nationwide"),
    (["jellis craig"], "EXP-030", 0.96, "Jellis Craig"),
    (["barry plant"], "EXP-030", 0.96, "Barry Plant real estate"),
    (["goodstart"], "EXP-011", 0.97, "Goodstart Early Learning"),
    (["g8 education"], "EXP-011", 0.97, "G8 Education childcare"),
    (["ku children", "ku childcare"], "EXP-011", 0.97, "KU childcare"),
    (["guardian childcare"], "EXP-011", 0.96, "Guardian Childcare"),
    (["affinity education"], "EXP-011", 0.96, "Affinity Education"),
    (["myki", "opal card", "go card"], "EXP-041", 0.98, "public transport card"),
    (["caltex", "shell", "bp", "7-eleven", "ampol", "better choice", "united petroleum", "liberty"],
     "EXP-041", 0.96, "fuel station"),
    (["momentum energy", "origin energy", "agl", "red energy"], "EXP-040", 0.98, "energy provider"),
    (["bupa", "medibank", "hcf", "nib"], "EXP-021", 0.97, "health insurance"),
    (["insurance"], "EXP-021", 0.92, "insurance payment"),
    (["tax office", "ato", "bpay tax"], "EXP-015", 0.98, "tax payment"),
    (["council", "rates", "monash council"], "EXP-015", 0.96, "council rates"),
    (["medicare", "mcare"], "INC-015", 0.97, "medicare rebate"),
    (["nab cards", "credit card", "amex", "visa payment"], "EXP-061", 0.96, "credit card repayment"),
    (["pay/salary", "salary", "wages", "payroll"], "INC-009", 0.98, "salary payment"),
    (["credit interest", "interest paid"], "INC-004", 0.99, "interest income"),
    (["netflix", "spotify", "disney", "stan", "hulu", "amazon prime"],
     "EXP-035", 0.97, "streaming subscription"),
    (["kfc", "mcdonalds", "hungry jacks", "subway", "pizza"], "EXP-008", 0.95, "fast food"),
    (["restaurant", "cafe", "coffee"], "EXP-008", 0.90, "dining"),
    (["unloan", "mortgage", "home loan"], "EXP-056", 0.96, "mortgage payment"),
    (["amazon", "ebay", "target", "kmart", "big w"], "EXP-031", 0.93, "retail"),
    (["telstra", "optus", "vodafone", "tpg"], "EXP-036", 0.96, "telecommunications"),
]

UTILITY_WORDS = ["energy", "electricity", "gas", "water", "power"]
UTILITY_RESULT = ("EXP-040", 0.95, "Matched utility company from description")

TRUSTED_HINTS = [
    ("Utilities", "EXP-040", 0.92, "Utilities"),
    ("Insurance", "EXP-021", 0.92, "Insurance"),
    ("Tax", "EXP-015", 0.92, "Tax"),
    ("Credit Card Repayments", "EXP-061", 0.92, "Credit Card"),
    ("Wages", "INC-009", 0.93, "Wages"),
    ("Health", "EXP-018", 0.90, "Health/Medical"),
    ("Medicare", "INC-015", 0.93, "Medicare"),
    ("Groceries", "EXP-016", 0.91, "Groceries"),
    ("Government and Council Services", "EXP-015", 0.92, "Government"),
]

# --- fixed values: provider category names and their codes, in order ----------

CATEGORY_NAMES = [
    ("Wages", "INC-009"), ("Salary", "INC-009"), ("Other Income", "INC-007"),
    ("All Other Credits", "INC-007"), ("Earned Interest", "INC-004"), ("Interest", "INC-004"),
    ("Medicare", "INC-015"), ("Benefits", "INC-001"), ("Centrelink", "INC-014"),
    ("Pension", "INC-018"), ("Internal Transfer", "EXP-013"), ("External Transfers", "EXP-013"),
    ("Transfer", "EXP-013"), ("Groceries", "EXP-016"), ("Supermarket", "EXP-016"),
    ("Dining Out", "EXP-008"), ("Restaurants", "EXP-008"), ("Utilities", "EXP-040"),
    ("Insurance", "EXP-021"), ("Health", "EXP-018"), ("Medical", "EXP-018"),
    ("Transport", "EXP-041"), ("Fuel", "EXP-041"), ("Automotive", "EXP-002"),
    ("Entertainment", "EXP-012"), ("Shopping", "EXP-031"), ("Retail", "EXP-031"),
    ("Online Retail", "EXP-024"), ("Online Retail and Subscription Services", "EXP-035"),
    ("Education", "EXP-011"), ("Travel", "EXP-038"), ("Home", "EXP-019"),
    ("Home Improvement", "EXP-019"), ("Rent", "EXP-030"), ("Mortgage", "EXP-056"),
    ("Mortgage Repayments", "EXP-056"), ("Loan Repayments", "EXP-057"), ("Cash", "EXP-007"),
    ("ATM", "EXP-001"), ("Subscription", "EXP-035"), ("Subscriptions", "EXP-035"),
    ("Fees", "EXP-015"), ("Bank Fees", "EXP-015"), ("Tax", "EXP-015"),
    ("Government and Council Services", "EXP-015"), ("Council Rates", "EXP-015"),
    ("Charity", "EXP-010"), ("Donations", "EXP-010"), ("Clothing", "EXP-055"),
    ("Fashion", "EXP-055"), ("Sports", "EXP-052"), ("Fitness", "EXP-017"),
    ("Gambling", "EXP-014"), ("Betting", "EXP-014"), ("Alcohol", "EXP-051"),
    ("Liquor", "EXP-051"), ("Tobacco", "EXP-051"), ("Phone", "EXP-036"),
    ("Telecommunications", "EXP-036"), ("Internet", "EXP-036"), ("Pet", "EXP-028"),
    ("Pets", "EXP-028"), ("Pet Care", "EXP-028"), ("Personal Care", "EXP-027"),
    ("Credit Card Repayments", "EXP-061"), ("Credit Card", "EXP-061"),
]

# --- our own rule seed ---------------------------------------------------------
# (keywords, code, confidence, reason); whole words, first rule wins.

SEED_RULES = [
    (["cash machine", "atm"], "EXP-001", 0.97, "cash machine"),
    (["cash advance"], "EXP-003", 0.98, "cash advance"),
    (["dishonour fee", "overdrawn fee", "honour fee", "overdraft fee"], "EXP-009", 0.99, "dishonour"),
    (["woolworths", "coles", "aldi", "iga"], "EXP-016", 0.98, "supermarket"),
    (["café", "cafe", "bakery", "sushi"], "EXP-008", 0.92, "eating out"),
    (["ray white", "real estate"], "EXP-030", 0.95, "rent"),
    (["netflix", "netflix.com", "spotify"], "EXP-035", 0.97, "streaming"),
    (["disney+"], "EXP-035", 0.97, "streaming plus"),
    (["telstra", "optus", "vodafone"], "EXP-036", 0.96, "phone"),
    (["origin energy", "red energy"], "EXP-040", 0.97, "energy"),
    (["sportsbet", "tab bet"], "EXP-014", 0.98, "betting"),
    (["wallet wizard", "afterpay"], "EXP-033", 0.96, "small loan"),
    (["home loan", "mortgage"], "EXP-056", 0.95, "mortgage"),
    (["car finance"], "EXP-023", 0.94, "car loan"),
    (["kmart", "big w"], "EXP-031", 0.93, "retail"),
    (["zara", "uniqlo"], "EXP-055", 0.93, "clothes"),
    (["services australia", "centrelink"], "EXP-015", 0.90, "government agency"),
    (["superannuation", "aware super"], "EXP-034", 0.95, "super"),
    (["loan redraw", "redraw"], "EXP-029", 0.95, "redraw"),
    (["medicare", "mcare"], "INC-015", 0.97, "medicare"),
    (["credit interest"], "INC-004", 0.97, "interest"),
    (["widgets"], "EXP-054", 0.75, "weak word"),
    (["branch"], "EXP-039", 0.85, "branch counter"),
    (["jobseeker"], "INC-016", 0.95, "jobseeker"),
    (["youth allowance"], "INC-012", 0.95, "youth allowance"),
    (["redraw", "iga"], "EXP-063", 0.90, "shadowed words"),
]


def rules_rows(rules=None) -> list[tuple]:
    """(seq, rule_seq, keyword, code, confidence, reason), one row per keyword in match order."""
    rows, seq = [], 0
    for rule_seq, (keywords, code, confidence, reason) in enumerate(rules or SEED_RULES):
        for keyword in keywords:
            rows.append((seq, rule_seq, keyword, code, confidence, reason))
            seq += 1
    return rows


def income_rows() -> list[tuple]:
    rows, seq = [], 0
    for rule_seq, (code, confidence, kind, keywords) in enumerate(INCOME_GROUPS):
        for keyword in keywords:
            rows.append((seq, rule_seq, keyword, code, confidence, f"{kind}: {keyword}"))
            seq += 1
    return rows


RULE_FIELDS = [("seq", pa.int32()), ("rule_seq", pa.int32()), ("keyword", pa.string()),
               ("code", pa.string()), ("confidence", pa.float64()), ("reason", pa.string())]


def frame(spark: SparkSession, fields, rows) -> DataFrame:
    """A small local table; its size is known to the optimizer."""
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return spark.createDataFrame(pa.table(
        {n: pa.array(list(c), t) for (n, t), c in zip(fields, columns)}))


def _strings(*names):
    return [(n, pa.string()) for n in names]


def taxonomy(spark: SparkSession) -> DataFrame:
    return frame(spark, _strings("code", "name", "kind"),
                 [(c, n, c.split("-")[0]) for c, n in TAXONOMY])


def category_class(spark: SparkSession) -> DataFrame:
    return frame(spark, _strings("code", "class"),
                 [(c, k) for k, codes in CLASSES.items() for c in codes])


def metric_def(spark: SparkSession) -> DataFrame:
    """SNK4: metric id, name and type."""
    return frame(spark, _strings("metric_id", "name", "type"), METRIC_DEFS)


def seed_rules(spark: SparkSession) -> DataFrame:
    return frame(spark, RULE_FIELDS, rules_rows())


def income_rules(spark: SparkSession) -> DataFrame:
    return frame(spark, RULE_FIELDS, income_rows())


def category_names(spark: SparkSession) -> DataFrame:
    return frame(spark, [("seq", pa.int32())] + _strings("name", "code"),
                 [(i, n, c) for i, (n, c) in enumerate(CATEGORY_NAMES)])
