"""Fixed values that the text functions need. Order is significant in every list."""

# --- fixed values: learning normaliser --------------------------------------

LEADING_PHRASES = [
    "payment to", "transfer to", "transfer from",
    "eftpos", "visa debit purchase card", "visa purchase",
    "direct debit", "direct credit", "card purchase",
    "atm withdrawal", "bpay", "paypal", "recurring payment",
    "pending -", "pending", "pay/salary from",
    "anz mobile banking payment", "anz internet banking payment",
    "anz m-banking funds tfer transfer", "internet banking",
    "mobile banking", "m-banking", "funds tfer transfer",
]

TRAILING_PHRASES = ["au", "pty ltd", "ltd", "pty", "australia"]

# Only single words: the text is compared word by word.
PLACE_WORDS = [
    "nsw", "vic", "qld", "wa", "sa", "tas", "act", "nt",
    "victoria", "queensland", "tasmania",
    "sydney", "melbourne", "brisbane", "perth", "adelaide", "hobart",
    "darwin", "canberra", "newcastle", "wollongong",
    "geelong", "townsville", "cairns", "toowoomba", "ballarat",
    "bendigo", "albury", "launceston", "mackay", "rockhampton",
    "parramatta", "blacktown", "penrith", "bondi", "manly",
]

KNOWN_NAMES = [
    "momentum energy", "origin energy", "agl energy", "red energy",
    "uber eats", "menu log", "uber taxi",
    "tax office", "services australia", "medicare australia",
    "woolworths", "coles", "aldi", "iga",
]

# --- fixed values: payment-prefix stripper ----------------------------------

PAYMENT_PREFIXES = [
    r"PENDING\s*-\s*POS\s+AUTHORISATION\s+",
    r"PENDING\s*-\s*POS\s+PURCHASE\s+",
    r"PENDING\s*-\s*POS\s+",
    r"PENDING\s*-\s*VISA\s+",
    r"PENDING\s*-\s*",
    r"POS\s+AUTHORISATION\s+",
    r"POS\s+PURCHASE\s+",
    r"POS\s+",
    r"VISA\s+DEBIT\s+PURCHASE\s+CARD\s+\d+\s+",
    r"VISA\s+DEBIT\s+PURCHASE\s+",
    r"VISA\s+PURCHASE\s+",
    r"MASTERCARD\s+PURCHASE\s+",
    r"CARD\s+PURCHASE\s+",
    r"EFTPOS\s+\d+PIN\*\s+",
    r"EFTPOS\s+",
    r"ATM\s+WITHDRAWAL\s+",
    r"ATM\s+",
    r"DIRECT\s+DEBIT\s+",
    r"DD\s+",
    r"ANZ\s+INTERNET\s+BANKING\s+BPAY\s+",
    r"ANZ\s+MOBILE\s+BANKING\s+PAYMENT\s+\d+\s+TO\s+",
    r"ANZ\s+M-BANKING\s+FUNDS\s+TFER\s+TRANSFER\s+\d+\s+TO\s+",
    r"ANZ\s+INTERNET\s+BANKING\s+",
    r"ANZ\s+MOBILE\s+BANKING\s+",
    r"ANZ\s+M-BANKING\s+",
    r"BPAY\s+",
    r"PAY/SALARY\s+FROM\s+",
    r"SALARY\s+",
    r"CREDIT\s+INTEREST\s+PAID\s*",
    r"DEBIT\s+INTEREST\s+",
    r"TRANSFER\s+FROM\s+",
    r"TRANSFER\s+TO\s+",
    r"TRANSFER\s+",
]

NOISE = [r"\s+Card\s+Used\s+\d+", r"\s+AU$", r"\s+Card\s+\d+$"]

# Payment type: first entry with a fragment inside the removed prefix.
PREFIX_TYPES = [
    ("PENDING", ["pending"]),
    ("POS", ["pos"]),
    ("CARD", ["visa", "mastercard"]),
    ("EFTPOS", ["eftpos"]),
    ("ATM", ["atm"]),
    ("DIRECT_DEBIT", ["direct debit", "^dd"]),
    ("SALARY", ["salary", "pay/"]),
    ("INTEREST", ["interest"]),
    ("TRANSFER", ["transfer"]),
]

# --- fixed values: own-account transfers ------------------------------------

SPLIT_ACCOUNT = r"\b(\d{3})[- ]?(\d{6,9})\b"
DIRECTED_ACCOUNT = r"(?:TO|FROM)\s+(\d{6,9})\b"
NUMBERED_TRANSFER_ACCOUNT = r"TRANSFER\s+\d+\s+(?:TO|FROM)\s+(\d{6,9})"

TRANSFER_PHRASES = [
    "TFER", "TRANSFER", "FUNDS TFER", "M-BANKING FUNDS",
    "INTERNET BANKING PAYMENT", "MOBILE BANKING PAYMENT",
]

INTERNAL_HINTS = ["Internal Transfer", "Internal Transfer Credit", "Internal Transfer Debit"]
