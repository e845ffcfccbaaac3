"""Fixed values.

Everything in this module is a FIXED VALUE that must stay exactly as written
for silver and gold results to equal those of the source pipeline: synonym
maps (dirty spelling -> canonical value, case-sensitive, unknown values pass
through), the rejected post-code list, the valid interest-rate range and the
text tokens read as missing.  Keep them literal and in this order.
"""

from __future__ import annotations

# --- fixed values: synonym maps (dirty -> canonical) -------------------------

BRANCH_TYPE_MAP = {
    "flagship": "Flagship", "FLAGSHIP": "Flagship",
    "Flag-ship": "Flagship", "Flagshipp": "Flagship", "Premium": "Flagship",
    "counter": "Counter", "COUNTER": "Counter",
    "Counteer": "Counter", "Bank Counter": "Counter", "Desk": "Counter",
    "self service": "Self-Service", "SELF-SERVICE": "Self-Service",
    "SelfService": "Self-Service", "kiosk": "Self-Service", "Auto-Service": "Self-Service",
    "hub": "Hub", "HUB": "Hub",
    "Hubb": "Hub", "Central Hub": "Hub", "Branch Hub": "Hub",
    "pop-up": "Pop-Ups", "pop up": "Pop-Ups", "POP-UP": "Pop-Ups",
    "Popup": "Pop-Ups", "Popups": "Pop-Ups", "Event": "Pop-Ups",
    "post office": "Post Office Counters", "PO Counter": "Post Office Counters",
    "Post Office": "Post Office Counters", "PO": "Post Office Counters",
    "PostOffce": "Post Office Counters",
    "multi bank": "Multi-Bank", "MULTI-BANK": "Multi-Bank",
    "MultiBank": "Multi-Bank", "Shared Bank": "Multi-Bank", "Joint": "Multi-Bank",
}

GENDER_MAP = {
    "male": "Male", "MALE": "Male", "M": "Male", "m": "Male",
    "female": "Female", "FEMALE": "Female", "F": "Female", "f": "Female",
    "other": "Other", "OTHER": "Other", "O": "Other", "o": "Other",
}

KYC_STATUS_MAP = {
    "verified": "Verified", "VERIFIED": "Verified",
    "VErified": "Verified", "verify": "Verified",
    "pending": "Pending", "PENDING": "Pending",
    "pendinG": "Pending", "pend": "Pending",
}

CURRENCY_MAP = {
    "GBP": "GBP",
    "£": "GBP",
    "Sterling": "GBP",
    "GB Pound": "GBP",
}

PAYMENT_CHANNEL_MAP = {
    "FPS": "Faster Payments (FPS)", "Faster Payments": "Faster Payments (FPS)",
    "fps": "Faster Payments (FPS)", "FasterPayments": "Faster Payments (FPS)",
    "BACS": "Bacs Direct Debit", "BacsDirectDebit": "Bacs Direct Debit",
    "bacs": "Bacs Direct Debit", "Bacs_Direct_Debit": "Bacs Direct Debit",
    "Bacs": "Bacs Direct Debit",
    "Bacs Credit": "Bacs Direct Credit", "BACS Direct Credit": "Bacs Direct Credit",
    "Bacs_Credit": "Bacs Direct Credit", "bacs credit": "Bacs Direct Credit",
    "BacsCr": "Bacs Direct Credit",
    "chaps": "CHAPS", "CHAPS payment": "CHAPS", "CHAPS_Transfer": "CHAPS",
    "CHAPS Transfer": "CHAPS",
    "Contactless": "Debit Card (Contactless)", "Debit Contactless": "Debit Card (Contactless)",
    "contless": "Debit Card (Contactless)", "card-contactless": "Debit Card (Contactless)",
    "Chip & Pin": "Debit Card (Chip & PIN)", "Chip_and_Pin": "Debit Card (Chip & PIN)",
    "PIN Debit": "Debit Card (Chip & PIN)", "chipandpin": "Debit Card (Chip & PIN)",
    "Credit": "Credit Card", "CredCard": "Credit Card", "credit_card": "Credit Card",
    "CREDIT": "Credit Card",
    "Digital Wallet": "Digital Wallet (Apple/Google Pay)",
    "ApplePay": "Digital Wallet (Apple/Google Pay)",
    "GooglePay": "Digital Wallet (Apple/Google Pay)",
    "MobileWallet": "Digital Wallet (Apple/Google Pay)",
    "DigiWallet": "Digital Wallet (Apple/Google Pay)",
    "OpenBanking": "Open Banking / Pay-by-Bank", "PayByBank": "Open Banking / Pay-by-Bank",
    "Open_Banking": "Open Banking / Pay-by-Bank", "OB": "Open Banking / Pay-by-Bank",
    "ATM": "ATM Withdrawal", "atm": "ATM Withdrawal",
    "ATM_Withdrawal": "ATM Withdrawal", "CashMachine": "ATM Withdrawal",
    "SO": "Standing Order", "StandingOrder": "Standing Order",
    "standing_order": "Standing Order", "std order": "Standing Order",
    "cheq": "Cheque", "Cheque Payment": "Cheque", "cheque_payment": "Cheque", "CHK": "Cheque",
}

TRANSACTION_STATUS_MAP = {
    "SUCCESS": "Completed", "OK": "Completed",
    "Settled": "Completed", "Completed": "Completed", "done": "Completed",
    "DECLINED": "Failed", "REJECTED": "Failed", "Failed": "Failed", "ERR": "Failed",
}

LOAN_STATUS_MAP = {
    "paid off": "Paid off", "PAID": "Paid off",
    "Closed": "Paid off", "Settled": "Paid off", "Fully Paid": "Paid off",
    "active": "Active", "ACT": "Active",
    "In Progress": "Active", "Live": "Active", "Ongoing": "Active",
}

# --- fixed values: rejected post codes ---------------------------------------

INVALID_POSTCODES = [
    "BT1 1A",
    "B1234 567",
    "M9-9 ZZ",
    "G1 11A",
    "BS1A 1AA",
    "SA 1 1AA",
]

# --- fixed values: valid interest-rate range (closed interval) ---------------

RATE_MIN = 0.03
RATE_MAX = 0.30

# --- fixed values: payment-channel groups of the branch mart -----------------

CHANNEL_GROUPS = {
    "atm_count": ["ATM Withdrawal"],
    "digital_wallet_count": ["Digital Wallet (Apple/Google Pay)"],
    "online_count": [
        "Faster Payments (FPS)",
        "Open Banking / Pay-by-Bank",
        "Bacs Direct Credit",
        "Bacs Direct Debit",
    ],
    "card_count": [
        "Debit Card (Chip & PIN)",
        "Debit Card (Contactless)",
        "Credit Card",
    ],
    "chaps_count": ["CHAPS"],
    "standing_order_count": ["Standing Order"],
    "cheque_count": ["Cheque"],
}

# --- fixed values: text read as missing by the source CSV reader -------------
# (the default missing-value spellings of the pandas CSV reader)

NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def canonical_values(mapping: dict[str, str]) -> list[str]:
    """Distinct canonical targets of a synonym map, in first-seen order."""
    return list(dict.fromkeys(mapping.values()))
