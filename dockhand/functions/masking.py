"""Masking of documents and log lines; every rule is a native expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and replacements of the two document masks, applied
# in the order listed. ``(?U)`` makes \b, \d and \w follow Unicode.
DOCUMENT_MASK_A = [
    (r"(?U)\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b", "XXXX-XXXX-XXXX-XXXX"),
    (r"(?U)\b\d{3}-\d{2}-\d{4}\b", "XXX-XX-XXXX"),
    (r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "XXXX@XXXX.com"),
]
DOCUMENT_MASK_B = [
    (r"(?U)\b\d{3}-\d{2}-\d{4}\b", "[SSN]"),
    (r"(?U)\b\d{16}\b", "[CREDIT_CARD]"),
    (r"(?U)\b[\w\.-]+@[\w\.-]+\.\w{2,4}\b", "[EMAIL]"),
]

# What the six log rules look for.
LOG_IP = r"(?U)\b(?:\d{1,3}\.){3}\d{1,3}\b"
LOG_MAC = r"(?U)\b(?:[0-9a-fA-F]{2}:){5}[0-9a-fA-F]{2}\b"
LOG_PASSWORD = r"(?U)(?<=password=)[^\s]*"
LOG_EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,4}"
LOG_PHONE = r"(?U)\+?\d{1,3}[-.\s]?\(?\d{1,4}?\)?[-.\s]?\d{1,4}[-.\s]?\d{1,4}"
LOG_CARD = r"(?U)\b(?:\d{4}[-\s]?){3}\d{4}\b"

# What a rule changes inside its match.
PHONE_DIGITS = r"(?U)(\d{3})[-.\s]?(\d{3})[-.\s]?(\d{4})"
CARD_DIGITS = r"(?U)\d{12}(\d{4})"


# The log e-mail rule without retries inside a long run of address characters:
# a start in the middle of a run can only succeed where the last match ended.
_LOG_EMAIL_SCAN = r"(?:\G|(?<![a-zA-Z0-9._%+-]))" + LOG_EMAIL.replace("]+@", "]++@", 1)


def replace_each_match(
    text: Column, pattern: str, change: Callable[[Column], Column], needs: str | None = None
) -> Column:
    """Replace every match of ``pattern`` by ``change(match)``.

    The text is split at the matches and stitched together with the changed
    matches. Texts without ``needs`` (default: the pattern itself) cannot
    change and are passed through after one scan. The pattern must not match
    the empty string.
    """
    gaps = F.split(text, pattern, -1)
    changed = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), change)
    stitched = F.array_join(
        F.zip_with(gaps, changed, lambda gap, match: F.concat(gap, F.coalesce(match, F.lit("")))), ""
    )
    return F.when(text.rlike(needs or pattern), stitched).otherwise(text)


def mask_ip(text: Column) -> Column:
    """Every digit of an IPv4 address becomes ``x``; the length stays."""
    return replace_each_match(text, LOG_IP, lambda m: F.regexp_replace(m, r"(?U)\d", "x"))


def mask_mac(text: Column) -> Column:
    """Every hexadecimal digit of a MAC address becomes ``x``."""
    return replace_each_match(text, LOG_MAC, lambda m: F.regexp_replace(m, "[0-9a-fA-F]", "x"))


def mask_password(text: Column) -> Column:
    """The value after ``password=`` becomes ``****``, an empty value too."""
    return F.regexp_replace(text, LOG_PASSWORD, "****")


def mask_email_domain(text: Column) -> Column:
    """The first domain label of an e-mail address becomes ``****``."""
    return replace_each_match(
        text, _LOG_EMAIL_SCAN, lambda m: F.regexp_replace(m, r"(?<=@)[^.]+(?=\.)", "****"), needs="@"
    )


def mask_phone(text: Column) -> Column:
    """3-3-4 digits inside a phone-like match keep the first three only."""
    return replace_each_match(
        text, LOG_PHONE, lambda m: F.regexp_replace(m, PHONE_DIGITS, "$1-***-****"), needs=PHONE_DIGITS
    )


def mask_card(text: Column) -> Column:
    """16 digits in a row inside a card-like match keep the last four only."""
    return replace_each_match(
        text, LOG_CARD, lambda m: F.regexp_replace(m, CARD_DIGITS, "**** **** **** $1"), needs=CARD_DIGITS
    )


# The order matters: the phone rule eats bare 16-digit runs before the card rule.
LOG_RULES = [
    ("ip", mask_ip),
    ("mac", mask_mac),
    ("password", mask_password),
    ("email", mask_email_domain),
    ("phone", mask_phone),
    ("card", mask_card),
]


def _mask_document(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Apply the rules in order; the e-mail rule, the last one, only where there is an ``@``."""
    for pattern, placeholder in rules[:-1]:
        text = F.regexp_replace(text, pattern, placeholder)
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, *rules[-1])).otherwise(text)


def mask_document_a(text: Column) -> Column:
    """Document mask A: card, SSN and e-mail become fixed placeholders; NULL stays NULL."""
    return _mask_document(text, DOCUMENT_MASK_A)


def mask_document_b(text: Column) -> Column:
    """Document mask B: SSN, card and e-mail become tags; NULL becomes an empty text."""
    return F.coalesce(_mask_document(text, DOCUMENT_MASK_B), F.lit(""))


# What the hit report counts.
PII_RULES = {
    "card": DOCUMENT_MASK_A[0][0],
    "ssn": DOCUMENT_MASK_A[1][0],
    "email": DOCUMENT_MASK_A[2][0],
    "ip": LOG_IP,
    "mac": LOG_MAC,
    "password": r"password=",
    "phone": PHONE_DIGITS,
}


def pii_hits(text: Column) -> dict[str, Column]:
    """Number of matches per rule."""
    return {name: F.regexp_count(text, F.lit(pattern)).cast("long") for name, pattern in PII_RULES.items()}
