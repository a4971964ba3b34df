"""Text standardizers as SQL expressions (no Python UDFs).

Functions here take and return SQL text, for ``selectExpr`` and ``expr``: a
cleaner's whole projection reaches the JVM as a handful of parsed strings, where
the same tree built from Column calls costs thousands of round trips.

``strip`` comes first, once per column: the other functions take stripped text.
Every ``std_*`` function turns NULL into ``Unknown``, looks the case-folded value
up in a literal map and title-cases whatever is not in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

UNKNOWN = "Unknown"

# The characters a text strip removes at both ends.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# CSV fields that mean NULL, compared before any trimming.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Canonical labels by case-folded spelling.
STATUSES = {
    "active": "Active",
    "churned": "Churned",
    "cancelled": "Cancelled",
    "paused": "Paused",
    "open": "Open",
    "paid": "Paid",
    "overdue": "Overdue",
    "void": "Void",
}
REGIONS = {"north america": "North America", "na": "North America", "emea": "EMEA", "apac": "APAC"}
CHANNELS = {
    "paid search": "Paid Search",
    "organic": "Organic",
    "partner": "Partner",
    "outbound": "Outbound",
    "referral": "Referral",
    "linkedin": "LinkedIn",
}
ENTITIES = {"saas holdco": "SaaS HoldCo", "saas canada": "SaaS Canada", "saas us": "SaaS US"}
CURRENCIES = {"USD": "USD", "US$": "USD", "CAD": "CAD"}
BILLING_FREQUENCIES = {"monthly": "Monthly", "annual": "Annual"}
PLANS = {"basic": "Basic", "growth": "Growth", "pro": "Pro", "enterprise": "Enterprise"}
ACCOUNT_CATEGORIES = {
    "cost of service": "COGS",
    "sales and marketing": "Sales & Marketing",
    "sales & marketing": "Sales & Marketing",
    "s&m": "Sales & Marketing",
    "research and development": "R&D",
    "r&d": "R&D",
    "general and administrative": "G&A",
    "g&a": "G&A",
    "cash": "Cash",
    "misc expense": "Other",
}

_BLANKS = "'" + "".join(f"\\u{ord(c):04x}" for c in WHITESPACE) + "'"
_MARK = "\\ufdd0"
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def literals(values: list[str] | tuple[str, ...]) -> str:
    """SQL list of text literals."""
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def _trimmed(c: str, trimmed: str) -> str:
    # btrim with a character set is several times the cost of looking at both
    # ends, so it only runs where one of them is no printable ASCII character
    ends = f"least({c}, right({c}, 1)) < '!' OR greatest({c}, right({c}, 1)) >= '\\u0080'"
    return f"CASE WHEN {ends} THEN {trimmed} ELSE {c} END"


def strip(c: str) -> str:
    """Remove whitespace of any kind at both ends."""
    return _trimmed(c, f"btrim({c}, {_BLANKS})")


def clean_text(c: str) -> str:
    """Strip; blank becomes NULL."""
    return _trimmed(c, f"nullif(btrim({c}, {_BLANKS}), '')")


def has_text(df: DataFrame, name: str) -> str:
    """Whether a column still has a value after cleaning, at the price of one look at it."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return f"{name} RLIKE '[^{_BLANKS[1:-1]}]'"
    return f"{name} IS NOT NULL"


def clean_value(df: DataFrame, name: str) -> str:
    """A column of any type, with blank text as NULL."""
    return clean_text(name) if isinstance(df.schema[name].dataType, T.StringType) else name


def _over_text_columns(df: DataFrame, change, skip: tuple[str, ...] = ()) -> DataFrame:
    return df.selectExpr(
        *[
            f"{change(f.name)} AS {f.name}" if isinstance(f.dataType, T.StringType) and f.name not in skip else f.name
            for f in df.schema.fields
        ]
    )


def trim_text_columns(df: DataFrame, *done: str) -> DataFrame:
    """``clean_text`` over every string column of a table but those already done."""
    return _over_text_columns(df, clean_text, done)


def null_tokens_to_null(df: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Turn null spellings of every string column into NULL."""
    return _over_text_columns(df, lambda c: f"CASE WHEN {c} NOT IN ({literals(tokens)}) THEN {c} END")


def _title(text: str) -> str:
    boundary = rf"(?<=[^{_CASED} ])(?=[{_CASED}])"
    return f"replace(initcap(regexp_replace({text}, r'{boundary}', '{_MARK} ')), '{_MARK} ', '')"


def title_case(text: str) -> str:
    """A capital after anything that is not a letter, lower case elsewhere.

    ``initcap`` only capitalizes after blanks. Where a letter may follow another
    separator, a marked blank goes before it for the time of the call; the mark
    is a code point that text cannot hold.
    """
    plain = rf"{text} RLIKE r'^[A-Za-z ]*+[^A-Za-z\x80-\x{{10FFFF}}]*+$'"
    return f"CASE WHEN {plain} THEN initcap({text}) ELSE {_title(text)} END"


def _lookup(mapping: dict[str, str], key: str, *fallbacks: str) -> str:
    """The mapped label, or the first fallback that is not NULL; a NULL key maps to NULL."""
    entries = literals([text for pair in mapping.items() for text in pair])
    return f"coalesce(map({entries})[{key}], {', '.join(fallbacks)})"


def _standardize(text: str, mapping: dict[str, str]) -> str:
    # few values miss the map: the short title form keeps a projection of many
    # standardizers small enough to be compiled
    return _lookup(mapping, f"lower({text})", _title(text), f"'{UNKNOWN}'")


def std_status(c: str) -> str:
    return _standardize(c, STATUSES)


def std_region(c: str) -> str:
    return _standardize(c, REGIONS)


def std_channel(c: str) -> str:
    return _standardize(c, CHANNELS)


def std_entity(c: str) -> str:
    return _standardize(c, ENTITIES)


def std_billing(c: str) -> str:
    return _standardize(c, BILLING_FREQUENCIES)


def std_plan(c: str) -> str:
    return _standardize(c, PLANS)


def std_currency(c: str) -> str:
    """Currencies are upper-cased; an unlisted one stays as it is."""
    return _lookup(CURRENCIES, f"upper({c})", f"upper({c})", f"'{UNKNOWN}'")


def std_side(c: str) -> str:
    """Debit / credit marker: upper-cased, NULL stays NULL."""
    return f"upper({c})"


def std_id(c: str) -> str:
    """Identifiers are text, whatever type they arrive in."""
    return f"CAST({c} AS STRING)"


def clean_id(df: DataFrame, name: str) -> str:
    """An identifier column of any type as stripped text."""
    return clean_text(name) if isinstance(df.schema[name].dataType, T.StringType) else std_id(name)


def gl_category(account_name: str) -> str:
    """Reporting category of a ledger account; ``Other`` when unmapped."""
    return _lookup(ACCOUNT_CATEGORIES, f"lower({account_name})", "'Other'")
