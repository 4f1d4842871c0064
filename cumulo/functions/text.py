"""Text expressions: blanks, names, ids, lists and messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ELLIPSIS = "…"

# Patterns. Letters, digits and words are Unicode-aware where the pattern says so.
_NOT_NAME_CHAR = r"[^\p{L}\p{N}_\-.]"
_NOT_ID_CHAR = r"[^a-zA-Z0-9_]"
_NOT_VIEW_CHAR = r"[^A-Za-z0-9_]"
_ACCOUNT_ID = r"(?<![\p{L}\p{N}_])([0-9]{12})(?![\p{L}\p{N}_])"
_ROLE_ARN = r"^arn:aws:iam::[0-9]{12}:role/.+$"
_TWELVE_DIGITS = r"^[0-9]{12}$"
_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
ID_LENGTH = 40
ID_DEFAULT = "m"
MESSAGE_LENGTH = 400

# Region requests that stand for "all", and the regions used when the list of
# enabled regions may not be read.
ALL_REGIONS_TOKENS = ("ALL", "*", "AUTO")
STANDARD_REGIONS = (
    "ap-northeast-1",
    "ap-northeast-2",
    "ap-northeast-3",
    "ap-south-1",
    "ap-southeast-1",
    "ap-southeast-2",
    "ca-central-1",
    "eu-central-1",
    "eu-north-1",
    "eu-west-1",
    "eu-west-2",
    "eu-west-3",
    "sa-east-1",
    "us-east-1",
    "us-east-2",
    "us-west-1",
    "us-west-2",
)


def texts(values: Sequence[str]) -> Column:
    """An array literal of strings, typed also when empty."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def blank_to_null(value: Column) -> Column:
    return F.when(value != "", value)


def first_nonblank(*values: Column) -> Column:
    """The first value that is neither NULL nor '', else ''."""
    return F.coalesce(*[blank_to_null(v) for v in values], F.lit(""))


def stripped(value: Column) -> Column:
    """Without white space of any kind at both ends; '' for NULL."""
    return F.trim(F.coalesce(value, F.lit("")), F.lit(_WHITESPACE))


def split_list(value: Column, upper: bool = False) -> Column:
    """Items of a comma list, trimmed, blanks dropped; NULL text gives an empty list."""
    items = F.transform(F.split(F.coalesce(value, F.lit("")), ","), lambda item: stripped(item))
    items = F.filter(items, lambda item: item != "")
    return F.transform(items, F.upper) if upper else items


def wants_all_regions(items: Column) -> Column:
    """A blank request, or one lone wildcard. A wildcard among names is just a name."""
    lone = F.upper(F.try_element_at(items, F.lit(1))).isin(*ALL_REGIONS_TOKENS)
    return (F.size(items) == 0) | ((F.size(items) == 1) & lone)


def resolve_regions(request: Column, enabled: Sequence[str]) -> Column:
    """Regions named by a comma list, in its order and with its repeats; sorted ``enabled``
    regions if the request is for all of them."""
    items = split_list(request)
    return F.when(wants_all_regions(items), texts(sorted(enabled))).otherwise(items)


def account_ids(*values: Column) -> Column:
    """Distinct 12-digit ids standing alone in the texts, in order of first appearance."""
    found = [
        F.regexp_extract_all(F.coalesce(v, F.lit("")), F.lit(_ACCOUNT_ID), F.lit(1))
        for v in values
    ]
    return F.array_distinct(F.concat(*found))


def role_for_account(role_arn: Column, account_id: Column) -> Column:
    """The role ARN with its account segment replaced; unchanged unless both have the right form."""
    role = stripped(role_arn)
    account = stripped(account_id)
    rewritable = role.rlike(_ROLE_ARN) & account.rlike(_TWELVE_DIGITS)
    parts = F.split(role, ":", 6)
    moved = F.concat_ws(
        ":", F.slice(parts, 1, 4), account, F.try_element_at(parts, F.lit(6))
    )
    return F.when(rewritable, moved).otherwise(role)


def safe_name(value: Column) -> Column:
    return F.regexp_replace(value, _NOT_NAME_CHAR, "_")


def safe_id(value: Column) -> Column:
    cleaned = F.substring(F.regexp_replace(value, _NOT_ID_CHAR, ""), 1, ID_LENGTH)
    return F.coalesce(blank_to_null(cleaned), F.lit(ID_DEFAULT))


def safe_view_name(value: Column) -> Column:
    return F.regexp_replace(value, _NOT_VIEW_CHAR, "_")


def truncated(message: Column, length: int = MESSAGE_LENGTH) -> Column:
    """Long messages end in an ellipsis after ``length`` characters."""
    message = F.coalesce(message, F.lit(""))
    cut = F.concat(F.substring(message, 1, length), F.lit(ELLIPSIS))
    return F.when(F.length(message) > length, cut).otherwise(message)


def json_texts(value: Column) -> Column:
    """The strings of a JSON list; malformed or missing text gives an empty list."""
    return F.coalesce(F.from_json(value, "array<string>"), texts([]))
