"""Search-result helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import Rule, first_rule
from .text import strip

NOT_FOUND = "Not Found"

# Month names and the four date layouts, tried in this order, each
# with its groups of month, day and year and whether the month is a number.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December")
_MONTH_ALT = "|".join(MONTHS)
DATE_LAYOUTS = (
    (rf"(?i)\b({_MONTH_ALT})\s+(\d{{1,2}}),?\s+(\d{{4}})\b", 1, 2, 3, False),
    (rf"(?i)\b(\d{{1,2}})\s+({_MONTH_ALT})\s+(\d{{4}})\b", 2, 1, 3, False),
    (r"\b(\d{1,2})/(\d{1,2})/(\d{4})\b", 1, 2, 3, True),
    (r"\b(\d{4})-(\d{1,2})-(\d{1,2})\b", 2, 3, 1, True),
)
YEARS = (1990, 2030)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_date(text) -> Column:
    """First valid date of the first layout that has one -> 'Month D, YYYY'.

    Numeric layouts need month 1-12, day 1-31, year 1990-2030; the day is kept
    as written.  No date -> 'Not Found'."""
    months = F.array(*[F.lit(m) for m in MONTHS])

    def dates(pattern, month, day, year, numeric):
        def written(x):
            m, d, y = (F.regexp_extract(x, pattern, k) for k in (month, day, year))
            name = F.element_at(months, m.cast("int")) if numeric else m
            out = F.concat(name, F.lit(" "), d, F.lit(", "), y)
            if not numeric:
                return out
            return F.when(m.cast("int").between(1, 12) & d.cast("int").between(1, 31) & y.cast("int").between(*YEARS), out)

        found = F.transform(F.regexp_extract_all(_c(text), F.lit(pattern), 0), written)
        return F.try_element_at(F.filter(found, lambda x: x.isNotNull()), F.lit(1))

    return F.coalesce(*[dates(*layout) for layout in DATE_LAYOUTS], F.lit(NOT_FOUND))


# Formulary title layouts (tried in order, in any case) with the
# words that disqualify a captured name, and the state layout tried last.
TITLE_RULES = tuple(Rule(f"(?i){layout}", 1, 2, ("pdf", "download", "file")) for layout in (
    r"^([A-Z][a-zA-Z\s&\-]+)\s+Formulary",
    r"^([A-Z][a-zA-Z\s&\-]+)\s+Preferred\s+Drug\s+List",
    r"^([A-Z][a-zA-Z\s&\-]+)\s+PDL",
    r"([A-Z][a-zA-Z\s&\-]+)\s+Medicaid\s+Formulary",
    r"([A-Z][a-zA-Z\s&\-]+)\s+Medicare\s+Formulary",
))
STATE_RULE = Rule(r"(?i)([A-Z][a-z]+)\s+Medicaid", 1, 0, (), "{} Medicaid")


def title_rules(vendor_keywords: list[tuple[str, str]] = ()) -> list[Rule]:
    """The fixed layouts, then the caller's (keyword, name) pairs, then the state layout."""
    return [*TITLE_RULES, *[Rule(rf"(?iu)\Q{kw}\E", label=name) for kw, name in vendor_keywords], STATE_RULE]


def plan_name_from_title(title, rules: list[Rule] | None = None) -> Column:
    """The name that the first fitting rule makes of a title; else 'Not Found'.
    ``rules`` come from the caller (``title_rules``, or ``rules_of`` a table)."""
    return F.coalesce(first_rule(title, rules if rules is not None else title_rules()), F.lit(NOT_FOUND))


def normalize_channel(value, keywords: list[tuple[str, str]], mode: str = "substring") -> Column:
    """The first keyword (list order) found in the lower-cased, stripped
    value gives the canonical name; no hit returns the value; empty or null
    returns ''.  ``mode='substring'`` is the reference's rule (so 'group'
    shadows 'small group' when listed first, D11); ``mode='word'`` needs the
    keyword on word boundaries."""
    import re
    v = _c(value)
    low = F.lower(strip(v))
    out = v
    for kw, canon in reversed(keywords):
        hit = low.contains(kw) if mode == "substring" else low.rlike(r"\b" + re.escape(kw.lower()) + r"\b")
        out = F.when(hit, F.lit(canon)).otherwise(out)
    return F.when(v.isNull() | (strip(v) == ""), F.lit("")).otherwise(out)


def compose_query(bin_, pcn, grp, suffix: str = "filetype:pdf") -> Column:
    """B18: 'BIN b PCN p GroupID g <suffix>' from the parts present; missing
    parts leave an empty slot between single spaces, as a plain join does."""
    parts = [F.coalesce(F.when(_c(x).isNotNull(), F.concat(F.lit(lbl + " "), _c(x))), F.lit(""))
             for x, lbl in ((bin_, "BIN"), (pcn, "PCN"), (grp, "GroupID"))]
    return F.trim(F.concat_ws(" ", *parts, F.lit(suffix)))
