"""Text expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from casebook.functions import fixed_values as V

# White space as Unicode text functions count it, the four ASCII separators included.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACES = f"[{WHITE_SPACE}]+"
ASCII_CONTROLS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITE_SPACE))


def lookup(value: Column, table: Mapping[str, object]) -> Column:
    """The table's entry for ``value``, NULL when it has none."""
    if not table:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), value)


def relabel(value: Column, table: Mapping[str, str]) -> Column:
    """``value`` replaced by its display label where the table has one."""
    return F.coalesce(lookup(value, table), value)


def squeeze(value: Column) -> Column:
    """Trim, lower, collapse white space, then drop non-ASCII; NULL and '' stay.

    The patterns only run on text that needs them: plain ASCII text without
    control characters takes two string functions.
    """
    special = F.octet_length(value) != F.length(value)
    for char in ASCII_CONTROLS:
        special = special | F.contains(value, F.lit(char))
    collapsed = F.regexp_replace(F.lower(strip(value)), SPACES, " ")
    low = F.trim(F.lower(value))
    plain = F.when(F.contains(low, F.lit("  ")), F.regexp_replace(low, " +", " ")).otherwise(low)
    return F.when(special, F.regexp_replace(collapsed, r"[^\x00-\x7F]+", "")).otherwise(plain)


def squeeze_comma(value: Column) -> Column:
    """As :func:`squeeze`, cut at the first comma; NULL and '' become 'unknown'."""
    cut = F.regexp_replace(squeeze(value), ",.*$", "")
    return F.when(value.isNull() | (value == ""), "unknown").otherwise(cut)


def normalize_text(value: Column, aliases: Mapping[str, str] = V.TEXT_ALIASES) -> Column:
    """Squeezed text with aliases applied.

    The alias lookup names its input twice; on frames use the two projections of
    ``cleaning.normalize_columns``, which squeeze each value once.
    """
    return relabel(squeeze(value), aliases)


def normalize_text_comma(value: Column, aliases: Mapping[str, str] = V.TEXT_ALIASES) -> Column:
    return relabel(squeeze_comma(value), aliases)


def clean_summary(
    value: Column,
    abbreviations: Mapping[str, str] = V.SUMMARY_ABBREVIATIONS,
    terms: Mapping[str, str] = V.SUMMARY_TERMS,
    dropped: str = V.SUMMARY_DROPPED_PHRASE,
    length: int = V.SUMMARY_LENGTH,
) -> Column:
    """Expand abbreviations and unify terms as plain substrings, drop a phrase, cut to length."""
    text = squeeze_comma(value)
    for short, full in [*abbreviations.items(), *terms.items()]:
        text = F.replace(text, F.lit(short), F.lit(full))
    text = F.regexp_replace(text, f"(?i){dropped}", "")
    return F.when(value.isNull() | (value == ""), "").otherwise(F.substring(text, 1, length))


def one_line(value: Column) -> Column:
    """New lines become spaces, outer white space goes."""
    return strip(F.replace(value, F.lit("\n"), F.lit(" ")))


def matches(value: Column, pattern: str) -> Column:
    """Case-insensitive search; NULL text does not match."""
    return F.coalesce(value.rlike(f"(?i){pattern}"), F.lit(False))


def like_ignoring_case(value: Column, pattern: str) -> Column:
    return F.coalesce(F.lower(value).like(pattern.lower()), F.lit(False))


def mentions_other_year(text: Column, year: Column) -> Column:
    """The text names some year of 1970..2017 but not the row's own year."""
    some = text.rlike(r"19[7-9]\d|200\d|201[0-7]")
    own = F.contains(F.lower(text), year.cast("string"))
    return F.coalesce(some & ~own, F.lit(False))


def first_phrase(
    text: Column,
    phrases: Mapping[str, str],
    after_first: Mapping[str, str] | None = None,
) -> Column:
    """The label of the first phrase found in the text, NULL when none is.

    ``after_first`` names are searched for right after the first phrase, before
    the remaining ones.
    """
    items = list(phrases.items())
    if after_first:
        items = items[:1] + list(after_first.items()) + items[1:]
    lowered = F.lower(text)
    found = F.lit(None).cast("string")
    for phrase, label in reversed(items):
        found = F.when(F.contains(lowered, F.lit(phrase)), F.lit(label)).otherwise(found)
    return found


def first_pattern(text: Column, patterns: Iterable[tuple[str, str]]) -> Column:
    """The label of the first pattern that matches the lowered text, else the text itself.

    Word boundaries count letters of every script, whichever Java runs.
    """
    lowered = strip(F.lower(text))
    label = lowered
    for name, pattern in reversed(list(patterns)):
        label = F.when(lowered.rlike(f"(?U){pattern}"), F.lit(name)).otherwise(label)
    return label


def motive_class(text: Column, patterns=V.MOTIVE_PATTERNS) -> Column:
    return first_pattern(text, patterns)


def prompt(summary: Column) -> Column:
    return F.concat(F.lit(V.PROMPT_BEFORE), summary, F.lit(V.PROMPT_AFTER))


def usable_label(label: Column) -> Column:
    """Not NULL, not blank, not the text 'nan'."""
    bare = strip(label)
    return label.isNotNull() & (bare != "") & (F.lower(bare) != "nan")


def joined_key(columns: Iterable[Column]) -> Column:
    """One text key; a NULL part makes the key NULL, as a string concatenation would."""
    parts: list[Column] = []
    for column in columns:
        parts += [column, F.lit("|")]
    return F.concat(*parts[:-1])


def location_key(region, country, provstate, city, latitude, longitude) -> Column:
    """``region|country|provstate|city|lat|lon`` with three decimals."""
    fixed = [F.when(c.isNotNull(), F.format_string("%.3f", c)) for c in (latitude, longitude)]
    return joined_key([region, country, provstate, city, *fixed])
