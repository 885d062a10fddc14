"""String functions: county codes, composite keys, slugs, escaping, number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two-digit state codes.
STATE_BY_FIPS = {
    "01": "AL", "02": "AK", "04": "AZ", "05": "AR", "06": "CA", "08": "CO", "09": "CT", "10": "DE", "11": "DC", "12": "FL", "13": "GA", "15": "HI", "16": "ID", "17": "IL", "18": "IN", "19": "IA", "20": "KS", "21": "KY", "22": "LA", "23": "ME", "24": "MD", "25": "MA", "26": "MI", "27": "MN", "28": "MS", "29": "MO",
    "30": "MT", "31": "NE", "32": "NV", "33": "NH", "34": "NJ", "35": "NM", "36": "NY", "37": "NC", "38": "ND", "39": "OH", "40": "OK", "41": "OR", "42": "PA", "44": "RI", "45": "SC", "46": "SD", "47": "TN", "48": "TX", "49": "UT", "50": "VT", "51": "VA", "53": "WA", "54": "WV", "55": "WI", "56": "WY",
}


def county_fips(code: Column) -> Column:
    """County number of a code such as G5000030 (state, 0, county, 0): 50003."""
    return F.concat(F.substring(code, 2, 2), F.substring(code, 5, 3)).try_cast("int")


def state_of(code: Column) -> Column:
    """State abbreviation of a county code; NULL for an unknown state."""
    states = F.create_map(*[F.lit(x) for kv in STATE_BY_FIPS.items() for x in kv])
    return F.try_element_at(states, F.substring(code, 2, 2))


def normal_fips(c: Column) -> Column:
    """Without blanks and leading zeros; nothing left is 0."""
    bare = F.regexp_replace(F.trim(c), "^0+", "")
    return F.when(c.isNull(), None).when(bare == "", "0").otherwise(bare)


def nth_part(c: Column, separator: str, n: int) -> Column:
    """The n-th part (from 0) of c split at a plain separator; NULL if there are fewer."""
    return F.try_element_at(F.split(c, f"\\Q{separator}\\E"), F.lit(n + 1))


def key_text(*columns: str) -> Column:
    """The composite key as text, ('a', 'b'), for sinks; inside plans the key columns themselves are used.

    Different keys give different texts: a missing part is None without quotes, and quotes and backslashes in parts are escaped."""
    escaped = lambda c: F.regexp_replace(F.col(c).cast("string"), r"(['\\])", r"\\$1")
    quoted = [F.coalesce(F.concat(F.lit("'"), escaped(c), F.lit("'")), F.lit("None")) for c in columns]
    return F.concat(F.lit("("), F.concat_ws(", ", *quoted), F.lit(")"))


def title_case(c: Column) -> Column:
    """Every letter that follows no letter is upper case, all others lower: O'Brien-Smith. (initcap looks at blanks only.)"""
    pieces = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    shown = lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1_000_000)))
    return F.array_join(F.transform(pieces, shown), "")


def fixed(c: Column, places: int, grouped: bool = False) -> Column:
    """A number with so many places, half to even; with commas between thousands if grouped. Missing values stay missing."""
    exact = F.bround(c.cast("double"), places)
    return F.format_number(exact, places) if grouped else F.when(c.isNotNull(), F.format_string(f"%.{places}f", exact))


def significant(c: Column, digits: int = 3) -> Column:
    """A number with so many significant digits and no trailing zeros, 0.00123 or 12.3; beyond that 1.23e+08 or 1.23e-05.

    Half to even where the number lies halfway between two such numbers; decimals that no double holds exactly, such as 12.35, go up."""
    x = c.cast("double")
    # format_string takes halves up. Of an exact half after an even digit a little is taken off, less than the 17 digits looked at.
    shown = F.format_string("%.16e", F.abs(x))
    mantissa = F.replace(F.regexp_extract(shown, "^([^e]*)", 1), F.lit("."))
    half = F.substring(mantissa, digits + 1, 17) == "5" + "0" * (16 - digits)
    after_even = F.substring(mantissa, digits, 1).isin(*"02468")
    # Times a power of two no digit is lost, so this is whole only if the half is exact.
    doubled = x * F.pow(F.lit(2.0), F.greatest(F.lit(0), digits - F.regexp_extract(shown, r"e([+-]\d+)$", 1).try_cast("int")))
    x = F.when(half & after_even & (doubled == F.rint(doubled)), x * (1 - 2.0**-50)).otherwise(x)
    whole = F.format_string(f"%.{digits - 1}e", x)
    power = F.regexp_extract(whole, r"e([+-]\d+)$", 1).try_cast("int")
    bare = lambda t: F.when(F.instr(t, ".") > 0, F.regexp_replace(t, r"\.?0+$", "")).otherwise(t)
    written = F.format_string("%.0f", whole.cast("double"))
    for k in range(1, digits + 4):
        written = F.when(power == digits - 1 - k, bare(F.format_string(f"%.{k}f", whole.cast("double")))).otherwise(written)
    far = F.concat(bare(F.regexp_extract(whole, "^([^e]*)", 1)), F.regexp_extract(whole, r"(e[+-]\d+)$", 1))
    finite = c.isNotNull() & ~F.isnan(x)
    return F.when(finite, F.when(x == 0, F.lit("0")).when((power < -4) | (power >= digits), far).otherwise(written))


def slug(c: Column, fallback: str = "unknown") -> Column:
    bare = F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9_-]+", "-"), "^[-_]+|[-_]+$", "")
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit(fallback))


def html_escape(c: Column) -> Column:
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def padded(c: Column, width: int = 4) -> Column:
    """An integer with leading zeros; longer ones whole."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def same_text(a: Column, b: Column | str) -> Column:
    """Equal but for case."""
    return F.lower(a) == F.lower(b if isinstance(b, Column) else F.lit(b))
