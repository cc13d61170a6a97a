"""Scalar functions: bands, names, previews.  All stay inside codegen."""

from pyspark.sql import functions as F

from guardlake.schemas import DEFAULT_THRESHOLD, DIMENSION_ALIASES, FRAMEWORK_ALIASES

# Lower bounds of each band, tested from the top with >=.
LABEL_BANDS = ((8.0, "Excellent"), (6.0, "Good"), (4.0, "Fair"), (2.0, "Poor"))
COLOR_BANDS = ((7.0, "green"), (5.0, "yellow"))
GRADE_BANDS = ((9.0, "A"), (8.0, "A-"), (7.0, "B"), (6.0, "C"), (5.0, "D"))
RISK_BANDS = ((7.0, "low"), (5.0, "medium"), (3.0, "high"))

# Fixed value: the code points a blank content may consist of, U+FEFF included.
BLANK = r"^[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]*$"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def let(value, body):
    """``body(value)`` with the value worked out once, also when used inside array lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _band(c, bands, rest):
    c = _c(c)
    out = None
    for low, name in bands:
        out = F.when(c >= low, name) if out is None else out.when(c >= low, name)
    return F.when(c.isNotNull(), out.otherwise(rest))


def score_label(c):
    """Excellent / Good / Fair / Poor / Critical."""
    return _band(c, LABEL_BANDS, "Critical")


def score_color(c):
    """green / yellow / red."""
    return _band(c, COLOR_BANDS, "red")


def score_grade(c):
    """A / A- / B / C / D / F."""
    return _band(c, GRADE_BANDS, "F")


def risk_band(c):
    """Risk of a plan by its mean score: low / medium / high / critical."""
    return _band(c, RISK_BANDS, "critical")


def is_passing(c, threshold=DEFAULT_THRESHOLD):
    return _c(c) >= F.lit(threshold)


def confidence_weighted(c, conf):
    return _c(c) * _c(conf)


def _halves(x):
    """A double as the sum of two with half its digits each (Veltkamp)."""
    t = x * 134217729.0
    high = t - (t - x)
    return high, x - high


def format_score(c, decimals=1):
    """Fixed-decimal text of the exact binary value: the nearest number, away from zero on a tie.

    8.575 is stored a little below and gives 8.57 with two decimals.  The product with
    the power of ten is split into a rounded and an exact remaining part.
    """
    c, decimals = _c(c), int(decimals)
    scale = 10.0**decimals
    x = F.abs(c)
    product = x * F.lit(scale)
    (xh, xl), (sh, sl) = _halves(x), _halves(scale)
    rest = ((xh * sh - product) + xh * sl + xl * sh) + xl * sl
    whole = F.floor(product)
    number = whole + F.when((product - whole - 0.5) + rest >= 0, 1).otherwise(0)
    unit = 10**decimals
    text = number.cast("string")
    if decimals:
        cents = number % unit
        units = ((number - cents) / unit).cast("bigint").cast("string")
        text = F.concat(units, F.lit("."), F.lpad(cents.cast("string"), decimals, "0"))
    signed = F.concat(F.when(c < 0, "-").otherwise(""), text)
    return F.when(product < 2.0**52, signed).otherwise(F.format_string(f"%.{decimals}f", c))


def format_dimension_name(c):
    """``user_impact`` -> ``User Impact``; only first letters change."""
    words = F.transform(
        F.split(_c(c), "_"),
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)),
    )
    return F.array_join(words, " ")


def _renamed(c, aliases):
    c = _c(c)
    out = None
    for old, new in aliases.items():
        out = F.when(c == old, new) if out is None else out.when(c == old, new)
    return out.otherwise(c)


def normalize_dimension(c):
    """Deprecated dimension names become current ones."""
    return _renamed(c, DIMENSION_ALIASES)


def resolve_framework(c):
    """Framework aliases become canonical names; others pass through."""
    return _renamed(c, FRAMEWORK_ALIASES)


def compliance_threshold(strict=False):
    """Requirement threshold, 8.5 in strict mode, else 7.0."""
    if isinstance(strict, bool):
        return F.lit(8.5 if strict else 7.0)
    return F.when(_c(strict), 8.5).otherwise(7.0)


def preview(c, n=200, ellipsis=False):
    """First ``n`` characters, with an ellipsis sign when cut if asked."""
    c = _c(c)
    head = F.substring(c, 1, n)
    if not ellipsis:
        return head
    return F.when(F.length(c) > n, F.concat(head, F.lit("…"))).otherwise(head)


def severity_level(c):
    """Log level of an issue; critical issues write no line."""
    c = _c(c)
    return F.when(c.isin("low", "medium"), "WARN").when(c == "high", "ERROR")


def is_blank(c):
    """True for null, empty or whitespace-only text (Unicode spaces included)."""
    return F.coalesce(_c(c).rlike(BLANK), F.lit(True))
