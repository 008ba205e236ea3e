"""Scalar and array column helpers (all JVM-side Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: wildcard id meaning "any or all" in fare rules and zones.
ALL_ID = -411

# Colour names accepted as a valid CSS colour (lower case).
CSS_COLOR_NAMES = (
    "aliceblue antiquewhite aqua aquamarine azure beige bisque black blanchedalmond blue "
    "blueviolet brown burlywood cadetblue chartreuse chocolate coral cornflowerblue cornsilk "
    "crimson cyan darkblue darkcyan darkgoldenrod darkgray darkgreen darkgrey darkkhaki "
    "darkmagenta darkolivegreen darkorange darkorchid darkred darksalmon darkseagreen "
    "darkslateblue darkslategray darkslategrey darkturquoise darkviolet deeppink deepskyblue "
    "dimgray dimgrey dodgerblue firebrick floralwhite forestgreen fuchsia gainsboro ghostwhite "
    "gold goldenrod gray green greenyellow grey honeydew hotpink indianred indigo ivory khaki "
    "lavender lavenderblush lawngreen lemonchiffon lightblue lightcoral lightcyan "
    "lightgoldenrodyellow lightgray lightgreen lightgrey lightpink lightsalmon lightseagreen "
    "lightskyblue lightslategray lightslategrey lightsteelblue lightyellow lime limegreen linen "
    "magenta maroon mediumaquamarine mediumblue mediumorchid mediumpurple mediumseagreen "
    "mediumslateblue mediumspringgreen mediumturquoise mediumvioletred midnightblue mintcream "
    "mistyrose moccasin navajowhite navy oldlace olive olivedrab orange orangered orchid "
    "palegoldenrod palegreen paleturquoise palevioletred papayawhip peachpuff peru pink plum "
    "powderblue purple red rosybrown royalblue saddlebrown salmon sandybrown seagreen seashell "
    "sienna silver skyblue slateblue slategray slategrey snow springgreen steelblue tan teal "
    "thistle tomato turquoise violet wheat white whitesmoke yellow yellowgreen transparent"
).split()

# Six hex digits and nothing else.  ``\z`` (absolute end) because Java's
# ``$`` would also accept a trailing newline.
HEX6 = r"^[0-9a-fA-F]{6}\z"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_means_all(col) -> Column:
    """NULL -> -411; -411 and NULL then compare equal (H3)."""
    return F.coalesce(_c(col), F.lit(ALL_ID).cast("bigint"))


def normalise_route_color(col, default: str) -> Column:
    """Bare 6-hex colour -> '#' + lower case; anything else -> default (H1)."""
    c = _c(col)
    return F.when(c.rlike(HEX6), F.concat(F.lit("#"), F.lower(c))).otherwise(F.lit(default))


def is_valid_css_color(col) -> Column:
    """Bare 6-hex colour or a named colour, case-insensitive (H2)."""
    low = F.lower(_c(col))
    return low.rlike(r"^[0-9a-f]{6}\z") | low.isin(*CSS_COLOR_NAMES)


def array_minus(a, b) -> Column:
    """Typed array difference (H4): distinct elements of ``a`` not in ``b``,
    sorted ascending with NULL last, NULL when nothing is left.  A NULL
    element of ``a`` never matches and is therefore kept."""
    out = array_minus_or_empty(a, b)
    return F.when(F.size(out) > 0, out)


def array_minus_or_empty(a, b) -> Column:
    """The generic array difference (H4): as ``array_minus``, but an empty
    array when nothing is left (NULL only when an argument is NULL)."""
    a, b = _c(a), _c(b)
    some = F.filter(a, lambda x: x.isNotNull())
    left = F.array_sort(F.array_except(some, b))
    return F.when(F.exists(a, lambda x: x.isNull()), F.array_append(left, F.lit(None))).otherwise(left)


def int_to_bool(col) -> Column:
    """``x::boolean`` of an integer flag: 0 false, other true, NULL NULL (H8)."""
    return _c(col) != 0


def flag_is_one(col) -> Column:
    """``(x = 1)``: NULL stays NULL (H8)."""
    return _c(col) == 1


def seconds_to_hms(col) -> Column:
    """Seconds since service-day start -> 'H:MM:SS' (hours may exceed 24) (H7)."""
    s = _c(col)
    sign = F.when(s < 0, F.lit("-")).otherwise(F.lit(""))
    a = F.abs(s)
    return F.when(s.isNotNull(), F.concat(
        sign, F.floor(a / 3600).cast("string"), F.lit(":"),
        F.lpad((F.floor(a / 60) % 60).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((a % 60).cast("string"), 2, "0")))


def hms_to_seconds(col) -> Column:
    """'H:MM:SS' text -> seconds (H7)."""
    parts = F.split(_c(col), ":")
    return (F.element_at(parts, 1).cast("bigint") * 3600
            + F.element_at(parts, 2).cast("bigint") * 60
            + F.element_at(parts, 3).cast("bigint"))


def ordered_join(arr, sep: str) -> Column:
    """``string_agg`` over an already ordered array: NULL elements skipped,
    NULL (not '') when no element is left (trap T14)."""
    a = F.filter(_c(arr), lambda x: x.isNotNull())
    return F.when(F.size(a) > 0, F.array_join(a, sep))
