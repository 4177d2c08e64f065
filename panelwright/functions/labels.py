"""Place labels such as ``"Calgary, Alberta [48825]"``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the two halves of a border city and their rewritten form.
BORDER_CITIES = {
    "Ottawa-Gatineau, Ontario part, Ontario/Quebec": "Ottawa,Ontario",
    "Ottawa-Gatineau, Quebec part, Ontario/Quebec": "Ottawa,Quebec",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rewrite_border_cities(label: Column | str) -> Column:
    """Label in which the border-city halves end with one province only."""
    out = _col(label)
    for old, new in BORDER_CITIES.items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def after_last_comma(label: Column | str) -> Column:
    """Trimmed text after the last comma; the whole label if it has none."""
    return F.trim(F.substring_index(_col(label), ",", -1))


def strip_code(label: Column | str) -> Column:
    """Label without a trailing ``" [code]"``; unchanged if it has none."""
    return F.regexp_replace(_col(label), r" *\[[^\]]*\]$", "")


def province_of(label: Column | str) -> Column:
    """Province named by a place label (code dropped, border cities resolved)."""
    return after_last_comma(strip_code(rewrite_border_cities(label)))


def region_of_file(file_name: Column | str) -> Column:
    """Region in the (percent-encoded) name or path of a file called ``"<Region>_<anything>"``."""
    base = F.substring_index(_col(file_name), "/", -1)
    # a plus sign in a file name stands for itself, not for a blank
    decoded = F.try_url_decode(F.replace(base, F.lit("+"), F.lit("%2B")))
    return F.trim(F.substring_index(F.coalesce(decoded, base), "_", 1))
