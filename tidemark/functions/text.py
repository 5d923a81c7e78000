"""Text expressions that follow the Python string methods of the same purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted form of an e-mail address.
EMAIL = r"^[\w\.-]+@[\w\.-]+\.\w+$"

_MARK = "\ue000"  # from the private-use area
# Fixed value: characters that have a case; Chinese ones, for one, have none and end a word.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def strip(c: Column) -> Column:
    """Remove white space, tabs and line ends from both edges."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def _title_by_runs(c: Column) -> Column:
    """Each run of characters with a case on its own: first letter large, rest small."""

    def capital(run: Column) -> Column:
        first = F.upper(F.substring(run, 1, 1))
        rest = F.concat(F.substr(first, F.lit(2)), F.substr(run, F.lit(2)))
        return F.concat(F.substring(first, 1, 1), F.lower(rest))

    runs = F.regexp_extract_all(c, F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), 1)
    return F.array_join(F.transform(runs, capital), "")


def title_case(c: Column) -> Column:
    """Capital after every character without a case: ``o'neil`` gives ``O'Neil``, ``3rd`` gives ``3Rd``.

    ``initcap`` starts a word only after a space, so a mark and a space are put before every
    other word start and taken out again. A text that already has the mark goes the slower
    way, run by run.
    """
    gap = _MARK + " "
    marked = F.regexp_replace(c, f"(?<=[^{_CASED}])(?=[{_CASED}])", gap)
    quick = F.replace(F.initcap(marked), F.lit(gap), F.lit(""))
    return F.when(c.contains(_MARK), _title_by_runs(c)).otherwise(quick)


def is_email(c: Column) -> Column:
    """Whole-string match; ``\\z`` because Java's ``$`` also matches before a last line end."""
    return c.rlike("(?U)" + EMAIL.removesuffix("$") + r"\z")


def words(c: Column) -> Column:
    """Split on single spaces, one row per word (use inside ``select``)."""
    return F.explode(F.split(c, " "))


def json_number(c: Column, field: str) -> Column:
    """A whole number out of a JSON text column; null when missing or not a number."""
    return F.get_json_object(c, f"$.{field}").try_cast("int")
