"""Parse JSON documents held in text, and turn their values into text.

Only the variant type keeps an absent field (SQL NULL) and a JSON null (a variant) apart.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldlog.functions.numbers import scalar_text

_JSON_SPACE = " \t\r\n"


def parse_listed(text: Column, mode: str) -> Column:
    """A JSON object, parsed as the only element of a list.

    The parser stops after the first value it has read; inside a list it finds what follows.
    """
    # Trimming walks the text character by character, so it is left to texts that need it.
    space = F.lit(_JSON_SPACE)
    opens = text.startswith("{") | F.ltrim(text, space).startswith("{")
    closes = text.endswith("}") | F.rtrim(text, space).endswith("}")
    is_object = opens & closes
    listed = F.concat(F.lit("["), text, F.lit("]"))
    if mode == "fail":
        return F.when(is_object, F.parse_json(listed)).otherwise(_refused())
    if mode == "null":
        return F.when(is_object, F.try_parse_json(listed))
    raise ValueError(f"mode must be 'fail' or 'null', not {mode!r}")


def only_element(listed: Column, mode: str) -> Column:
    """The object parsed by ``parse_listed``; more than one is refused like malformed text."""
    alone = F.variant_get(listed, "$[1]", "variant").isNull()
    found = F.when(alone, F.variant_get(listed, "$[0]", "variant"))
    return found.otherwise(_refused()) if mode == "fail" else found


def _refused() -> Column:
    return F.raise_error(F.lit("payload is not one JSON object"))


# The expressions below are SQL text: a wide payload takes dozens, and one text per column is
# built much faster than a tree of Column objects.


def members(value: str, names: Iterable[str]) -> str:
    """Struct of the named members of an object, each a variant; NULL for any other value."""
    fields = ",".join(f"`{name}`:variant" for name in names)
    return f"try_variant_get({value}, '$', 'struct<{fields}>')"


def member_text(value: str, text: str, root: str, written: str | None = None) -> str:
    """Text of a member: ``''`` when absent, NULL for JSON null, JSON text for lists and objects,
    numbers and truth values as ``scalar_text`` has them. ``text`` is its cast to text.

    NULL as well where ``root``, the members of the whole document, is NULL.
    """
    # Only numbers, truth values and texts that look like them begin or read like this.
    special = f"ascii({text}) BETWEEN 45 AND 57 OR {text} IN ('true', 'false', 'Infinity')"
    return (
        f"CASE WHEN {text} IS NULL THEN if({value} IS NULL AND {root} IS NOT NULL, '', NULL) "
        f"WHEN {special} THEN {scalar_text(value, text, written)} ELSE {text} END"
    )


def written_member(source: str, path: Iterable[str]) -> str | None:
    """A member as it stands in a JSON text; None for names that such a path cannot hold."""
    names = list(path)
    if any(c in name for name in names for c in "'\\[]*"):
        return None
    place = "$" + "".join(f"[\\'{name}\\']" for name in names)
    return f"get_json_object({source}, '{place}')"


def object_text(value: str, root: str) -> str:
    """JSON text of a member that is an object, ``''`` for any other value."""
    is_object = f"startswith(to_json({value}), '{{')"
    return f"CASE WHEN {is_object} THEN to_json({value}) WHEN {root} IS NOT NULL THEN '' END"
