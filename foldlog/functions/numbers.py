"""Numbers and truth values as the original job prints them."""

from __future__ import annotations

# SQL text, as in payload.py. The lambdas keep the generated code of wide projections small: the
# long expression is reached for numbers in exponent form only.


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def float_text(number: str) -> str:
    """Text of a float or double: the shortest digits that give the number back, with exponents
    below -4 and from 16 on only (``100000.0``, ``1e+16``, ``1.5e-07``); ``nan``, ``inf``, ``-inf``.
    """
    # Java may print a digit too many, so numbers of many digits are shortened as well.
    shortest = (
        "element_at(filter(transform(sequence(0, 16), k -> format_string('%.' || k || 'e', x)), "
        "c -> cast(c AS double) = x), 1)"
    )
    parts = (
        "named_struct('whole', s, 'sign', if(startswith(s, '-'), '-', ''), "
        "'digits', translate(split_part(s, 'e', 1), '-.', ''), 'e', cast(split_part(s, 'e', 2) AS int))"
    )
    plain = (
        "if(length(p.digits) <= p.e + 1, rpad(p.digits, p.e + 1, '0') || '.0', "
        "substr(p.digits, 1, p.e + 1) || '.' || substr(p.digits, p.e + 2))"
    )
    formed = (
        f"CASE WHEN p.e BETWEEN 0 AND 15 THEN p.sign || {plain} "
        "WHEN p.e BETWEEN -4 AND -1 THEN p.sign || '0.' || repeat('0', -p.e - 1) || p.digits ELSE p.whole END"
    )
    long = _let(f"cast({number} AS double)", "x", _let(shortest, "s", _let(parts, "p", formed)))
    text = (
        "CASE WHEN t = 'NaN' THEN 'nan' WHEN t = 'Infinity' THEN 'inf' WHEN t = '-Infinity' THEN '-inf' "
        f"WHEN contains(t, 'E') OR length(t) > 17 THEN {long} ELSE t END"
    )
    return _let(f"cast({number} AS string)", "t", text)


def truth_text(value: str) -> str:
    """``True`` or ``False``."""
    return f"CASE {value} WHEN true THEN 'True' WHEN false THEN 'False' END"


def scalar_text(variant: str, text: str, written: str | None = None) -> str:
    """Text of a number or truth value in a variant whose cast to text is ``text``; other values
    keep that text.

    Variants hold whole numbers of up to 38 digits and take longer ones for doubles. ``written``
    is the number as it stands in the document: where it is a whole number, its digits are taken.
    Without it whole numbers beyond 38 digits are lost, and from 19 digits on a number that was
    written with a point and zeros reads like a whole one.
    """
    as_float = float_text(f"try_cast({variant} AS double)")
    if written is None:
        number = f"if(kind RLIKE '^DECIMAL[(](19|[23][0-9]),0[)]', {text}, {as_float})"
    else:
        whole = f"if(w RLIKE '^-?[0-9]+$' AND cast(w AS double) = try_cast({variant} AS double), w, {as_float})"
        number = _let(written, "w", whole)
    return _let(
        f"schema_of_variant({variant})",
        "kind",
        f"CASE WHEN kind = 'BOOLEAN' THEN initcap({text}) "
        f"WHEN kind = 'DOUBLE' OR kind LIKE 'DECIMAL%' THEN {number} ELSE {text} END",
    )
