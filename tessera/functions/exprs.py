"""Column helpers shared by every operator.

Everything here builds built-in Spark expressions, so it stays inside
whole-stage codegen: no Python UDF anywhere.

Value *forms* name how a stored or incoming value is normalised before it is
written or compared.  They are the rule classes of the entity specs:

``raw``    the value as it is
``trim``   leading and trailing blanks removed (spaces only, as the T-SQL TRIM)
``trim0``  ``trim`` and NULL replaced by the text ``'0'`` (unresolved reference)
``raw0``   NULL replaced by ``'0'``
``int0``   NULL replaced by the integer ``0`` (preference flags)
``text``   the value cast to text (for fingerprints)
``ttext``  the value cast to text, then trimmed

Each form has a Spark rendering (:func:`form`) and a SQL rendering
(:func:`form_sql`, used only to write the DuckDB oracle).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMS = ("raw", "trim", "trim0", "raw0", "int0", "text", "ttext")


def form(name: str, c: Column) -> Column:
    """Apply a value form to a Spark column."""
    if name == "raw":
        return c
    if name == "trim":
        return F.trim(c)
    if name == "trim0":
        return F.coalesce(F.trim(c), F.lit("0"))
    if name == "raw0":
        return F.coalesce(c, F.lit("0"))
    if name == "int0":
        return F.coalesce(c, F.lit(0))
    if name == "text":
        return c.cast("string")
    if name == "ttext":
        return F.trim(c.cast("string"))
    raise ValueError(f"unknown form {name!r}")


def form_sql(name: str, c: str) -> str:
    """Apply a value form to a SQL expression (oracle text)."""
    if name == "raw":
        return c
    if name == "trim":
        return f"trim({c})"
    if name == "trim0":
        return f"coalesce(trim({c}), '0')"
    if name == "raw0":
        return f"coalesce({c}, '0')"
    if name == "int0":
        return f"coalesce({c}, 0)"
    if name == "text":
        return f"CAST({c} AS STRING)"
    if name == "ttext":
        return f"trim(CAST({c} AS STRING))"
    raise ValueError(f"unknown form {name!r}")


# ---------------------------------------------------------------- keys


def norm_key(c: Column, mode: str) -> Column:
    """Normalise a business key for matching.

    ``trim``  both sides trimmed, as the reference writes ``TRIM(a) = TRIM(b)``.
    ``rtrim`` a raw ``a = b`` in T-SQL ignores trailing (not leading) blanks;
              Spark compares exactly, so both sides lose trailing blanks.
    ``exact`` no change (non-string keys).
    """
    if mode == "trim":
        return F.trim(c)
    if mode == "rtrim":
        return F.rtrim(c)
    if mode == "exact":
        return c
    raise ValueError(f"unknown key mode {mode!r}")


def norm_key_sql(c: str, mode: str) -> str:
    return {"trim": f"trim({c})", "rtrim": f"rtrim({c})", "exact": c}[mode]


# The collations that match keys may compare under, as normalisations of the key.
_KEY_COLLATIONS = {
    "UTF8_BINARY": lambda c: c,
    "UTF8_BINARY_RTRIM": F.rtrim,
    "UTF8_LCASE": F.lower,
    "UTF8_LCASE_RTRIM": lambda c: F.lower(F.rtrim(c)),
}


def collated_key(c: Column, collation: str | None) -> Column:
    """A match key under a collation, as a value that equal keys share (so joins, salts and hashes agree)."""
    if collation is None:
        return c
    if collation not in _KEY_COLLATIONS:
        raise ValueError(f"match keys compare under one of {', '.join(_KEY_COLLATIONS)}, not {collation!r}")
    return _KEY_COLLATIONS[collation](c)


def is_blank(c: Column) -> Column:
    """``TRIM(x) IS NULL OR TRIM(x) = ''`` (also the T-SQL meaning of ``x IS NULL OR x = ''``)."""
    return F.coalesce(F.trim(c), F.lit("")) == F.lit("")


def is_blank_sql(c: str) -> str:
    return f"coalesce(trim({c}), '') = ''"


# ---------------------------------------------------------------- change tests


def differs(a: Column, b: Column) -> Column:
    """NULL-safe inequality: NULL differs from a value, NULL equals NULL.

    This is what comparing two single-operand checksums decides.
    """
    return ~a.eqNullSafe(b)


def differs_sql(a: str, b: str) -> str:
    return f"({a}) IS DISTINCT FROM ({b})"


def concat_text(cols: list[Column]) -> Column:
    """NULL-propagating concatenation of text operands (T-SQL ``+``)."""
    return F.concat(*cols) if len(cols) > 1 else cols[0]


def concat_text_sql(cols: list[str]) -> str:
    # DuckDB concat() skips NULLs; || propagates them like Spark concat.
    return " || ".join(f"({c})" for c in cols) if len(cols) > 1 else cols[0]


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def fingerprint_changed(
    items: list[list[tuple[Column, Column]]], mode: str = "collapse"
) -> Column:
    """Does the source row differ from the target row?

    ``items`` is a checksum argument list; each item is a list of
    ``(source_operand, target_operand)`` text pairs concatenated into one value.

    ``collapse`` (reference-faithful): per item, the concatenations are compared
    NULL-safely, so one NULL operand collapses the whole item to NULL, and NULL on
    both sides compares equal.  Operands are not separated.
    ``null_safe``: every operand is compared on its own.
    """
    if mode == "collapse":
        return any_of(
            [differs(concat_text([s for s, _ in it]), concat_text([t for _, t in it])) for it in items]
        )
    if mode == "null_safe":
        return any_of([differs(s, t) for it in items for s, t in it])
    raise ValueError(f"unknown fingerprint mode {mode!r}")


def fingerprint_changed_sql(items: list[list[tuple[str, str]]], mode: str = "collapse") -> str:
    if mode == "collapse":
        parts = [
            differs_sql(concat_text_sql([s for s, _ in it]), concat_text_sql([t for _, t in it]))
            for it in items
        ]
    else:
        parts = [differs_sql(s, t) for it in items for s, t in it]
    return "(" + " OR ".join(parts) + ")"


def tenant_key(c: Column | str) -> Column:
    """A tenant id as it is compared: unique identifiers do not differ by letter case."""
    return F.lower(F.col(c) if isinstance(c, str) else c)
