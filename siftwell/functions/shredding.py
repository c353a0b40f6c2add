"""Semi-structured records to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def shred(json: Column, fields: dict[str, tuple[str, str]]) -> Column:
    """struct of one column for each of ``fields`` (name -> path, type), and ``rejected``: the paths whose
    value is there but isn't of the type, or ``$`` if the record is no JSON at all.

    A record is parsed once, to VARIANT.  Texts take any scalar; what is absent or null is null and not
    rejected; of a null record everything is.
    """

    return shred_variant(F.try_parse_json(json), json.isNotNull(), fields)


def shred_variant(v: Column, given: Column, fields: dict[str, tuple[str, str]]) -> Column:
    """``shred`` of a record that is parsed already, best in a projection of its own: branches don't share
    what they compute.  ``given`` says whether there was a record at all.  What a value might be instead is
    only looked at where it has none of its type."""
    out, faults = [], []
    for name, (path, kind) in fields.items():
        value = F.try_variant_get(v, path, kind)
        piece = F.try_variant_get(v, path, "variant")
        if kind == "string":  # lists and objects have texts too
            value = F.when(~(value.rlike(r"^[\[{]") & F.schema_of_variant(piece).rlike("^(?:OBJECT|ARRAY)")), value)
        out.append(value.alias(name))
        faults.append(F.when(value.isNull() & piece.isNotNull() & ~F.is_variant_null(piece), F.lit(path)))
    no_json = F.when(given & v.isNull(), F.lit("$"))
    return F.struct(*out, F.array_compact(F.array(no_json, *faults)).alias("rejected"))
