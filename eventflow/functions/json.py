"""Strict reading of JSON texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_document(text: Column) -> Column:
    """The text as a variant, null unless it is exactly one JSON value.

    ``try_parse_json`` stops after the first complete value and ignores what follows. Placed
    inside an object and inside an array, a value with anything after it breaks one of both.
    """
    in_object = F.try_parse_json(F.concat(F.lit('{"document":'), text, F.lit("}")))
    in_array = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(in_array == 1, F.try_variant_get(in_object, "$.document", "variant"))
