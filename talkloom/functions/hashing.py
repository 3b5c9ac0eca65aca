"""Short content hashes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StringType


def short_hash(canonical_json: Column) -> Column:
    """First 12 hex digits of the SHA-1 of an already canonical JSON text."""
    return F.substring(F.sha1(canonical_json), 1, 12)


def item_hashes(payload: Column) -> Column:
    """Short hash of every element of ``results`` in a JSON payload, by position.

    NULL where the text is not one JSON document (text after its end included, which
    VARIANT overlooks); an empty list where a document has no such list.

    VARIANT drops the difference between 1 and 1.0, which the hash must keep, so
    the canonical form is taken from the raw payload in Arrow batches. Only upload
    rows that carry a payload reach it.
    """

    def hashes(payloads: pd.Series) -> pd.Series:
        import hashlib
        import json

        def one(text):
            try:
                document = json.loads(text)
            except (TypeError, ValueError, RecursionError):
                return None
            results = document.get("results") if isinstance(document, dict) else None
            listed = results if isinstance(results, list) else []
            canonical = [json.dumps(x, ensure_ascii=False, sort_keys=True) for x in listed]
            return [hashlib.sha1(c.encode("utf-8", "surrogatepass")).hexdigest()[:12] for c in canonical]

        return payloads.map(one)

    return F.pandas_udf(hashes, ArrayType(StringType()))(payload)
