"""Record keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from talkloom.functions.text import strip


def _joined(*parts: Column | str) -> Column:
    return F.concat_ws("|", *[strip(p) for p in parts])


def extraction_key(platform: Column | str = "platform", id_: Column | str = "id") -> Column:
    return _joined(platform, id_)


def row_key(
    platform: Column | str = "platform",
    category: Column | str = "category",
    id_: Column | str = "id",
    associated_id: Column | str = "associated_id",
) -> Column:
    return _joined(platform, category, id_, associated_id)
