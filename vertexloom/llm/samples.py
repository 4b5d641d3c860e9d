"""Bounded, repeatable samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(of))


def sample(rows: DataFrame, label: str, per_label: int, most_rows: int, by: tuple[str, ...] = ("id",), seed: int = 7) -> DataFrame:
    """About ``per_label`` rows of each label, all of rarer ones, at most twice as many; fewer of each where there are so many labels that it would be over ``most_rows``.

    ``rows`` has the columns ``by`` and ``label``, all without nulls; a hash
    of ``by`` alone decides, so the same table gives the same rows in any
    order. Repeated rows count once. No label is left out.
    """
    counts = rows.groupBy(label).count().collect()  # a row for each label, as the classifier has
    if not counts:
        return rows.limit(0)
    per_label = max(1, min(per_label, most_rows // len(counts)))
    share = F.create_map(*[F.lit(x) for row in counts for x in (row[0], min(1.0, per_label / row[1]))])
    hashed = F.xxhash64(F.concat_ws("\x00", *[F.col(c).cast("string") for c in by]), F.lit(seed))
    place = F.pmod(hashed, F.lit(1 << 40)) / F.lit(float(1 << 40))
    return rows.filter(place < F.element_at(share, F.col(label))).dropDuplicates([*by, label]).limit(2 * per_label * len(counts))
