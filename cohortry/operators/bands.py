"""Value bands from a reference table: band column, range join and audit.

A band holds ``lower <= value < upper``. A band whose limits are unknown, NaN or not in
order holds nothing, and neither does any band hold an unknown value or NaN.

Up to ``MAX_INDEXED_BANDS`` bands become an interval index on the driver: the band table's
limits cut the value axis into segments, and the starts in order with the running maximum
of the ends give the bands over each segment. A row finds its segment by binary search
inside the scan's stage and its bands by a broadcast hash join on the segment's number.
Longer tables, tables that overlap too much for that, and numbers which doubles can't tell
apart are joined by cells, as wide as the bands they hold: see ``_matches``.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, ShortType

from cohortry.functions.expressions import count_where

# Up to this many bands become one CASE expression when only the first is wanted.
MAX_CASE_BANDS = 64
# Up to this many bands are collected and indexed; a band row is some tens of bytes.
MAX_INDEXED_BANDS = 10_000
# Rows of an index (a segment and one of its bands), and steps taken to build it.
MAX_INDEX_ROWS = 100_000
MAX_INDEX_STEPS = 5_000_000
# Values that hold at least one row in so many are joined apart from the rest.
HOT_VALUES = 200
# Matches of hot values are broadcast up to this many.
MAX_HOT_MATCHES = 100_000
# Bands without an end meet all values: these are dealt over so many shares.
OPEN_SHARES = 64
OPEN = 5_000  # stands for the width's exponent of such bands

EXACT_TYPES = (DoubleType, FloatType, IntegerType, ShortType, ByteType)

Bands = list[tuple[float, float, int]]


def _usable(bands: DataFrame) -> DataFrame:
    """The bands that can hold a value, renamed apart from the other side's columns."""
    ref = bands.select(*[F.col(c).alias(f"ref_{c}") for c in bands.columns])
    limits = [F.col(c).cast("double") for c in ("ref_lower", "ref_upper")]
    return ref.where((F.col("ref_lower") < F.col("ref_upper")) & ~F.isnan(limits[0]) & ~F.isnan(limits[1]))


def _inside(value: Column) -> Column:
    return (value >= F.col("ref_lower")) & (value < F.col("ref_upper")) & ~F.isnan(value.cast("double"))


def _exact(df: DataFrame, *columns: str) -> bool:
    return all(isinstance(df.schema[c].dataType, EXACT_TYPES) for c in columns)


def interval_index(bands: Bands, max_rows: int = MAX_INDEX_ROWS, max_steps: int = MAX_INDEX_STEPS) -> tuple[list[float], list[list[int]]] | None:
    """(segment starts, numbers of the bands over each), or None if the bands overlap too much.

    Segments lie between neighbouring limits; the first begins at minus infinity. From the last band
    that starts at or before a segment the starts are walked back as far as an earlier end reaches it.
    """
    order = sorted(range(len(bands)), key=lambda i: bands[i][0])
    starts = [bands[i][0] for i in order]
    reach = list(accumulate((bands[i][1] for i in order), max))
    cuts = sorted({x + 0.0 for lower, upper, _ in bands for x in (lower, upper) if math.isfinite(x)})
    segments = [-math.inf, *cuts]
    over: list[list[int]] = []
    rows = steps = 0
    for x in segments:
        found, i = [], bisect_right(starts, x) - 1
        while i >= 0 and reach[i] > x:
            if bands[order[i]][1] > x:
                found.append(order[i])
            i -= 1
            steps += 1
        rows += len(found)
        if rows > max_rows or steps > max_steps:
            return None
        over.append(found)
    return segments, over


def _with_segment(df: DataFrame, column: str, segments: list[float], out: str) -> DataFrame:
    """Add the number of the segment that holds the value; null for a value in no band for certain."""
    number = F.col(column).cast("double")
    unknown = number.isNull() | F.isnan(number) | (number == math.inf)
    if len(segments) < 2:
        return df.withColumn(out, F.when(~unknown, 0))
    finder = Bucketizer(splits=[*segments, math.inf], inputCol="_number", outputCol="_cell")
    marked = finder.transform(df.withColumn("_number", F.when(unknown, F.lit(0.0)).otherwise(number + F.lit(0.0))))
    return marked.withColumn(out, F.when(~unknown, F.col("_cell").cast("int"))).drop("_number", "_cell")


def band_by_reference(
    df: DataFrame, column: str, bands: DataFrame, out: str, expected: int | None = None,
    max_case: int = MAX_CASE_BANDS, max_indexed: int = MAX_INDEXED_BANDS,
) -> DataFrame:
    """First band (by code) whose half-open interval holds the value; none or null gives null.

    ``bands`` has ``band_code, lower, upper``; bands without a code name nothing and are left
    out. A handful of bands becomes one CASE expression inside the scan's stage; of a longer
    table each segment of the interval index keeps its first code. The result doesn't depend on the form.
    """
    coded = bands.select("band_code", "lower", "upper").where(F.col("band_code").isNotNull())
    most = max(max_case, max_indexed)
    found = coded.limit(most + 1).collect()
    if expected is not None and len(found) != expected:
        raise ValueError(f"expected {expected} bands in the reference table")
    known = lambda x: x is not None and not math.isnan(x)
    rows = sorted((r for r in found if known(r["lower"]) and known(r["upper"]) and r["lower"] < r["upper"]), key=lambda r: r["band_code"])
    value = F.col(column)
    if len(found) <= max_case:
        band = F.lit(None).cast("int")
        for row in reversed(rows):
            inside = (value >= row["lower"]) & (value < row["upper"])
            band = F.when(inside, int(row["band_code"])).otherwise(band)
        return df.withColumn(out, band)

    exact = _exact(df, column) and _exact(bands, "lower", "upper")
    index = interval_index([(float(r["lower"]), float(r["upper"]), 0) for r in rows]) if exact and len(found) <= max_indexed else None
    if index is not None:
        segments, over = index
        firsts = [(i, int(rows[min(numbers)]["band_code"])) for i, numbers in enumerate(over) if numbers]
        table = df.sparkSession.createDataFrame(firsts, "_at int, _first int")
        placed = _with_segment(df, column, segments, "_segment")
        joined = placed.join(F.broadcast(table), F.col("_segment") == F.col("_at"), "left")
        return joined.select(*df.columns, F.col("_first").alias(out))
    matches = _matches(df, _usable(coded), column).groupBy("_value").agg(F.min("ref_band_code").cast("int").alias(out))
    return _join_back(df, matches, column, [out])


def range_join(
    df: DataFrame, bands: DataFrame, column: str, max_indexed: int = MAX_INDEXED_BANDS
) -> DataFrame:
    """Left outer join of ``lower <= value < upper``; overlapping bands all match.

    The band table is counted first. Up to ``max_indexed`` bands the large side is not
    shuffled: it looks up the interval index, which is broadcast. Otherwise the distinct values
    meet the bands by cells, and rows find their value's matches.
    """
    ref = _usable(bands)
    renamed = [F.col(f"ref_{c}").alias(c) for c in bands.columns]
    found = ref.limit(max_indexed + 1).collect() if _exact(df, column) and _exact(bands, "lower", "upper") else None
    if found is not None and len(found) <= max_indexed:
        index = interval_index([(float(r["ref_lower"]), float(r["ref_upper"]), 0) for r in found])
        if index is not None:
            segments, over = index
            rows = [(i, *found[n]) for i, numbers in enumerate(over) for n in numbers]
            schema = ", ".join(["_at int", *(f"{f.name} {f.dataType.simpleString()}" for f in ref.schema)])
            table = df.sparkSession.createDataFrame(rows, schema)
            placed = _with_segment(df, column, segments, "_segment")
            joined = placed.join(F.broadcast(table), F.col("_segment") == F.col("_at"), "left")
            return joined.select(*df.columns, *renamed)
    return _join_back(df, _matches(df, ref, column), column, ref.columns).select(*df.columns, *renamed)


def _matches(df: DataFrame, ref: DataFrame, column: str) -> DataFrame:
    """``_value`` and the band's columns for every distinct value and every band that holds it.

    Bands are sorted into classes by width; a class cuts the axis into cells twice as wide at most as
    its bands, so that a band touches two cells, or three by rounding, however bands overlap. A value looks
    into one cell per class that the table has, an equi-join which a value held by many rows enters once.
    """
    lower, upper = F.col("ref_lower").cast("double") + F.lit(0.0), F.col("ref_upper").cast("double") + F.lit(0.0)
    # No finer than doubles of that size differ, lest cells have no number.
    width = F.greatest(upper - lower, F.abs(lower) * 2.0**-52, F.abs(upper) * 2.0**-52, F.lit(2.0**-1000))
    class_of = F.when(width < 2.0**1000, F.ceil(F.log2(width)).cast("int")).otherwise(OPEN)
    ref = ref.withColumn("_class", class_of)
    classes = [r["_class"] for r in ref.select("_class").distinct().collect()]  # some 2,000 exponents at most

    def cell(number: Column) -> Column:
        scaled = number / F.pow(F.lit(2.0), F.col("_class"))
        return F.floor(F.least(F.greatest(scaled, F.lit(-(2.0**62))), F.lit(2.0**62))).cast("bigint")

    is_open = F.col("_class") == OPEN
    touched = F.when(is_open, F.sequence(F.lit(0).cast("bigint"), F.lit(OPEN_SHARES - 1).cast("bigint"))).otherwise(F.sequence(cell(lower), cell(upper)))
    ref = ref.select("*", F.explode(touched).alias("_cell")).withColumnsRenamed({"_class": "_ref_class", "_cell": "_ref_cell"})
    number = F.col("_value").cast("double")
    values = df.select(F.col(column).alias("_value")).where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).distinct()
    values = values.select("_value", F.explode(F.lit(classes).cast("array<int>")).alias("_class"))
    own = F.when(is_open, F.pmod(F.xxhash64("_value"), F.lit(OPEN_SHARES)).cast("bigint")).otherwise(cell(number + F.lit(0.0)))
    values = values.withColumn("_cell", own)
    met = (F.col("_class") == F.col("_ref_class")) & (F.col("_cell") == F.col("_ref_cell")) & _inside(F.col("_value"))
    return values.join(ref, met).drop("_class", "_cell", "_ref_class", "_ref_cell")


def _join_back(df: DataFrame, matches: DataFrame, column: str, columns: list[str]) -> DataFrame:
    """Every row with the matches of its value, or nulls.

    Values that hold one row in ``HOT_VALUES`` or more, so at most as many, are joined apart: their rows
    stay where they are and their matches are broadcast. Rows without a value are not joined.
    """
    value = F.col(column)
    missing = value.isNull() | F.isnan(value.cast("double"))
    counts = df.where(~missing).groupBy(value.alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.where(~missing).count()
    hot = [r["_value"] for r in counts.where(F.col("_n") * HOT_VALUES >= total).where(F.col("_n") > 1).collect()]
    names = [*df.columns, *columns]
    kinds = {c: matches.schema[c].dataType for c in columns}
    out = df.where(missing).select(*df.columns, *[F.lit(None).cast(kinds[c]).alias(c) for c in columns])
    is_hot = value.isin(*hot) if hot else F.lit(False)
    rest = df.where(~missing & ~is_hot).join(matches, value == F.col("_value"), "left").select(*names)
    out = out.unionByName(rest)
    if hot:
        theirs = matches.where(F.col("_value").isin(*hot))
        if theirs.count() <= MAX_HOT_MATCHES:
            theirs = F.broadcast(theirs)
        out = out.unionByName(df.where(~missing & is_hot).join(theirs, value == F.col("_value"), "left").select(*names))
    return out


def audit_bands(df: DataFrame, bands: DataFrame, column: str, band_column: str) -> DataFrame:
    """One row: known values joined, values in no band, values whose stored band differs.

    As many rows are checked as the join returns: a value in two overlapping bands is
    checked against both, which is how an overlap shows up as a mismatch.
    """
    known = df.where(F.col(column).isNotNull()).select(column, F.col(band_column).alias("_stored"))
    joined = range_join(known, bands, column)
    return joined.agg(
        F.count("*").alias("rows_checked"),
        count_where(F.col("band_code").isNull()).alias("rows_unmapped"),
        count_where(F.col("_stored") != F.col("band_code")).alias("rows_mismatched"),
    )


def require_clean_bands(audit: DataFrame) -> None:
    row = audit.first()
    if row["rows_unmapped"] or row["rows_mismatched"]:
        raise ValueError(
            f"bands disagree with the reference: {row['rows_unmapped']} unmapped, "
            f"{row['rows_mismatched']} mismatched"
        )
