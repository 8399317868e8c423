"""Map lookup (X13): state code -> region."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, DataFrame
from pyspark.sql import functions as F

from lakeflux.sources.files import literal_table

# --- fixed values -----------------------------------------------------------
# Brazilian state code -> region. Same entries and order as the original
# table, with two corrections: BR-MA is spelt "Nordeste" (the original has a
# typo) and the two states it lacks, BR-RJ and BR-PI, are added at the end.
STATE_REGION = [
    ("BR-RS", "Sul"),
    ("BR-RR", "Norte"),
    ("BR-MT", "Centro-Oeste"),
    ("BR-SP", "Sudeste"),
    ("BR-AC", "Norte"),
    ("BR-MS", "Centro-Oeste"),
    ("BR-PE", "Nordeste"),
    ("BR-AM", "Norte"),
    ("BR-CE", "Nordeste"),
    ("BR-AP", "Norte"),
    ("BR-MA", "Nordeste"),
    ("BR-BA", "Nordeste"),
    ("BR-TO", "Norte"),
    ("BR-RO", "Norte"),
    ("BR-GO", "Centro-Oeste"),
    ("BR-SE", "Nordeste"),
    ("BR-RN", "Nordeste"),
    ("BR-MG", "Sudeste"),
    ("BR-ES", "Sudeste"),
    ("BR-PR", "Sul"),
    ("BR-DF", "Centro-Oeste"),
    ("BR-SC", "Sul"),
    ("BR-PA", "Norte"),
    ("BR-AL", "Nordeste"),
    ("BR-PB", "Nordeste"),
    ("BR-RJ", "Sudeste"),
    ("BR-PI", "Nordeste"),
]
# ---------------------------------------------------------------------------


def region_of(state: str | Column) -> Column:
    """``map[state]`` with a literal map; a missing key gives null."""
    col = F.col(state) if isinstance(state, str) else state
    pairs = []
    for code, region in STATE_REGION:
        pairs += [F.lit(code), F.lit(region)]
    return F.try_element_at(F.create_map(*pairs), col)


def region_dimension(spark: SparkSession) -> DataFrame:
    """The same mapping as a 27-row dimension table (fixed size)."""
    return literal_table(spark, STATE_REGION, "state string, region string")
