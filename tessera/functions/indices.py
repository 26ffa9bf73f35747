"""Spectral (Sentinel-2) and radar (Sentinel-1) indices as native expressions.

Inputs are raw digital numbers: S2 bands bigint, S1 bands double. Every
division is ``try_divide`` so a zero denominator gives NULL instead of an
ANSI ``DIVIDE_BY_ZERO`` error; later feature assembly drops such pixels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NDWI_AS_WRITTEN = "as_written"
NDWI_NORMALIZED = "normalized"


def ndvi(nir: Column, red: Column) -> Column:
    return F.try_divide(nir - red, nir + red)


def evi(nir: Column, red: Column, blue: Column) -> Column:
    return F.try_divide(F.lit(2.5) * (nir - red),
                        nir + F.lit(6) * red - F.lit(7.5) * blue + F.lit(1))


def ndwi(green: Column, nir: Column, variant: str = NDWI_AS_WRITTEN) -> Column:
    """``as_written``: (G - NIR) / G + NIR, the formula the original pipeline
    trains on (the denominator lacks its parentheses). ``normalized``: the
    textbook (G - NIR) / (G + NIR)."""
    if variant == NDWI_AS_WRITTEN:
        return F.try_divide(green - nir, green) + nir
    if variant == NDWI_NORMALIZED:
        return F.try_divide(green - nir, green + nir)
    raise ValueError(f"unknown NDWI variant {variant!r}")


def bvi(green: Column, nir: Column) -> Column:
    return F.try_divide(green, nir)


def radar_ratio(vv: Column, vh: Column) -> Column:
    return F.try_divide(vv, vh)


def radar_diff(vv: Column, vh: Column) -> Column:
    return vv - vh


def radar_sum(vv: Column, vh: Column) -> Column:
    return vv + vh


def rvi(vv: Column, vh: Column) -> Column:
    return F.try_divide(F.lit(4) * vh, vh + vv)


def index_columns(ndwi_variant: str = NDWI_AS_WRITTEN, vv: str = "VV", vh: str = "VH",
                  blue: str = "B", green: str = "G", red: str = "R",
                  nir: str = "NIR") -> dict[str, Column]:
    """The eight index columns, keyed by output name, in feature order."""
    VV, VH, B, G, R, NIR = (F.col(c) for c in (vv, vh, blue, green, red, nir))
    return {
        "NDVI": ndvi(NIR, R),
        "EVI": evi(NIR, R, B),
        "NDWI": ndwi(G, NIR, ndwi_variant),
        "BVI": bvi(G, NIR),
        "RRadio": radar_ratio(VV, VH),
        "RDiff": radar_diff(VV, VH),
        "RSum": radar_sum(VV, VH),
        "RVI": rvi(VV, VH),
    }


def with_indices(pixels: DataFrame, ndwi_variant: str = NDWI_AS_WRITTEN) -> DataFrame:
    """Append NDVI, EVI, NDWI, BVI, RRadio, RDiff, RSum, RVI (one projection)."""
    return pixels.withColumns(index_columns(ndwi_variant))
