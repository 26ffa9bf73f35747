"""Storage-path expressions for patch directories and band files.

All of them are native, NULL-propagating and ANSI-safe: a regex miss gives
NULL (never ``''`` and never an exception), a missing scheme gives NULL,
an out-of-range array index gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.schemas import (BAND_FILE_TEMPLATE, LABEL_BAND, LABEL_PRODUCT_DIR, LAST_DIR_REGEX,
                             S1_BANDS, S1_PRODUCT_DIR, S2_BAND_FILE_REGEX, S2_BANDS, S2_PRODUCT_DIR,
                             SCENE_ID_REGEX, SCHEME, TILE_ID_REGEX)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_or_null(c: str | Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that returns NULL instead of '' on a miss."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def tile_id(patch_id: str | Column) -> Column:
    """Patch id without its trailing ``_row_col`` suffix (F1)."""
    return extract_or_null(patch_id, TILE_ID_REGEX)


def scene_id(s1_name: str | Column) -> Column:
    """S1 product name without its trailing ``_TILE_row_col`` suffix (F2)."""
    return extract_or_null(s1_name, SCENE_ID_REGEX)


def derive_paths(meta: DataFrame, root: str | Column, patch_col: str = "patch_id",
                 s1_col: str = "s1_name") -> DataFrame:
    """Add patch_id_path, patch_id_path_s1, s1_path, s2_path, label_path (F1-F3)
    and ``path_error`` (true when either id did not parse). ``root`` is the
    dataset root ending in '/', a literal or a per-row column. A path whose
    id did not parse is NULL (never a half-built string)."""
    r = F.lit(root) if isinstance(root, str) else root
    return (
        meta.withColumn("patch_id_path", tile_id(patch_col))
        .withColumn("patch_id_path_s1", scene_id(s1_col))
        .withColumn("s1_path", F.concat(r, F.lit(S1_PRODUCT_DIR), F.col("patch_id_path_s1"),
                                        F.lit("/"), F.col(s1_col), F.lit("/")))
        .withColumn("s2_path", F.concat(r, F.lit(S2_PRODUCT_DIR), F.col("patch_id_path"),
                                        F.lit("/"), F.col(patch_col), F.lit("/")))
        .withColumn("label_path", F.concat(r, F.lit(LABEL_PRODUCT_DIR), F.col("patch_id_path"),
                                           F.lit("/"), F.col(patch_col), F.lit("/")))
        .withColumn("path_error", F.col("patch_id_path").isNull() | F.col("patch_id_path_s1").isNull())
    )


def strip_scheme(path: str | Column, scheme: str = SCHEME) -> Column:
    """The part after ``scheme``; NULL when the path does not contain it (F4)."""
    return F.get(F.split(_col(path), _regex_quote(scheme)), 1)


def add_scheme(path: str | Column, scheme: str = SCHEME) -> Column:
    """Prefix ``scheme`` to a listed path (F5)."""
    return F.concat(F.lit(scheme), _col(path))


def paths_string(s1: str | Column, s2: str | Column, label: str | Column) -> Column:
    """Three directory paths joined by one space; NULL if any is NULL (F6)."""
    return F.concat(_col(s1), F.lit(" "), _col(s2), F.lit(" "), _col(label))


def split_paths_string(paths: str | Column) -> Column:
    """Inverse of :func:`paths_string`: struct(s1, s2, label)."""
    parts = F.split(_col(paths), " ")
    return F.struct(F.get(parts, 0).alias("s1"), F.get(parts, 1).alias("s2"),
                    F.get(parts, 2).alias("label"))


def paths_array(*cols: str | Column) -> Column:
    """Positional path array, e.g. [s1, s2, label] or [s1, s2, label, patch_id] (N1)."""
    return F.array(*[_col(c) for c in cols])


def band_file(directory: str | Column, band: str) -> Column:
    """``.../X/`` -> ``.../X/X_<band>.tif`` (F7-F9). A directory without the
    trailing '/' has no file name to derive: NULL."""
    d = _col(directory)
    return F.when(d.rlike("/$"), F.regexp_replace(d, LAST_DIR_REGEX, BAND_FILE_TEMPLATE.format(band=band)))


def band_files(paths: str | Column) -> Column:
    """Path string -> struct(s1: [VV, VH], s2: [B02, B03, B04, B08],
    label: [reference_map]) of file paths, named bands in fixed order (F10)."""
    p = split_paths_string(paths)
    return F.struct(
        F.array(*[band_file(p["s1"], b) for b in S1_BANDS]).alias("s1"),
        F.array(*[band_file(p["s2"], b) for b in S2_BANDS]).alias("s2"),
        F.array(band_file(p["label"], LABEL_BAND)).alias("label"),
    )


def band_file_rows(df: DataFrame, paths_col: str = "paths", keep: list[str] | None = None) -> DataFrame:
    """One row per (patch, band): band name, sensor group and file path. The
    string is split once and each directory's last name taken once; its files are
    that directory, name and band put together, as in :func:`band_file`."""
    keep = keep or []
    groups = (("s1", S1_BANDS), ("s2", S2_BANDS), ("label", [LABEL_BAND]))
    split = df.select(*keep, split_paths_string(paths_col).alias("_d"))
    named = split.select(*keep, *[F.col(f"_d.{g}").alias(f"_{g}") for g, _ in groups],
                         *[F.regexp_extract(F.col(f"_d.{g}"), LAST_DIR_REGEX, 1).alias(f"_{g}_last") for g, _ in groups])

    def path(g: str, band: str) -> Column:
        d, last = F.col(f"_{g}"), F.col(f"_{g}_last")
        tail = BAND_FILE_TEMPLATE.format(band=band).split("/$1", 1)[1]
        return F.when(last != "", F.concat(d, last, F.lit(tail))).when(d.endswith("/"), d)

    entries = [F.struct(F.lit(g).alias("sensor"), F.lit(b).alias("band"), path(g, b).alias("path")) for g, bands in groups for b in bands]
    return named.select(*keep, F.inline(F.array(*entries)))


def is_s2_band_file(path: str | Column, pattern: str = S2_BAND_FILE_REGEX) -> Column:
    """True for the S2 band files the classifier reads (F11)."""
    return _col(path).rlike(pattern)


def band_name(path: str | Column) -> Column:
    """Band token of a band file name (``..._B08.tif`` -> ``B08``), or NULL."""
    return extract_or_null(path, r"_([A-Za-z0-9]+)\.tif$")


def _regex_quote(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch)
    return "".join(out)
