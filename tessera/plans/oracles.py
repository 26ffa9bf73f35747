"""Independent DuckDB SQL for every SQL-expressible query.

The testbed rules of :mod:`tessera.plans.testbed` are restated here in SQL
(CTEs below), and each oracle computes its answer from the raw tables
without array tricks where a relational form exists (pixels come from
``unnest`` + conditional aggregation, not from array zipping). Divisions use
``nullif`` so a zero denominator is NULL as in Spark's ``try_divide``.
"""

from __future__ import annotations

from tessera.schemas import CODES, LABEL_DICTIONARY, S2_ALL_BANDS
from tessera.plans import params as P

_RULE = "[" + ", ".join(str(c) for c in CODES + [0]) + "]"
_CODE_STRINGS = "[" + ", ".join(f"'{c}'" for c in CODES) + "]"
_DICT_VALUES = ", ".join(f"({c}, {s}, {i})" for i, (c, s, _) in enumerate(LABEL_DICTIONARY))


def _patch_id(k: str) -> str:
    month = f"lpad(CAST(({k}) % 12 + 1 AS VARCHAR), 2, '0')"
    prefix = f"'S2A_MSIL2A_2017' || {month} || '13T101031_N9999_R022_T33UUP'"
    return (f"CASE WHEN ({k}) % 50 = 49 THEN {prefix} || '-' || CAST({k} AS VARCHAR) "
            f"ELSE {prefix} || '_' || CAST(({k}) // 100 AS VARCHAR) || '_' || "
            f"CAST(({k}) % 100 AS VARCHAR) END")


def _s1_name(k: str) -> str:
    month = f"lpad(CAST(({k}) % 12 + 1 AS VARCHAR), 2, '0')"
    return (f"CASE WHEN ({k}) % 97 <> 13 THEN 'S1A_IW_GRDH_1SDV_2017' || {month} || "
            f"'13T165043_33UUP_' || CAST(({k}) // 100 AS VARCHAR) || '_' || "
            f"CAST(({k}) % 100 AS VARCHAR) END")


def _split(k: str) -> str:
    return (f"CASE WHEN ({k}) % 10 < 6 THEN 'train' WHEN ({k}) % 10 < 8 THEN 'test' "
            f"ELSE 'validation' END")


# Long pixel values: one row per (patch number k, band index b, pixel pos).
EMB = f"""emb AS (
  SELECT vec_id // 6 AS k, vec_id % 6 AS b,
         unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos
  FROM embeddings
)"""

# Pixel table of complete patches (all six bands present); label from the rule.
PX = f"""{EMB},
px AS (
  SELECT {_patch_id('k')} AS patch_id, k, CAST(pos AS INTEGER) AS pos,
    max(CASE WHEN b = 0 THEN CAST(v AS DOUBLE) END) AS VV,
    max(CASE WHEN b = 1 THEN CAST(v AS DOUBLE) END) AS VH,
    max(CASE WHEN b = 2 THEN CAST(trunc(CAST(v AS DOUBLE) * 1000 + 2000) AS BIGINT) END) AS B,
    max(CASE WHEN b = 3 THEN CAST(trunc(CAST(v AS DOUBLE) * 1000 + 2000) AS BIGINT) END) AS G,
    max(CASE WHEN b = 4 THEN CAST(trunc(CAST(v AS DOUBLE) * 1000 + 2000) AS BIGINT) END) AS R,
    max(CASE WHEN b = 5 THEN CAST(trunc(CAST(v AS DOUBLE) * 1000 + 2000) AS BIGINT) END) AS NIR,
    CAST({_RULE}[((k * 64 + pos) % 46) + 1] AS BIGINT) AS label
  FROM emb GROUP BY k, pos
  HAVING count(DISTINCT b) = 6
)"""

# Indices over px (NDWI as written unless noted).
IDX = f"""{PX},
idx AS (
  SELECT patch_id, k, pos, VV, VH, B, G, R, NIR, label,
    (NIR - R) / nullif(NIR + R, 0) AS NDVI,
    2.5 * (NIR - R) / nullif(NIR + 6 * R - CAST(7.5 AS DOUBLE) * B + 1, 0) AS EVI,
    (G - NIR) / nullif(G, 0) + NIR AS NDWI,
    G / nullif(NIR, 0) AS BVI,
    VV / nullif(VH, 0) AS RRadio,
    VV - VH AS RDiff,
    VV + VH AS RSum,
    4 * VH / nullif(VH + VV, 0) AS RVI
  FROM px
)"""

# Label dictionary: code, sparse id, dense id.
DICT = f"""dict AS (
  SELECT * FROM (VALUES {_DICT_VALUES}) AS t(ID, ID_NEW, CLASS)
)"""

# Raw + derived metadata from documents.
META = f"""raw AS (
  SELECT {_patch_id('doc_id')} AS patch_id,
    [{_CODE_STRINGS}[(doc_id % {len(CODES)}) + 1]] AS labels,
    {_split('doc_id')} AS split,
    lang AS country,
    {_s1_name('doc_id')} AS s1_name,
    'S2A_MSIL2A_' || CAST(doc_id AS VARCHAR) AS s2v1_name,
    n_chars % 7 = 0 AS contains_seasonal_snow,
    n_chars % 5 = 0 AS contains_cloud_or_shadow,
    CASE WHEN doc_id % 37 = 5 THEN 'file:/data/bigearthnet/' ELSE 's3://bigearthnet/' END AS root,
    doc_id
  FROM documents
),
ids AS (
  SELECT *, nullif(regexp_extract(patch_id, '(.*)_[0-9]+_[0-9]+$', 1), '') AS patch_id_path,
    nullif(regexp_extract(s1_name, '(.*)_[A-Z0-9]+_[0-9]+_[0-9]+$', 1), '') AS patch_id_path_s1
  FROM raw
),
meta AS (
  SELECT patch_id, labels, split, country, s1_name, s2v1_name, contains_seasonal_snow,
    contains_cloud_or_shadow, patch_id_path, patch_id_path_s1,
    root || 'BigEarthNet-S1/' || patch_id_path_s1 || '/' || s1_name || '/' AS s1_path,
    root || 'BigEarthNet-S2/' || patch_id_path || '/' || patch_id || '/' AS s2_path,
    root || 'Reference_Maps/' || patch_id_path || '/' || patch_id || '/' AS label_path,
    (patch_id_path IS NULL OR patch_id_path_s1 IS NULL) AS path_error,
    doc_id
  FROM ids
)"""

# Layout-independent hash32 of a key string with seed.
def hash32(key_sql: str, seed: int = P.SEED) -> str:
    return f"CAST(('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 8)) AS BIGINT)"


def crc32(text_sql: str) -> str:
    """UTF-8 CRC-32 of an ASCII string (DuckDB has none), byte by byte and bit by bit."""
    return (f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({text_sql}, ''), lambda x: ord(x)::BIGINT), "
            "lambda acc, y: list_reduce([xor(acc, y), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], "
            "lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)")


def _strip(c: str) -> str:
    return f"string_split({c}, 's3://')[2]"


def _hms(s: str) -> str:
    return (f"lpad(CAST(({s}) // 3600 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST((({s}) % 3600) // 60 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST(({s}) % 60 AS VARCHAR), 2, '0')")


_BANDS7 = "['VV', 'VH', 'B02', 'B03', 'B04', 'B08', 'reference_map']"
_S2_ALL = "[" + ", ".join(f"'{b}'" for b in S2_ALL_BANDS) + "]"
_FRAC = (f"CASE split WHEN 'train' THEN {P.SAMPLE_FRACTIONS['train']!r} "
         f"WHEN 'test' THEN {P.SAMPLE_FRACTIONS['test']!r} ELSE 0.0 END")

# Train/test elements in hash order with their shard.
ELEMS = f"""{META},
tt AS (SELECT patch_id, split FROM meta WHERE split IN ('train', 'test')),
ordered AS (
  SELECT patch_id, split,
    row_number() OVER (PARTITION BY split ORDER BY {hash32('patch_id')}, patch_id) - 1 AS idx
  FROM tt
),
elems AS (
  SELECT patch_id, split, idx, CAST(idx % {P.N_SHARDS} AS INTEGER) AS shard,
    idx // {P.N_SHARDS} AS shard_pos
  FROM ordered
),
sized AS (SELECT *, count(*) OVER (PARTITION BY split, shard) AS n_shard FROM elems),
rep AS (
  SELECT patch_id, split, shard, rep, rep * n_shard + shard_pos AS pos
  FROM (SELECT *, unnest(range(0, {P.N_REPEATS})) AS rep FROM sized)
)"""

# Per-patch band presence over the raw embeddings rows.
PATCHES = f"""{EMB},
patches AS (
  SELECT k, {_patch_id('k')} AS patch_id, count(DISTINCT b) AS nb, max(CASE WHEN b = 5 THEN 1 ELSE 0 END) AS has_label
  FROM emb GROUP BY k
)"""


def _nearest_src(o: str, in_size: int, out_size: int) -> str:
    return (f"least(CAST(floor((CAST({o} AS FLOAT) + CAST(0.5 AS FLOAT)) * "
            f"(CAST({in_size} AS FLOAT) / CAST({out_size} AS FLOAT))) AS BIGINT), {in_size - 1})")


def _bilinear_in(o: str, in_size: int, out_size: int) -> str:
    return (f"((CAST({o} AS FLOAT) + CAST(0.5 AS FLOAT)) * (CAST({in_size} AS FLOAT) / "
            f"CAST({out_size} AS FLOAT)) - CAST(0.5 AS FLOAT))")


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    T = 8
    O = P.RESIZE_OUT

    q["scan_pruned"] = f"WITH {META} SELECT split, s1_path, s2_path, label_path FROM meta"
    q["filter_isin"] = f"WITH {META} SELECT patch_id, split FROM meta WHERE split IN ('train', 'test')"
    q["split_counts"] = (f"WITH {META} SELECT split, count(*) AS n FROM meta "
                         f"WHERE split IN ('train', 'test') GROUP BY split")
    q["project"] = (f"WITH {META} SELECT patch_id, split, country, contains_seasonal_snow, "
                    f"contains_cloud_or_shadow FROM meta")
    q["derive_paths"] = (f"WITH {META} SELECT patch_id, patch_id_path, patch_id_path_s1, s1_path, "
                         f"s2_path, label_path, path_error FROM meta")
    q["strip_scheme"] = (f"WITH {META} SELECT patch_id, {_strip('s1_path')} AS s1, "
                         f"{_strip('s2_path')} AS s2, {_strip('label_path')} AS label FROM meta")
    q["scheme_prepend"] = f"WITH {META} SELECT patch_id, 's3://' || {_strip('s2_path')} AS s2 FROM meta"
    q["path_string"] = (f"WITH {META} SELECT patch_id, split, "
                        f"s1_path || ' ' || s2_path || ' ' || label_path AS paths FROM meta")
    q["paths_array"] = f"""WITH {META}
SELECT patch_id, CAST(pos AS INTEGER) AS pos, path FROM (
  SELECT patch_id, 0 AS pos, {_strip('s1_path')} AS path FROM meta
  UNION ALL SELECT patch_id, 1, {_strip('s2_path')} FROM meta
  UNION ALL SELECT patch_id, 2, {_strip('label_path')} FROM meta
  UNION ALL SELECT patch_id, 3, patch_id FROM meta
)"""
    bf = "CASE WHEN regexp_matches({d}, '/$') THEN regexp_replace({d}, '([^/]+)/$', '\\1/\\1_{b}.tif') END"
    parts = []
    for sensor, d, bands in (("s1", "s1_path", ["VV", "VH"]), ("s2", "s2_path", ["B02", "B03", "B04", "B08"]),
                             ("label", "label_path", ["reference_map"])):
        for b in bands:
            parts.append(f"SELECT patch_id, '{sensor}' AS sensor, '{b}' AS band, "
                         f"{bf.format(d=d, b=b)} AS path FROM meta")
    # Paths are NULL for every band when any of the three directories is NULL
    # (the path string is NULL then).
    q["band_paths"] = f"""WITH {META},
b AS ({' UNION ALL '.join(parts)}),
nullrow AS (SELECT patch_id, (s1_path IS NULL OR s2_path IS NULL OR label_path IS NULL) AS anynull FROM meta)
SELECT b.patch_id, sensor, band, CASE WHEN anynull THEN NULL ELSE path END AS path
FROM b JOIN nullrow USING (patch_id)"""
    q["band_filter"] = f"""WITH {META},
listing AS (SELECT patch_id, s2_path || patch_id || '_' || unnest({_S2_ALL}) || '.tif' AS path FROM meta)
SELECT patch_id, nullif(regexp_extract(path, '_([A-Za-z0-9]+)\\.tif$', 1), '') AS band, path
FROM listing WHERE regexp_matches(path, '_B0[2348]\\.tif$')"""

    q["stratified_sample"] = f"""WITH {META}
SELECT patch_id, split FROM meta
WHERE split IN ('train', 'test') AND {hash32('patch_id')} < ({_FRAC}) * 4294967296.0"""
    q["exact_sample"] = f"""WITH {ELEMS},
sizes AS (SELECT split, CAST(round_even(count(*) * {P.EXACT_FRACTION!r}, 0) AS BIGINT) AS n FROM tt GROUP BY split)
SELECT o.patch_id, o.split FROM ordered o JOIN sizes s USING (split) WHERE o.idx < s.n"""
    q["limit_k"] = (f"WITH {META} SELECT patch_id, split FROM meta WHERE split IN ('train', 'test') "
                    f"ORDER BY patch_id LIMIT {P.LIMIT_K}")

    q["bands_pivot"] = f"""WITH {PATCHES}
SELECT p.patch_id,
  CAST(p.nb + p.has_label AS INTEGER) AS n_bands,
  CAST(nullif(count(*) FILTER (WHERE e.b = 0), 0) AS INTEGER) AS vv_size,
  CASE WHEN p.has_label = 1 THEN 64 END AS label_size,
  CAST(sum(CAST(trunc(CAST(e.v AS DOUBLE) * 1000 + 2000) AS BIGINT)) FILTER (WHERE e.b = 2) AS BIGINT) AS b_sum,
  CAST(sum(CAST(trunc(CAST(e.v AS DOUBLE) * 1000 + 2000) AS BIGINT)) FILTER (WHERE e.b = 3) AS BIGINT) AS g_sum,
  CAST(sum(CAST(trunc(CAST(e.v AS DOUBLE) * 1000 + 2000) AS BIGINT)) FILTER (WHERE e.b = 4) AS BIGINT) AS r_sum,
  CAST(sum(CAST(trunc(CAST(e.v AS DOUBLE) * 1000 + 2000) AS BIGINT)) FILTER (WHERE e.b = 5) AS BIGINT) AS nir_sum,
  max(CAST(e.v AS DOUBLE)) FILTER (WHERE e.b = 0) AS vv_max,
  min(CAST(e.v AS DOUBLE)) FILTER (WHERE e.b = 1) AS vh_min
FROM patches p JOIN emb e USING (k)
GROUP BY p.patch_id, p.nb, p.has_label"""
    q["missing_bands"] = f"""WITH {PATCHES},
expected AS (SELECT k, patch_id, unnest({_BANDS7}) AS band FROM patches),
present AS (
  SELECT DISTINCT k, ['VV', 'VH', 'B02', 'B03', 'B04', 'B08'][b + 1] AS band FROM emb
  UNION SELECT DISTINCT k, 'reference_map' FROM emb WHERE b = 5
)
SELECT patch_id, band FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.k = e.k AND p.band = e.band)"""
    q["explode_pixels"] = f"WITH {PX} SELECT patch_id, pos, VV, VH, B, G, R, NIR, label FROM px"
    q["indices"] = f"""WITH {IDX}
SELECT patch_id, pos, NDVI, EVI, NDWI, BVI, RRadio, RDiff, RSum, RVI FROM idx"""
    q["ndwi_normalized"] = f"WITH {PX} SELECT patch_id, pos, (G - NIR) / nullif(G + NIR, 0) AS NDWI FROM px"

    q["label_recode"] = f"""WITH {PX}, {DICT}
SELECT patch_id, pos, CAST(d.ID_NEW AS BIGINT) AS label FROM px JOIN dict d ON px.label = d.ID"""
    q["label_unmatched"] = f"""WITH {PX}, {DICT}
SELECT label AS code, count(*) AS n_pixels, count(DISTINCT patch_id) AS n_patches
FROM px WHERE label NOT IN (SELECT ID FROM dict) GROUP BY label"""
    q["label_encode_dense"] = f"""WITH {EMB}, {DICT},
lab AS (
  SELECT {_patch_id('k')} AS patch_id, CAST(pos AS INTEGER) AS pos,
    CAST({_RULE}[((k * 64 + pos) % 46) + 1] AS BIGINT) AS code
  FROM emb WHERE b = 5
)
SELECT patch_id, pos, code, d.CLASS AS class_id FROM lab LEFT JOIN dict d ON lab.code = d.ID"""
    q["features"] = f"""WITH {IDX}, {DICT}
SELECT patch_id, pos, VV, VH, CAST(B AS DOUBLE) AS B, CAST(G AS DOUBLE) AS G, CAST(R AS DOUBLE) AS R,
  CAST(NIR AS DOUBLE) AS NIR, NDVI, EVI, NDWI, BVI, RRadio, RDiff, RSum, RVI, CAST(d.CLASS AS BIGINT) AS label
FROM idx JOIN dict d ON idx.label = d.ID
WHERE VV IS NOT NULL AND VH IS NOT NULL AND B IS NOT NULL AND G IS NOT NULL AND R IS NOT NULL
  AND NIR IS NOT NULL AND NDVI IS NOT NULL AND EVI IS NOT NULL AND NDWI IS NOT NULL AND BVI IS NOT NULL
  AND RRadio IS NOT NULL AND RDiff IS NOT NULL AND RSum IS NOT NULL AND RVI IS NOT NULL
  AND NOT isnan(VV) AND NOT isnan(VH) AND NOT isnan(NDVI) AND NOT isnan(EVI) AND NOT isnan(NDWI)
  AND NOT isnan(BVI) AND NOT isnan(RRadio) AND NOT isnan(RDiff) AND NOT isnan(RSum) AND NOT isnan(RVI)"""

    # float32 radar bands with uint16 optical ones promote to float32.
    q["stack_bands"] = f"""WITH {PATCHES}
SELECT patch_id,
  CASE WHEN nb = 6 THEN 'float32' END AS dtype,
  CASE WHEN nb = 6 THEN 6 END AS channels,
  CASE WHEN nb = 6 THEN {T} END AS height,
  CASE WHEN nb = 6 THEN {T} END AS width,
  CASE WHEN nb = 6 THEN {6 * T * T * 4} END AS n_bytes
FROM patches"""
    q["label_bytes"] = f"""WITH {PATCHES}
SELECT patch_id,
  CASE WHEN has_label = 1 THEN 'uint16' END AS dtype,
  CASE WHEN has_label = 1 THEN 1 END AS channels,
  CASE WHEN has_label = 1 THEN {T} END AS height,
  CASE WHEN has_label = 1 THEN {T} END AS width,
  CASE WHEN has_label = 1 THEN {T * T * 2} END AS n_bytes
FROM patches"""
    q["stack_values"] = f"""WITH {PATCHES}
SELECT patch_id, 'float32' AS dtype, CAST(b AS INTEGER) AS channel, CAST(pos AS INTEGER) AS pos,
  CASE WHEN b < 2 THEN CAST(v AS DOUBLE) ELSE trunc(CAST(v AS DOUBLE) * 1000 + 2000) END AS value
FROM emb JOIN patches USING (k) WHERE nb = 6"""
    q["label_values"] = f"""WITH {EMB}
SELECT {_patch_id('k')} AS patch_id, 'uint16' AS dtype, CAST(pos AS INTEGER) AS pos,
  CAST({_RULE}[((k * 64 + pos) % 46) + 1] AS DOUBLE) AS value
FROM emb WHERE b = 5"""
    q["raster_pixels"] = f"WITH {PX} SELECT patch_id, pos, VV, VH, B, G, R, NIR, label FROM px"
    q["assemble_copies"] = f"""SELECT {_patch_id('k')} AS patch_id, CAST(count(*) AS INTEGER) AS n_bands,
  CASE WHEN k % 7 = 0 THEN count(*) + CAST(bool_or(b = 0) AS BIGINT) ELSE 0 END AS n_copies,
  max(CASE WHEN b = 5 THEN CAST(embedding[1] AS DOUBLE) END) AS b08_first
FROM (SELECT vec_id // 6 AS k, vec_id % 6 AS b, embedding FROM embeddings) GROUP BY k"""
    names6 = "['VV', 'VH', 'B', 'G', 'R', 'NIR']"
    q["rejects"] = f"""WITH {PATCHES},
found AS (SELECT k, list(DISTINCT b) AS bs FROM emb GROUP BY k)
SELECT patch_id, CASE
  WHEN nb < 6 THEN 'missing:' || array_to_string(
    list_transform(list_filter(range(0, 6), lambda x: NOT list_contains(bs, x)), lambda x: {names6}[x + 1])
    || CASE WHEN has_label = 1 THEN [] ELSE ['label'] END, ',')
  ELSE 'size:R' END AS reject_reason
FROM patches JOIN found USING (k)
WHERE nb < 6 OR {crc32('patch_id')} % 5 = 0"""
    q["interleave"] = f"""WITH {PX}
SELECT patch_id, CAST(pos * 6 + c - 1 AS INTEGER) AS idx, value FROM (
  SELECT patch_id, pos,
    unnest([CAST(VV AS FLOAT), CAST(VH AS FLOAT), CAST(B AS FLOAT), CAST(G AS FLOAT), CAST(R AS FLOAT),
            CAST(NIR AS FLOAT)]) AS value,
    generate_subscripts([1, 2, 3, 4, 5, 6], 1) AS c
  FROM px
)"""
    q["resize_nearest"] = f"""WITH {EMB}, {DICT},
lp AS (SELECT DISTINCT k FROM emb WHERE b = 5),
grid AS (SELECT k, unnest(range(0, {O * O})) AS o FROM lp),
src AS (
  SELECT k, o, {_nearest_src(f'o // {O}', T, O)} * {T} + {_nearest_src(f'o % {O}', T, O)} AS s FROM grid
)
SELECT {_patch_id('k')} AS patch_id, CAST(o AS INTEGER) AS pos, CAST(d.CLASS AS FLOAT) AS value
FROM src LEFT JOIN dict d ON d.ID = {_RULE}[((k * 64 + s) % 46) + 1]"""
    yin, xin = _bilinear_in(f"o // {O}", T, O), _bilinear_in(f"o % {O}", T, O)
    q["resize_bilinear"] = f"""WITH {EMB},
tiles AS (
  SELECT k, b, list(CASE WHEN b < 2 THEN CAST(v AS FLOAT)
                         ELSE CAST(trunc(CAST(v AS DOUBLE) * 1000 + 2000) AS FLOAT) END ORDER BY pos) AS px
  FROM emb GROUP BY k, b
),
grid AS (SELECT k, b, px, unnest(range(0, {O * O})) AS o FROM tiles),
c AS (
  SELECT k, b, px, o, {yin} AS yi, {xin} AS xi FROM grid
),
c2 AS (
  SELECT k, b, px, o,
    greatest(CAST(floor(yi) AS BIGINT), 0) AS y0, least(CAST(ceil(yi) AS BIGINT), {T - 1}) AS y1,
    CAST(yi - floor(yi) AS FLOAT) AS yl,
    greatest(CAST(floor(xi) AS BIGINT), 0) AS x0, least(CAST(ceil(xi) AS BIGINT), {T - 1}) AS x1,
    CAST(xi - floor(xi) AS FLOAT) AS xl
  FROM c
),
v AS (
  SELECT k, b, o, xl, yl,
    px[y0 * {T} + x0 + 1] AS tl, px[y0 * {T} + x1 + 1] AS tr,
    px[y1 * {T} + x0 + 1] AS bl, px[y1 * {T} + x1 + 1] AS br
  FROM c2
),
w AS (
  SELECT k, b, o, yl, tl + (tr - tl) * xl AS top, bl + (br - bl) * xl AS bottom FROM v
)
SELECT {_patch_id('k')} AS patch_id, ['VV', 'VH', 'B02', 'B03', 'B04', 'B08'][b + 1] AS band,
  CAST(o AS INTEGER) AS pos, round(CAST(top + (bottom - top) * yl AS DOUBLE), 4) AS value
FROM w"""
    q["shape_check"] = f"""WITH {PATCHES}
SELECT patch_id, CASE WHEN nb = 6 THEN {T * T * 6} END AS n_values, {T * T * 6} AS expected, nb = 6 AS ok
FROM patches"""

    pred = "SELECT CAST(quality AS BIGINT) AS label, CAST(toxic AS BIGINT) AS prediction FROM labels"
    q["confusion"] = f"SELECT label, prediction, count(*) AS n FROM ({pred}) GROUP BY label, prediction"
    q["accuracy"] = (f"SELECT count(*) AS n, CAST(coalesce(sum(CAST(label = prediction AS BIGINT)), 0) AS BIGINT) AS n_correct, "
                     f"CAST(coalesce(sum(CAST(label = prediction AS BIGINT)), 0) AS DOUBLE) / "
                     f"nullif(count(*), 0) AS accuracy FROM ({pred})")
    iou = f"""p AS ({pred}),
cls AS (SELECT label AS c FROM p UNION SELECT prediction FROM p),
per AS (
  SELECT c AS class_id,
    (SELECT count(*) FROM p WHERE label = c AND prediction = c) AS intersection,
    (SELECT count(*) FROM p WHERE label = c OR prediction = c) AS "union"
  FROM cls
),
iou AS (
  SELECT class_id, intersection, "union",
    (CAST(intersection AS DOUBLE) + {P.SMOOTH!r}) / (CAST("union" AS DOUBLE) + {P.SMOOTH!r}) AS iou
  FROM per
)"""
    q["iou_per_class"] = f'WITH {iou} SELECT class_id, intersection, "union", iou FROM iou'
    q["iou_mean"] = f"WITH {iou} SELECT count(*) AS n_classes, avg(iou) AS iou_score FROM iou"
    q["jaccard_loss"] = f"WITH {iou} SELECT count(*) AS n_classes, 1.0 - avg(iou) AS jaccard_loss FROM iou"

    soft = f"""prob AS (
  SELECT vec_id, CAST(label AS BIGINT) AS label, list_transform(embedding[1:10], lambda v: exp(CAST(v AS DOUBLE) * 10)) AS s FROM embeddings),
cells AS (
  SELECT label, unnest(range(0, 10)) AS class_id, unnest(list_transform(s, lambda x: x / list_sum(s))) AS p FROM prob)"""
    soft_per = """SELECT class_id, sum(CASE WHEN label = class_id THEN p ELSE 0 END) AS i,
  count(*) FILTER (WHERE label = class_id) + sum(p) - sum(CASE WHEN label = class_id THEN p ELSE 0 END) AS u FROM cells"""
    q["soft_iou"] = f"""WITH {soft}, per AS ({soft_per} GROUP BY class_id)
SELECT class_id, round(i, 6) AS intersection, round(u, 6) AS "union", round((i + {P.SMOOTH!r}) / (u + {P.SMOOTH!r}), 6) AS iou FROM per"""
    q["soft_jaccard"] = f"""WITH {soft},
per AS ({soft_per} WHERE label <> {P.SOFT_IGNORE} AND class_id <> {P.SOFT_IGNORE} GROUP BY class_id)
SELECT count(*) AS n_classes, round(avg((i + {P.SMOOTH!r}) / (u + {P.SMOOTH!r})), 6) AS iou_score,
  round(1 - avg((i + {P.SMOOTH!r}) / (u + {P.SMOOTH!r})), 6) AS jaccard_loss FROM per"""
    feats = ["NDVI", "EVI", "NDWI", "BVI", "RRadio", "RDiff", "RSum", "RVI"]
    valid = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in ["VV", "VH", *feats])
    split_idx = f"""{IDX}, {META},
sx AS (SELECT idx.*, meta.split FROM idx JOIN meta ON meta.patch_id = idx.patch_id WHERE split IN ('train', 'test'))"""
    q["pixel_counts"] = f"""WITH {split_idx}, {DICT}
SELECT split, count(DISTINCT patch_id) AS n_patches, count(*) AS n_pixels, count(*) FILTER (WHERE label IN (SELECT ID FROM dict)) AS n_known,
  count(*) FILTER (WHERE label IN (SELECT ID FROM dict) AND {valid}) AS n_valid
FROM sx GROUP BY split"""
    q["forest_checked"] = f"""WITH {split_idx}
SELECT labels, count(*) AS n_test, labels = 'determined' AS passes
FROM sx, (VALUES ('determined'), ('scrambled')) AS t(labels) WHERE split = 'test' AND {valid} GROUP BY labels"""
    q["scan_pushed"] = f"SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN {P.ORDER_STATUS!r}"

    q["best_epoch"] = """WITH h AS (
  SELECT event_type AS run, value AS loss,
    CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS INTEGER) AS epoch
  FROM events
)
SELECT run, min({'v': loss, 'e': epoch}) FILTER (WHERE loss IS NOT NULL).e AS best_epoch,
  min({'v': loss, 'e': epoch}) FILTER (WHERE loss IS NOT NULL).v AS best_loss,
  count(*) AS n_epochs
FROM h GROUP BY run"""
    secs = "(epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000"
    q["run_metrics"] = f"""SELECT event_type AS run, count(*) AS n_epochs,
  strftime(min(ts), '%H:%M:%S') AS started, strftime(max(ts), '%H:%M:%S') AS finished,
  {secs} AS seconds, {_hms(secs)} AS runtime,
  round(avg(value), 6) AS mean_loss, min(value) AS min_loss
FROM events GROUP BY event_type"""

    q["run_speed_ups"] = f"""WITH s AS (SELECT event_type AS run, {secs} AS seconds FROM events GROUP BY event_type)
SELECT run, seconds, round((SELECT CAST(seconds AS DOUBLE) FROM s WHERE run = '{P.BASELINE_RUN}') / nullif(seconds, 0), 6) AS speed_up FROM s"""
    q["run_logs"] = f"""WITH r AS (
  SELECT event_type AS run, count(*) AS n, count(*) FILTER (WHERE value > 0.5) AS m, count(DISTINCT date_trunc('hour', ts)) * 60 + 7 AS fit
  FROM events GROUP BY event_type)
SELECT run, n AS train_rows, m AS test_rows, fit AS fit_seconds, CAST(123 AS BIGINT) AS evaluation_seconds, CAST(NULL AS BIGINT) AS main_seconds,
  round(CAST(m AS DOUBLE) / n, 4) AS accuracy, round((SELECT CAST(fit AS DOUBLE) FROM r WHERE run = '{P.BASELINE_RUN}') / fit, 6) AS speed_up
FROM r"""
    resized = q["resize_bilinear"].rsplit("SELECT", 1)
    image = resized[0].removeprefix("WITH ") + f""",
image AS (SELECT {_patch_id('k')} AS patch_id, 'image' AS kind, CAST(o * 6 + b AS INTEGER) AS pos, round(CAST(top + (bottom - top) * yl AS DOUBLE), 4) AS value FROM w),
label AS ({q["resize_nearest"].replace("WITH " + EMB + ", " + DICT + ",", "WITH lab_" + DICT + ",").replace("JOIN dict", "JOIN lab_dict")})"""
    q["training_values"] = f"""WITH {ELEMS}, {image},
whole AS (SELECT {_patch_id('k')} AS patch_id FROM emb GROUP BY k HAVING count(DISTINCT b) = 6),
vals AS (SELECT * FROM image UNION ALL SELECT patch_id, 'label', pos, CAST(value AS DOUBLE) FROM label),
sides AS (SELECT e.*, w.patch_id IS NOT NULL AS complete, kind FROM elems e LEFT JOIN whole w USING (patch_id), (VALUES ('image'), ('label')) AS t(kind))
SELECT s.patch_id, s.split, s.shard, s.idx, s.complete, s.kind, v.pos, v.value
FROM sides s LEFT JOIN vals v ON s.complete AND v.patch_id = s.patch_id AND v.kind = s.kind"""

    q["shards"] = f"WITH {ELEMS} SELECT patch_id, split, idx, shard, shard_pos FROM elems"
    q["repeat"] = f"WITH {ELEMS} SELECT patch_id, split, shard, CAST(rep AS INTEGER) AS rep, pos FROM rep"
    q["batches"] = f"""WITH {ELEMS}
SELECT patch_id, split, shard, CAST(rep AS INTEGER) AS rep, pos, pos // {P.BATCH_SIZE} AS batch_id,
  CAST(pos % {P.BATCH_SIZE} AS INTEGER) AS slot FROM rep"""
    return q
