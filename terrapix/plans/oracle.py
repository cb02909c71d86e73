"""DuckDB twins of the registered queries (the correctness oracle).

Each entry is plain SQL over the benchmark tables; the derived inputs are
written out as CTEs with the same integer arithmetic as
``terrapix.sources.derived``.
"""

from __future__ import annotations

PIXELS = """pixels AS (
 SELECT 'task_' || CAST(l_orderkey % 50 AS VARCHAR) || '_worker_' || CAST(l_suppkey % 3 AS VARCHAR) AS patch_id,
  l_orderkey * 100000000000 + l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS pixel_idx,
  CAST(floor(l_extendedprice) AS BIGINT) % 10000 AS band_1,
  CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN 0
       ELSE (l_partkey * 13 + l_orderkey * 7 + CASE WHEN l_returnflag = 'R' THEN 2500 ELSE 0 END) % 10000 END AS band_2,
  CASE WHEN l_partkey % 89 = 0 THEN 0 ELSE (l_partkey * 31 + l_orderkey) % 6000 END AS band_4,
  (l_orderkey * 17 + l_suppkey) % 10000 AS band_8,
  CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 0 ELSE CASE WHEN l_linestatus = 'O' THEN 0 ELSE 2 END END AS BIGINT) AS label
 FROM lineitem)"""

FEATURES = """features AS (
 SELECT patch_id, pixel_idx, band_4 / 10000.0::DOUBLE AS red_b4, band_2 / 10000.0::DOUBLE AS nir_b8,
  band_8 / 10000.0::DOUBLE AS swir_b11, band_1 / 10000.0::DOUBLE AS green_b3, CAST(label AS FLOAT) AS label
 FROM pixels WHERE label IN (0, 1)),
indexed AS (
 SELECT *,
  CASE WHEN nir_b8 + red_b4 > 0.001::DOUBLE THEN (nir_b8 - red_b4) / (nir_b8 + red_b4) ELSE 0.0::DOUBLE END AS ndvi,
  CASE WHEN green_b3 + swir_b11 > 0.001::DOUBLE THEN (green_b3 - swir_b11) / (green_b3 + swir_b11) ELSE 0.0::DOUBLE END AS ndwi,
  CASE WHEN nir_b8 + swir_b11 > 0.001::DOUBLE THEN (nir_b8 - swir_b11) / (nir_b8 + swir_b11) ELSE 0.0::DOUBLE END AS ndmi
 FROM features),
valid AS (
 SELECT * FROM indexed
 WHERE red_b4 IS NOT NULL AND nir_b8 IS NOT NULL AND swir_b11 IS NOT NULL AND ndvi IS NOT NULL
   AND NOT isnan(red_b4) AND NOT isnan(nir_b8) AND NOT isnan(swir_b11) AND NOT isnan(ndvi)),
predictions AS (
 SELECT *, ndvi AS score, CASE WHEN ndvi > 0.2::DOUBLE THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM valid)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def u_sql(parts: list[str], salt: str) -> str:
    """DuckDB form of terrapix.functions.hashing.uniform."""
    args = ", ".join([f"CAST({p} AS VARCHAR)" for p in parts] + [f"'{salt}'"])
    return f"(CAST(('0x' || substr(md5(concat_ws('|', {args})), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


ORACLE: dict[str, str] = {}

ORACLE["ndvi_confusion"] = with_(PIXELS, FEATURES) + """
SELECT CAST(label AS DOUBLE) AS label, prediction, count(*) AS count
FROM predictions GROUP BY 1, 2"""

ORACLE["spectral_indices"] = with_(PIXELS, FEATURES) + "SELECT * FROM indexed"

RAW_EPS = """raw_eps AS (
 SELECT patch_id, pixel_idx,
  (CAST(band_2 AS DOUBLE) - CAST(band_4 AS DOUBLE)) / (CAST(band_2 AS DOUBLE) + CAST(band_4 AS DOUBLE) + 1e-8) AS ndvi_raw,
  (CAST(band_1 AS DOUBLE) - CAST(band_8 AS DOUBLE)) / (CAST(band_1 AS DOUBLE) + CAST(band_8 AS DOUBLE) + 1e-8) AS ndwi_raw
 FROM pixels)"""

ORACLE["raw_eps_indices"] = with_(PIXELS, RAW_EPS) + "SELECT * FROM raw_eps"

ORACLE["class_share"] = with_(PIXELS) + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_crop,
 round(CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0, 6) AS crop_pct,
 round(avg(CAST(label AS DOUBLE)), 6) AS label_mean
FROM pixels"""

ORACLE["class_counts"] = with_(PIXELS) + """
SELECT label, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 6) AS pct,
 CASE label WHEN 0 THEN 'Non-Crop' WHEN 1 THEN 'Crop' END AS label_name
FROM (SELECT label, count(*) AS n FROM pixels GROUP BY label)"""

ORACLE["profile_bands"] = with_(PIXELS, """long AS (
 SELECT band, CAST(value AS DOUBLE) AS value FROM (UNPIVOT (SELECT band_1, band_2, band_4, band_8 FROM pixels)
 ON band_1, band_2, band_4, band_8 INTO NAME band VALUE value) WHERE value IS NOT NULL)""") + """
SELECT band, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
 min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
 round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max
FROM long GROUP BY band"""

ORACLE["describe_features"] = with_(PIXELS, FEATURES, """long AS (
 SELECT feature, CAST(value AS DOUBLE) AS value FROM (UNPIVOT (SELECT red_b4, nir_b8, swir_b11, ndvi, ndwi, ndmi,
  CAST(label AS DOUBLE) AS label FROM indexed)
 ON red_b4, nir_b8, swir_b11, ndvi, ndwi, ndmi, label INTO NAME feature VALUE value)
 WHERE value IS NOT NULL AND NOT isnan(value))""") + """
SELECT feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev,
 min(value) AS min, max(value) AS max
FROM long GROUP BY feature"""

ORACLE["index_range"] = with_(PIXELS, RAW_EPS) + """
SELECT min(ndvi_raw) AS ndvi_raw_min, max(ndvi_raw) AS ndvi_raw_max,
 min(ndwi_raw) AS ndwi_raw_min, max(ndwi_raw) AS ndwi_raw_max FROM raw_eps"""

ORACLE["ndvi_histogram"] = with_(PIXELS, FEATURES, """b AS (SELECT min(ndvi) AS lo, max(ndvi) AS hi,
 (max(ndvi) - min(ndvi)) / 50.0::DOUBLE AS width FROM valid)""") + """
SELECT CAST(label AS DOUBLE) AS label, bin, count(*) AS count, round(any_value(lo) + bin * any_value(width), 6) AS bin_lo
FROM (SELECT label, ndvi, lo, width,
        CAST(LEAST(floor((ndvi - lo) / width), 49) AS INTEGER) AS bin FROM valid, b)
GROUP BY 1, 2"""

ORACLE["ndvi_red_density"] = with_(PIXELS, FEATURES, """b AS (SELECT min(red_b4) AS xlo,
 (max(red_b4) - min(red_b4)) / 20.0::DOUBLE AS xw, min(ndvi) AS ylo, (max(ndvi) - min(ndvi)) / 20.0::DOUBLE AS yw
 FROM valid)""") + """
SELECT CAST(label AS DOUBLE) AS label,
 CAST(LEAST(floor((red_b4 - xlo) / xw), 19) AS INTEGER) AS x_bin,
 CAST(LEAST(floor((ndvi - ylo) / yw), 19) AS INTEGER) AS y_bin, count(*) AS count
FROM valid, b GROUP BY 1, 2, 3"""

STRAT = f"""strat AS (
 SELECT patch_id, pixel_idx, red_b4, nir_b8, swir_b11, green_b3, label, ndvi FROM indexed
 WHERE {u_sql(['patch_id', 'pixel_idx'], '42')} <
   CASE WHEN label = 1 THEN 0.1::DOUBLE WHEN label = 0 THEN 0.025::DOUBLE ELSE 0.0::DOUBLE END)"""

ORACLE["stratified_sample"] = with_(PIXELS, FEATURES, STRAT) + "SELECT * FROM strat"

ORACLE["sample_n"] = with_(PIXELS, FEATURES, STRAT) + f"""
SELECT s.* FROM strat s, (SELECT count(*) AS c FROM strat) k
WHERE {u_sql(['s.patch_id', 's.pixel_idx'], 'n42')} < LEAST(1.0::DOUBLE, 1000.0::DOUBLE / k.c)"""

ORACLE["exact_sample"] = with_(PIXELS, FEATURES) + f"""
SELECT patch_id, pixel_idx, red_b4, nir_b8, swir_b11, green_b3, label, ndvi FROM valid
ORDER BY {u_sql(['patch_id', 'pixel_idx'], 'x42')}, patch_id, pixel_idx LIMIT 20000"""

ORACLE["hash_split"] = with_(PIXELS, FEATURES, STRAT) + f"""
SELECT *, CASE WHEN {u_sql(['patch_id', 'pixel_idx'], 'split42')} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS split
FROM strat"""

ORACLE["balance_split"] = with_(PIXELS, FEATURES, f"""counts AS (SELECT label, count(*) AS n FROM valid GROUP BY label),
fr AS (SELECT label, LEAST(1.0::DOUBLE, CAST((SELECT min(n) FROM counts) AS DOUBLE) / CAST(n AS DOUBLE)) AS f FROM counts),
bal AS (SELECT v.* FROM valid v JOIN fr USING (label) WHERE {u_sql(['patch_id', 'pixel_idx'], '42')} < fr.f),
tagged AS (SELECT *, CASE WHEN {u_sql(['patch_id', 'pixel_idx'], 'split42')} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS split
 FROM bal)""") + """
SELECT split, CAST(label AS DOUBLE) AS label, count(*) AS n FROM tagged GROUP BY 1, 2
UNION ALL
SELECT 'overlap' AS split, -1.0::DOUBLE AS label, count(*) AS n
FROM (SELECT patch_id, pixel_idx FROM tagged WHERE split = 'train') a
JOIN (SELECT patch_id, pixel_idx FROM tagged WHERE split = 'test') b USING (patch_id, pixel_idx)"""

ORACLE["confusion_wide"] = with_(PIXELS, FEATURES) + """
SELECT CAST(label AS DOUBLE) AS label, count(*) FILTER (WHERE prediction = 0) AS pred_0, count(*) FILTER (WHERE prediction = 1) AS pred_1
FROM predictions GROUP BY 1"""

ORACLE["auc_rank"] = with_(PIXELS, FEATURES, """per AS (
 SELECT score AS s, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
  CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg
 FROM predictions WHERE score IS NOT NULL GROUP BY score),
cum AS (SELECT *, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM per)""") + """
SELECT round(sum(pos * (cum_neg - neg + neg / 2.0::DOUBLE)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS auc,
 CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM cum"""

REPORT = """conf AS (SELECT CAST(label AS DOUBLE) AS label, prediction, count(*) AS cnt FROM predictions GROUP BY 1, 2),
pc AS (
 SELECT s.cls, s.support, coalesce(p.predicted, 0) AS predicted, coalesce(t.tp, 0) AS tp
 FROM (SELECT label AS cls, sum(cnt) AS support FROM conf GROUP BY 1) s
 LEFT JOIN (SELECT prediction AS cls, sum(cnt) AS predicted FROM conf GROUP BY 1) p USING (cls)
 LEFT JOIN (SELECT label AS cls, cnt AS tp FROM conf WHERE label = prediction) t USING (cls)),
pm AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0::DOUBLE END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0.0::DOUBLE END AS recall FROM pc),
pf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
  ELSE 0.0::DOUBLE END AS f1 FROM pm),
report AS (
 SELECT sum(tp) / sum(support) AS accuracy,
  max(CASE WHEN cls = 1 THEN precision END) AS precision_pos, max(CASE WHEN cls = 1 THEN recall END) AS recall_pos,
  sum(precision * support) / sum(support) AS weighted_precision, sum(recall * support) / sum(support) AS weighted_recall,
  sum(f1 * support) / sum(support) AS f1_weighted
 FROM pf)"""

ORACLE["f1_weighted"] = with_(PIXELS, FEATURES, REPORT) + "SELECT round(f1_weighted, 6) AS f1_weighted FROM report"

ORACLE["accuracy_pr"] = with_(PIXELS, FEATURES, REPORT) + """
SELECT round(accuracy, 6) AS accuracy, round(precision_pos, 6) AS precision_pos, round(recall_pos, 6) AS recall_pos,
 round(weighted_precision, 6) AS weighted_precision, round(weighted_recall, 6) AS weighted_recall,
 round(f1_weighted, 6) AS f1_weighted FROM report"""

ORACLE["standardize"] = with_(PIXELS, FEATURES, STRAT, """b AS (
 SELECT * FROM strat WHERE red_b4 IS NOT NULL AND nir_b8 IS NOT NULL AND swir_b11 IS NOT NULL AND ndvi IS NOT NULL
  AND NOT isnan(red_b4) AND NOT isnan(nir_b8) AND NOT isnan(swir_b11) AND NOT isnan(ndvi)),
st AS (SELECT avg(red_b4) AS mr, stddev_samp(red_b4) AS sr, avg(nir_b8) AS mn, stddev_samp(nir_b8) AS sn,
  avg(swir_b11) AS ms, stddev_samp(swir_b11) AS ss, avg(ndvi) AS mv, stddev_samp(ndvi) AS sv FROM b)""") + """
SELECT patch_id, pixel_idx, CAST(label AS DOUBLE) AS label,
 round((red_b4 - mr) / sr, 6) AS red_b4_z, round((nir_b8 - mn) / sn, 6) AS nir_b8_z,
 round((swir_b11 - ms) / ss, 6) AS swir_b11_z, round((ndvi - mv) / sv, 6) AS ndvi_z
FROM b, st"""

ORACLE["class_weight"] = with_(PIXELS, """per AS (SELECT label, count(*) AS n FROM pixels WHERE label IN (0, 1) GROUP BY label),
r AS (SELECT CAST(sum(CASE WHEN label = 1 THEN n ELSE 0 END) AS DOUBLE)
  / CAST(sum(CASE WHEN label = 0 THEN n ELSE 0 END) AS DOUBLE) AS ratio FROM per)""") + """
SELECT label, n, ratio, ratio > 5 AS imbalanced,
 CASE WHEN ratio > 5 AND label = 0 THEN ratio ELSE 1.0::DOUBLE END AS weight
FROM per, r"""

PARCELS = """parcels AS (
 SELECT o_orderkey AS parcel_id, o_orderpriority AS ec_hcat_n,
  CAST((o_orderkey * 37) % 2000 AS DOUBLE) AS xmin, CAST((o_orderkey * 91 + o_custkey * 13) % 1500 AS DOUBLE) AS ymin,
  CAST((o_orderkey * 37) % 2000 + 1 + o_custkey % 30 AS DOUBLE) AS xmax,
  CAST((o_orderkey * 91 + o_custkey * 13) % 1500 + 1 + o_orderkey % 20 AS DOUBLE) AS ymax
 FROM orders),
class_map AS (SELECT * FROM (VALUES ('1-URGENT', 1), ('2-HIGH', 1), ('3-MEDIUM', 1), ('4-NOT SPECIFIED', 0))
 AS t(ec_hcat_n, binary_id)),
looked AS (SELECT p.*, c.binary_id FROM parcels p LEFT JOIN class_map c USING (ec_hcat_n)),
ext AS (SELECT min(xmin) AS x0, min(ymin) AS y0, max(xmax) AS x1, max(ymax) AS y1,
  CAST(ceil((max(xmax) - min(xmin)) / 20.0::DOUBLE) AS BIGINT) AS nx,
  CAST(ceil((max(ymax) - min(ymin)) / 20.0::DOUBLE) AS BIGINT) AS ny FROM parcels),
cells AS (
 SELECT i, j, x0 + i * 20.0::DOUBLE AS xmin, y0 + j * 20.0::DOUBLE AS ymin,
  x0 + i * 20.0::DOUBLE + 20.0::DOUBLE AS xmax, y0 + j * 20.0::DOUBLE + 20.0::DOUBLE AS ymax
 FROM (SELECT x0, y0, unnest(range(0, nx)) AS i, ny FROM ext) a, LATERAL (SELECT unnest(range(0, a.ny)) AS j) b),
pairs AS (
 SELECT c.i, c.j, p.parcel_id, p.binary_id FROM cells c JOIN looked p
 ON p.xmin <= c.xmax AND p.xmax >= c.xmin AND p.ymin <= c.ymax AND p.ymax >= c.ymin),
counts AS (
 SELECT i, j, count(*) AS n_raw, count(binary_id) AS n_mapped, count(*) FILTER (WHERE binary_id = 1) AS crop,
  count(*) FILTER (WHERE binary_id = 0) AS non_crop FROM pairs GROUP BY i, j),
tasks AS (
 SELECT row_number() OVER (ORDER BY c.i, c.j) - 1 AS task_id, c.i, c.j, g.xmin, g.ymin, g.xmax, g.ymax,
  c.n_mapped AS polygon_count, c.crop, c.non_crop, c.n_raw
 FROM counts c JOIN cells g USING (i, j) WHERE c.n_raw >= 3 AND c.n_mapped > 0)"""

ORACLE["extent"] = with_(PARCELS) + "SELECT x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax, nx, ny FROM ext"
ORACLE["class_lookup"] = with_(PARCELS) + "SELECT parcel_id, ec_hcat_n, binary_id FROM looked"
ORACLE["grid_cells"] = with_(PARCELS) + "SELECT * FROM cells"
ORACLE["cell_parcels"] = with_(PARCELS) + "SELECT * FROM pairs"
ORACLE["cell_counts"] = with_(PARCELS) + "SELECT * FROM counts"
ORACLE["tasks"] = with_(PARCELS) + "SELECT * FROM tasks"
ORACLE["dataset_stats"] = with_(PARCELS) + """
SELECT count(*) AS n_tasks, (SELECT nx * ny FROM ext) AS n_cells, CAST(sum(polygon_count) AS BIGINT) AS total_polygons,
 CAST(sum(crop) AS BIGINT) AS crop, CAST(sum(non_crop) AS BIGINT) AS non_crop,
 round(CAST(sum(crop) AS DOUBLE) / CAST(sum(crop) + sum(non_crop) AS DOUBLE) * 100.0, 6) AS crop_pct,
 round(CAST(sum(non_crop) AS DOUBLE) / CAST(sum(crop) + sum(non_crop) AS DOUBLE) * 100.0, 6) AS non_crop_pct,
 round(CAST(sum(crop) AS DOUBLE) / CAST(sum(non_crop) AS DOUBLE), 6) AS ratio,
 CAST(sum(crop) AS DOUBLE) / CAST(sum(non_crop) AS DOUBLE) > 5 AS imbalanced,
 (SELECT count(DISTINCT p.parcel_id) FROM pairs p JOIN tasks t USING (i, j) WHERE p.binary_id IS NOT NULL)
   AS distinct_polygons
FROM tasks"""

SCENES = """scenes AS (
 SELECT event_id AS scene_id, ts AS scene_ts, value / 5.0::DOUBLE AS cloud_cover,
  CAST((user_id * 53 + event_id * 7) % 2000 - 25 AS DOUBLE) AS xmin, CAST((user_id * 29 + event_id * 11) % 1500 - 25 AS DOUBLE) AS ymin,
  CAST((user_id * 53 + event_id * 7) % 2000 + 25 AS DOUBLE) AS xmax, CAST((user_id * 29 + event_id * 11) % 1500 + 25 AS DOUBLE) AS ymax
 FROM events),
windows AS (SELECT priority, season, CAST(d0 AS TIMESTAMP) AS d0, CAST(d1 AS TIMESTAMP) AS d1, CAST(mc AS DOUBLE) AS max_cloud
 FROM (VALUES (1, 'peak', '2024-01-10', '2024-01-12', 2), (2, 'early', '2024-01-05', '2024-01-10', 3),
  (3, 'late', '2024-01-12', '2024-01-16', 4), (4, 'full', '2024-01-01', '2024-01-31', 20)) AS t(priority, season, d0, d1, mc))"""

MATCH_TASKS = """mtasks AS (
 SELECT o_orderkey AS task_id, CAST((o_orderkey * 37) % 2000 AS DOUBLE) AS xmin, CAST((o_orderkey * 91) % 1500 AS DOUBLE) AS ymin,
  CAST((o_orderkey * 37) % 2000 + 20 AS DOUBLE) AS xmax, CAST((o_orderkey * 91) % 1500 + 20 AS DOUBLE) AS ymax
 FROM orders)"""


def _match(tasks: str) -> str:
    return f"""cand AS (
 SELECT t.task_id, s.scene_id, s.cloud_cover, w.priority, w.season FROM {tasks} t
 JOIN scenes s ON s.xmin <= t.xmax AND s.xmax >= t.xmin AND s.ymin <= t.ymax AND s.ymax >= t.ymin
 JOIN windows w ON s.scene_ts >= w.d0 AND s.scene_ts < w.d1 AND s.cloud_cover < w.max_cloud),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY priority, cloud_cover, scene_id) AS rn
 FROM cand) WHERE rn = 1),
matched AS (
 SELECT t.task_id, b.priority, b.cloud_cover, b.scene_id, b.season,
  CASE WHEN b.scene_id IS NULL THEN 'failed_download' END AS status
 FROM {tasks} t LEFT JOIN best b USING (task_id))"""


ORACLE["match_scenes"] = with_(SCENES, MATCH_TASKS, _match("mtasks")) + "SELECT * FROM matched"

PATCHES = """pat AS (SELECT 'vec_' || CAST(vec_id AS VARCHAR) AS patch_id, embedding AS e FROM embeddings)"""

ORACLE["explode_patches"] = with_(PATCHES) + """
SELECT patch_id, CAST(p AS BIGINT) AS pixel_idx, CAST(CASE WHEN e[p + 1] > 0 THEN 1 ELSE 0 END AS BIGINT) AS label,
 CAST(e[p + 1] AS DOUBLE) AS band_0, CAST(e[16 + p + 1] AS DOUBLE) AS band_1,
 CAST(e[32 + p + 1] AS DOUBLE) AS band_2, CAST(e[48 + p + 1] AS DOUBLE) AS band_3
FROM pat, (SELECT unnest(range(0, 16)) AS p) r"""

ORACLE["explode_patches_buffer"] = with_(PATCHES) + """
SELECT patch_id, CAST(p AS BIGINT) AS pixel_idx, CAST(CASE WHEN e[p + 1] > 0 THEN 1 ELSE 0 END AS BIGINT) AS label,
 CAST(e[p * 4 + 1] AS DOUBLE) AS band_0, CAST(e[p * 4 + 2] AS DOUBLE) AS band_1,
 CAST(e[p * 4 + 3] AS DOUBLE) AS band_2, CAST(e[p * 4 + 4] AS DOUBLE) AS band_3
FROM pat, (SELECT unnest(range(0, 16)) AS p) r"""

ORACLE["pack_patches"] = with_(PATCHES) + """
SELECT patch_id, 4 AS n_bands, 4 AS h, 4 AS w,
 round(list_reduce(list_transform(range(1, 65), lambda i: CAST(e[i] AS DOUBLE) * i), lambda a, b: a + b, 0.0::DOUBLE), 6) AS checksum,
 CAST(len(list_filter(e[1:16], lambda x: x > 0)) AS BIGINT) AS mask_ones, true AS same
FROM pat"""

ORACLE["mask_stats"] = with_(PATCHES) + """
SELECT patch_id, CAST(len(list_filter(e[1:16], lambda x: x > 0)) AS BIGINT) AS crop_pixels,
 CAST(len(list_filter(e[1:16], lambda x: NOT (x > 0))) AS BIGINT) AS noncrop_pixels,
 len(list_filter(e[1:16], lambda x: x > 0)) = 0 AS empty_mask, true AS shape_ok
FROM pat"""

ORACLE["resample_bilinear"] = with_(PATCHES, """coords AS (
 SELECT o, o // 6 AS r, o % 6 AS c, (o // 6) * 3.0::DOUBLE / 5.0::DOUBLE AS sr, (o % 6) * 3.0::DOUBLE / 5.0::DOUBLE AS sc
 FROM (SELECT unnest(range(0, 36)) AS o)),
idx AS (SELECT o, floor(sr) AS r0, floor(sc) AS c0, LEAST(floor(sr) + 1, 3) AS r1, LEAST(floor(sc) + 1, 3) AS c1,
 sr - floor(sr) AS fr, sc - floor(sc) AS fc FROM coords)""") + """
SELECT patch_id, CAST(o AS BIGINT) AS pixel_idx,
""" + ",\n".join(
    f""" round((1 - fr) * (1 - fc) * CAST(e[CAST({k * 16} + r0 * 4 + c0 + 1 AS INTEGER)] AS DOUBLE)
  + (1 - fr) * fc * CAST(e[CAST({k * 16} + r0 * 4 + c1 + 1 AS INTEGER)] AS DOUBLE)
  + fr * (1 - fc) * CAST(e[CAST({k * 16} + r1 * 4 + c0 + 1 AS INTEGER)] AS DOUBLE)
  + fr * fc * CAST(e[CAST({k * 16} + r1 * 4 + c1 + 1 AS INTEGER)] AS DOUBLE), 6) AS band_{k}"""
    for k in range(4)) + "\nFROM pat, idx"

ORACLE["resample_nearest"] = with_(PATCHES, """idx AS (
 SELECT o, CAST(floor((o // 6) * 3.0::DOUBLE / 5.0::DOUBLE + 0.5) AS INTEGER) AS rr,
  CAST(floor((o % 6) * 3.0::DOUBLE / 5.0::DOUBLE + 0.5) AS INTEGER) AS cc
 FROM (SELECT unnest(range(0, 36)) AS o))""") + """
SELECT patch_id, CAST(o AS BIGINT) AS pixel_idx, CASE WHEN (CASE WHEN e[rr * 4 + cc + 1] > 0 THEN 1 ELSE 0 END) > 0.5
 THEN 1 ELSE 0 END AS mask
FROM pat, idx"""

# candidate pixels come from each parcel's box clipped to its task (rows, then
# columns), widened by one against rounding; the exact test follows
RASTER = """tpairs AS (SELECT t.task_id, p.parcel_id, p.binary_id, l.xmin, l.ymin, l.xmax, l.ymax, t.xmin AS gx, t.ymax AS gy
 FROM pairs p JOIN tasks t USING (i, j) JOIN looked l USING (parcel_id) WHERE p.binary_id IS NOT NULL),
prow AS (SELECT *, unnest(range(CAST(greatest(0, floor(gy - ymax) - 1) AS BIGINT), CAST(least(19, ceil(gy - ymin) + 1) AS BIGINT) + 1)) AS r FROM tpairs),
pcol AS (SELECT *, unnest(range(CAST(greatest(0, floor(xmin - gx) - 1) AS BIGINT), CAST(least(19, ceil(xmax - gx) + 1) AS BIGINT) + 1)) AS c FROM prow),
px AS (SELECT *, gx + c + 0.5 AS cx, gy - r - 0.5 AS cy FROM pcol),
burned AS (
 SELECT px.task_id, px.r * 20 + px.c AS pixel_idx, max_by(px.binary_id, px.parcel_id) AS mask_class
 FROM px WHERE px.cx >= px.xmin AND px.cx <= px.xmax AND px.cy >= px.ymin AND px.cy <= px.ymax
 GROUP BY 1, 2),
masks AS (
 SELECT t.task_id, coalesce(b.crop, 0) AS crop_pixels, 400 - coalesce(b.crop, 0) AS noncrop_pixels,
  400 - coalesce(b.crop, 0) - coalesce(b.c0, 0) AS background_pixels, coalesce(b.crop, 0) = 0 AS empty_mask
 FROM tasks t LEFT JOIN (SELECT task_id, count(*) FILTER (WHERE mask_class = 1) AS crop,
  count(*) FILTER (WHERE mask_class = 0) AS c0 FROM burned GROUP BY 1) b USING (task_id))"""

ORACLE["rasterize_boxes"] = with_(PARCELS, RASTER) + """
SELECT task_id, CAST(crop_pixels AS BIGINT) AS crop_pixels, CAST(noncrop_pixels AS BIGINT) AS noncrop_pixels,
 CAST(background_pixels AS BIGINT) AS background_pixels, empty_mask FROM masks"""

ORACLE["patch_results"] = with_(PARCELS, RASTER, SCENES, _match("tasks")) + """
SELECT t.task_id,
 CASE WHEN t.n_raw < 5 THEN 'skipped_few_polygons' WHEN t.polygon_count = 0 THEN 'skipped_no_binary_classes'
  WHEN m.scene_id IS NULL THEN 'failed_download' WHEN k.empty_mask THEN 'failed_empty_mask' ELSE 'success' END AS status,
 CAST(CASE WHEN t.n_raw >= 5 THEN t.polygon_count ELSE 0 END AS BIGINT) AS polygon_count,
 CAST(CASE WHEN t.n_raw >= 5 AND t.polygon_count > 0 AND m.scene_id IS NOT NULL AND NOT k.empty_mask
  THEN k.crop_pixels ELSE 0 END AS BIGINT) AS crop_pixels,
 CAST(CASE WHEN t.n_raw >= 5 AND t.polygon_count > 0 AND m.scene_id IS NOT NULL AND NOT k.empty_mask
  THEN k.noncrop_pixels ELSE 0 END AS BIGINT) AS noncrop_pixels,
 m.scene_id, m.season
FROM tasks t JOIN masks k USING (task_id) JOIN matched m USING (task_id)"""

RESULTS = """results AS (
 SELECT event_id AS task_id, 'w' || CAST(user_id % 4 AS VARCHAR) AS worker_id, ts,
  CASE event_type WHEN 'purchase' THEN 'success' WHEN 'click' THEN 'success' WHEN 'view' THEN 'skipped_few_polygons'
   WHEN 'signup' THEN 'failed_empty_mask' ELSE 'failed_download' END AS status,
  CAST(floor(value * 100) AS BIGINT) AS crop_pixels, 50000 - CAST(floor(value * 100) AS BIGINT) AS noncrop_pixels
 FROM events),
flags AS (
 SELECT *, CAST(status = 'success' AS BIGINT) AS s_ok, CAST(status <> 'success' AND status LIKE 'skipped%' AS BIGINT) AS s_skip,
  CAST(status <> 'success' AND NOT (status LIKE 'skipped%') AS BIGINT) AS s_fail,
  CASE WHEN status = 'success' THEN crop_pixels ELSE 0 END AS s_crop,
  CASE WHEN status = 'success' THEN noncrop_pixels ELSE 0 END AS s_noncrop
 FROM results)"""

COUNTERS = """count(*) AS tasks, CAST(sum(s_ok) AS BIGINT) AS success, CAST(sum(s_skip) AS BIGINT) AS skipped,
 CAST(sum(s_fail) AS BIGINT) AS failed, CAST(sum(s_ok) AS BIGINT) AS patches,
 CAST(sum(s_crop) AS BIGINT) AS crop_pixels, CAST(sum(s_noncrop) AS BIGINT) AS noncrop_pixels"""

ORACLE["monitor_totals"] = with_(RESULTS, f"""a AS (SELECT {COUNTERS},
 (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6 AS el FROM flags)""") + """
SELECT tasks, success, skipped, failed, patches, crop_pixels, noncrop_pixels, crop_pixels + noncrop_pixels AS total_pixels,
 round(CASE WHEN crop_pixels + noncrop_pixels > 0
  THEN CAST(crop_pixels AS DOUBLE) / CAST(crop_pixels + noncrop_pixels AS DOUBLE) * 100.0 ELSE 0.0 END, 6) AS crop_ratio,
 round(el, 6) AS elapsed_s, CAST(floor(el / 60) AS BIGINT) AS elapsed_min, CAST(floor(el % 60) AS BIGINT) AS elapsed_sec,
 round(CASE WHEN el > 0 THEN tasks / el ELSE 0.0 END, 6) AS tasks_per_sec
FROM a"""

ORACLE["monitor_by_worker"] = with_(RESULTS) + f"SELECT worker_id, {COUNTERS} FROM flags GROUP BY worker_id"

ORACLE["progress"] = with_(RESULTS, """c AS (
 SELECT ts, row_number() OVER w AS message, sum(s_ok) OVER w AS success, sum(s_skip) OVER w AS skipped,
  sum(s_fail) OVER w AS failed, sum(s_crop) OVER w AS crop_pixels, sum(s_noncrop) OVER w AS noncrop_pixels
 FROM flags WINDOW w AS (ORDER BY ts, task_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""") + """
SELECT CAST(message AS BIGINT) AS message, ts, CAST(success AS BIGINT) AS success, CAST(skipped AS BIGINT) AS skipped,
 CAST(failed AS BIGINT) AS failed, CAST(crop_pixels AS BIGINT) AS crop_pixels, CAST(noncrop_pixels AS BIGINT) AS noncrop_pixels
FROM c WHERE message % 20 = 0"""

ORACLE["dedupe_results"] = with_(RESULTS) + """
SELECT task_id, ts, worker_id, status, crop_pixels, noncrop_pixels FROM (
 SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY ts DESC, worker_id DESC, status DESC,
  crop_pixels DESC, noncrop_pixels DESC) AS rn
 FROM (SELECT CAST(task_id // 2 AS BIGINT) AS task_id, worker_id, ts, status, crop_pixels, noncrop_pixels FROM results))
WHERE rn = 1"""

ORACLE["worker_runtime"] = with_(RESULTS) + """
SELECT worker_id, count(*) AS tasks, min(ts) AS first_ts, max(ts) AS last_ts,
 round((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6, 6) AS seconds,
 round(CASE WHEN (max(epoch_us(ts)) - min(epoch_us(ts))) > 0
  THEN count(*) / ((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6) ELSE 0.0 END, 6) AS tasks_per_sec
FROM results GROUP BY worker_id"""

ORACLE["every_nth"] = with_(RESULTS) + "SELECT * FROM results WHERE task_id % 5 = 0"

ORACLE["json_roundtrip"] = with_(PARCELS) + """
SELECT 'task_' || CAST(task_id AS VARCHAR) AS key, task_id, xmin, ymin, xmax, ymax, 20.0::DOUBLE AS grid_step,
 polygon_count, crop, non_crop, 4 AS n_classes, 1 AS class_1_urgent
FROM tasks"""


def _utm_sql(lon: str, lat: str) -> tuple[str, str]:
    """SQL twin of terrapix.functions.geo.to_utm (same operation order)."""
    from terrapix.functions.geo import DEG, UTM_FALSE_EASTING, UTM_K0, utm_constants
    c = utm_constants(30)
    a, e2, ep2 = c["a"], c["e2"], c["ep2"]
    e4, e6 = e2 * e2, e2 * e2 * e2
    d = lambda v: f"CAST({v!r} AS DOUBLE)"
    phi = f"({lat} * {d(DEG)})"
    lam = f"(({lon} - {d(c['lon0'])}) * {d(DEG)})"
    s_, c_ = f"sin({phi})", f"cos({phi})"
    n = f"({d(a)} / sqrt({d(1.0)} - {d(e2)} * {s_} * {s_}))"
    t = f"(tan({phi}) * tan({phi}))"
    cc = f"({d(ep2)} * {c_} * {c_})"
    aa = f"({lam} * {c_})"
    m = (f"({d(a)} * ({d(1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256)} * {phi}"
         f" - {d(3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024)} * sin(2 * {phi})"
         f" + {d(15 * e4 / 256 + 45 * e6 / 1024)} * sin(4 * {phi})"
         f" - {d(35 * e6 / 3072)} * sin(6 * {phi})))")
    a2 = f"({aa} * {aa})"
    x = (f"({d(UTM_K0)} * {n} * ({aa} + ({d(1.0)} - {t} + {cc}) * {a2} * {aa} / 6"
         f" + ({d(5.0)} - 18 * {t} + {t} * {t} + 72 * {cc} - {d(58 * ep2)}) * {a2} * {a2} * {aa} / 120)"
         f" + {d(UTM_FALSE_EASTING)})")
    y = (f"({d(UTM_K0)} * ({m} + {n} * tan({phi}) * ({a2} / 2"
         f" + ({d(5.0)} - {t} + 9 * {cc} + 4 * {cc} * {cc}) * {a2} * {a2} / 24"
         f" + ({d(61.0)} - 58 * {t} + {t} * {t} + 600 * {cc} - {d(330 * ep2)}) * {a2} * {a2} * {a2} / 720)))")
    return x, y


_E, _N = _utm_sql("(-9.0::DOUBLE + xmin / 200.0::DOUBLE)", "(36.0::DOUBLE + ymin / 200.0::DOUBLE)")
ORACLE["utm_project"] = with_(PARCELS) + f"SELECT parcel_id, round({_E}, 2) AS easting, round({_N}, 2) AS northing FROM parcels"


def _edge(x1, y1, x2, y2):
    return (f"CAST(CASE WHEN ({y1} > px.cy) <> ({y2} > px.cy) "
            f"THEN px.cx < {x1} + ({x2} - {x1}) * (px.cy - {y1}) / ({y2} - {y1}) ELSE false END AS INTEGER)")


_CX, _CY = "((px.xmin + px.xmax) / 2)", "((px.ymin + px.ymax) / 2)"
_DIAMOND = " + ".join([_edge(_CX, "px.ymin", "px.xmax", _CY), _edge("px.xmax", _CY, _CX, "px.ymax"),
                       _edge(_CX, "px.ymax", "px.xmin", _CY), _edge("px.xmin", _CY, _CX, "px.ymin")])
ORACLE["rasterize_polygons"] = with_(PARCELS, RASTER.replace(
    "AND px.cy <= px.ymax\n", f"AND px.cy <= px.ymax AND ({_DIAMOND}) % 2 = 1\n")) + """
SELECT task_id, CAST(crop_pixels AS BIGINT) AS crop_pixels, CAST(noncrop_pixels AS BIGINT) AS noncrop_pixels,
 CAST(background_pixels AS BIGINT) AS background_pixels, empty_mask FROM masks"""

ORACLE["worker_results"] = "SELECT task_id, status, polygon_count, crop_pixels, noncrop_pixels FROM (" + \
    ORACLE["patch_results"] + ")"

SUCCESS = """good AS (SELECT t.task_id, t.xmin, t.ymin, t.xmax, t.ymax FROM tasks t JOIN masks k USING (task_id) JOIN matched m USING (task_id)
 WHERE t.n_raw >= 5 AND t.polygon_count > 0 AND m.scene_id IS NOT NULL AND NOT k.empty_mask)"""
ORACLE["ready_events"] = with_(PARCELS, RASTER, SCENES, _match("tasks"), SUCCESS) + """
SELECT task_id, '1' AS worker_id, 'pixels/task_' || CAST(task_id AS VARCHAR) || '_worker_1' AS s3_path, 4 AS c,
 CAST(ceil(ymax - ymin) AS INTEGER) AS h, CAST(ceil(xmax - xmin) AS INTEGER) AS w FROM good"""

ORACLE["worker_pixels"] = with_(PARCELS, RASTER, SCENES, _match("tasks"), SUCCESS, """
vec AS (SELECT g.task_id, e.embedding AS e FROM good g JOIN embeddings e ON e.vec_id = g.task_id % (SELECT count(*) FROM embeddings)),
lab AS (SELECT task_id, count(*) AS crop, sum(pixel_idx) AS at FROM burned WHERE mask_class = 1 GROUP BY 1)""") + """
SELECT 'task_' || CAST(v.task_id AS VARCHAR) || '_worker_1' AS patch_id, 400 AS n_pixels, CAST(l.crop AS BIGINT) AS crop_pixels, CAST(l.at AS BIGINT) AS label_at,
""" + ",\n".join(f" round(list_sum(list_transform(range(0, 400), lambda p: CAST(e[CAST({k * 16 + 1} + p % 16 AS INTEGER)] AS DOUBLE) * (p + 1))), 4) AS band_{k}" for k in range(4)) + """
FROM vec v JOIN lab l USING (task_id)"""

ORACLE["pack_patches_sized"] = """WITH s AS (SELECT vec_id AS v, embedding AS e, CAST(vec_id % 4 + 1 AS INTEGER) AS h, CAST((vec_id // 4) % 4 + 1 AS INTEGER) AS w FROM embeddings),
p AS (SELECT *, unnest(range(0, h * w + 1)) AS p FROM s),
k AS (SELECT *, p < h * w AS inside, (v + p) % 5 <> 0 AS there FROM p)
SELECT 'vec_' || CAST(v AS VARCHAR) AS patch_id, h, w, count(*) FILTER (WHERE inside AND NOT there) AS n_missing,
 count(*) FILTER (WHERE NOT inside AND there) AS n_extra, 0 AS n_conflicts,
""" + ",\n".join(f" round(coalesce(sum(CAST(e[CAST({k * 16 + 1} + p AS INTEGER)] AS DOUBLE) * (p + 1)) FILTER (WHERE inside AND there), 0), 6) AS band_{k}" for k in range(3)) + """,
 count(*) FILTER (WHERE inside AND there AND e[CAST(p + 1 AS INTEGER)] > 0) AS mask_ones
FROM k GROUP BY v, h, w"""

ORACLE["inventory"] = " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n_rows FROM {t}" for t in (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings"))

ORACLE["class_usage"] = with_(PIXELS, FEATURES, f"""used AS (SELECT * FROM valid
 WHERE {u_sql(['patch_id', 'pixel_idx'], '42')} <
   CASE WHEN label = 1 THEN 0.1::DOUBLE WHEN label = 0 THEN 0.025::DOUBLE ELSE 0.0::DOUBLE END)""") + """
SELECT a.label, a.n_total, coalesce(b.n_used, 0) AS n_used,
 round(coalesce(b.n_used, 0) * 100.0::DOUBLE / a.n_total, 6) AS pct_used
FROM (SELECT CAST(label AS BIGINT) AS label, count(*) AS n_total FROM valid GROUP BY 1) a
LEFT JOIN (SELECT CAST(label AS BIGINT) AS label, count(*) AS n_used FROM used GROUP BY 1) b USING (label)"""


ORACLE["ml_standardize"] = ORACLE["standardize"]
_TEST = with_(PIXELS, FEATURES, STRAT, f"""b AS (
 SELECT *, {u_sql(['patch_id', 'pixel_idx'], 'split42')} AS u FROM strat
 WHERE red_b4 IS NOT NULL AND nir_b8 IS NOT NULL AND swir_b11 IS NOT NULL AND ndvi IS NOT NULL
  AND NOT isnan(red_b4) AND NOT isnan(nir_b8) AND NOT isnan(swir_b11) AND NOT isnan(ndvi))""")
ORACLE["rf_test_rows"] = _TEST + """
SELECT patch_id, pixel_idx, CAST(label AS DOUBLE) AS label, count(*) AS n, true AS ok FROM b WHERE u >= 0.8::DOUBLE GROUP BY ALL"""
ORACLE["rf_importance_rows"] = _TEST + """
SELECT 4 AS features, 1.0::DOUBLE AS total, true AS ok, count(*) AS n_train FROM b WHERE u < 0.8::DOUBLE"""
ORACLE["lr_weight_rows"] = with_(PIXELS, FEATURES, f"""tr AS (SELECT * FROM valid WHERE {u_sql(['patch_id', 'pixel_idx'], 'split42')} < 0.8::DOUBLE),
r AS (SELECT CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) / CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS ratio FROM tr)""") + """
SELECT patch_id, pixel_idx, CAST(label AS DOUBLE) AS label, round(CASE WHEN ratio > 1 AND label = 0 THEN ratio ELSE 1.0::DOUBLE END, 6) AS weight FROM tr, r"""
ORACLE["parcels_source"] = with_(PARCELS) + """
SELECT parcel_id, ec_hcat_n, xmin, ymin, xmax, ymax FROM parcels WHERE xmin <= 900 AND xmax >= 200 AND ymin <= 700 AND ymax >= 150"""
ORACLE["patches_source"] = with_(PATCHES) + """
SELECT patch_id, CAST(p AS BIGINT) AS pixel_idx, CAST(CASE WHEN e[p + 1] > 0 THEN 1 ELSE 0 END AS BIGINT) AS label,
""" + ",\n".join(f" CASE WHEN e[{k * 16} + p + 1] < -0.5 THEN 0.0::DOUBLE ELSE CAST(e[{k * 16} + p + 1] AS DOUBLE) END AS band_{k}" for k in range(4)) + """
FROM pat, (SELECT unnest(range(0, 16)) AS p) r"""
ORACLE["patches_u16"] = with_(PATCHES) + """
SELECT patch_id, CAST(p AS BIGINT) AS pixel_idx, CAST(CASE WHEN e[p + 1] > 0 THEN 1 ELSE 0 END AS BIGINT) AS label,
""" + ",\n".join(f" floor(CAST(e[{k * 16} + p + 1] AS DOUBLE) * 1024) + 32768 AS band_{k}" for k in range(4)) + """
FROM pat, (SELECT unnest(range(0, 16)) AS p) r"""
# the bits of a cell's numbers in turn, one by one
ORACLE["parcel_curve"] = with_(PARCELS) + """
SELECT parcel_id, CAST(sum(((i >> b) & 1) * (1::BIGINT << (2 * b)) + ((j >> b) & 1) * (1::BIGINT << (2 * b + 1))) AS BIGINT) AS curve_position
FROM (SELECT parcel_id, CAST(floor(xmin / 20) AS BIGINT) + 1073741824 AS i, CAST(floor(ymin / 20) AS BIGINT) + 1073741824 AS j FROM parcels),
 (SELECT CAST(unnest(range(0, 31)) AS INTEGER) AS b) bits GROUP BY parcel_id"""
ORACLE["scenes_source"] = with_(SCENES) + "SELECT * FROM scenes"
ORACLE["pixels_source"] = with_(PIXELS) + """
SELECT patch_id, pixel_idx, label, band_1 AS green, band_2 AS nir, band_4 AS red, band_8 AS swir16 FROM pixels"""
ORACLE["dedupe_pixels"] = with_(PIXELS, r"""ids AS (SELECT DISTINCT patch_id, CAST(regexp_extract(patch_id, 'task_(\d+)_worker_(.+)', 1) AS BIGINT) AS task_id,
 regexp_extract(patch_id, 'task_(\d+)_worker_(.+)', 2) AS worker_id FROM pixels),
won AS (SELECT patch_id FROM (SELECT *, row_number() OVER (PARTITION BY task_id
 ORDER BY (task_id * 7 + CAST(worker_id AS BIGINT) * 5) % 11 DESC, worker_id DESC) AS rn FROM ids) WHERE rn = 1)""") + """
SELECT p.* FROM pixels p JOIN won USING (patch_id)"""

ORACLE["dedupe_pixels_batches"] = with_(PIXELS, r"""tp AS (SELECT *, CAST(regexp_extract(patch_id, 'task_(\d+)_worker_(.+)', 1) AS BIGINT) AS task_id,
 CAST(regexp_extract(patch_id, 'task_(\d+)_worker_(.+)', 2) AS BIGINT) AS w FROM pixels),
both_ AS (SELECT *, 0 AS batch FROM tp UNION ALL SELECT * REPLACE (band_1 + 1 AS band_1), 2 AS batch FROM tp WHERE task_id % 3 = 0),
res AS (SELECT DISTINCT patch_id, task_id, w, batch,
 (task_id * 7 + w * 5) % 11 + CASE WHEN batch = 0 THEN 0 WHEN task_id % 2 = 0 THEN 100 ELSE -100 END AS t FROM both_),
won AS (SELECT patch_id, batch FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY t DESC, CAST(w AS VARCHAR) DESC, batch DESC) AS rn FROM res) WHERE rn = 1)""") + """
SELECT b.* EXCLUDE (task_id, w) FROM both_ b JOIN won USING (patch_id, batch)"""

ORACLE["score_stream"] = f"SELECT * FROM ({ORACLE['ndvi_confusion']}), ({ORACLE['auc_rank']})"
ORACLE["worker_stream"] = ORACLE["worker_results"]
ORACLE["monitor_stream"] = ORACLE["monitor_by_worker"]
ORACLE["progress_stream"] = ORACLE["progress"]


def _value(k: int, x: str, y: str) -> str:
    v = f"(scene_id * 31 + {x} * 7 + {y} * 13 + {k * 101} + {x} * {y})"
    return f"(({v} % 10000) + 10000) % 10000"


SCENE_PIXELS = f"""t AS (SELECT o_orderkey AS task_id, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderkey % 5 END AS scene_id,
 CAST(floor((o_orderkey * 37) % 2000 - 1000.25) AS BIGINT) AS x0, CAST(ceil((o_orderkey * 37) % 2000 + 20 - 1000.25) AS BIGINT) AS x1,
 CAST(floor((o_orderkey * 91) % 1500 - 700.5) AS BIGINT) AS y0, CAST(ceil((o_orderkey * 91) % 1500 + 20 - 700.5) AS BIGINT) AS y1 FROM orders),
g AS (SELECT *, x1 - x0 AS w, y1 - y0 AS h, unnest(range(0, (x1 - x0) * (y1 - y0))) AS p FROM t),
c AS (SELECT *, x0 + p % w AS x, y1 - 1 - p // w AS y FROM g),
k AS (SELECT *, CAST(floor(x / 2.0) AS BIGINT) AS x2, CAST(floor(y / 2.0) AS BIGINT) AS y2,
 CAST(floor(x / 16.0) AS BIGINT) AS tx, CAST(floor(y / 16.0) AS BIGINT) AS ty FROM c),
v AS (SELECT task_id, h, w, p, scene_id IS NOT NULL AND ((tx * 5 + ty * 3 + scene_id) % 7 + 7) % 7 <> 0 AS there,
 {_value(0, "x", "y")} AS v0, {_value(1, "x", "y")} AS v1, {_value(2, "x2", "y2")} AS v2 FROM k)"""
_SUMS = ", ".join(f"CAST(coalesce(sum(v{k} * (p + 1)) FILTER (WHERE there), 0) AS BIGINT) AS band_{k}" for k in range(3))
ORACLE["scene_pixels"] = with_(SCENE_PIXELS) + f"SELECT task_id, count(*) AS n_pixels, CAST(sum(p) AS BIGINT) AS at, {_SUMS} FROM v GROUP BY task_id"
ORACLE["scene_rasters"] = with_(SCENE_PIXELS) + f"SELECT task_id, CAST(h AS INTEGER) AS h, CAST(w AS INTEGER) AS w, {_SUMS} FROM v GROUP BY task_id, h, w"
