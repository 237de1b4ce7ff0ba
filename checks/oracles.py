"""SQL with the same result for each query, written independently of the package.

``sql`` puts the derived tables a statement names in front of it.
"""

import re

OPTICAL = ["b02", "b03", "b04", "b08"]

# ------------------------------------------------------------ derived tables

CTES = {
    "cube_s2": """
select 's2' as modality, 'T' || (l_suppkey % 5) as tile, cast(l_partkey % 4 as int) as patch_id,
  cast(date_trunc('month', l_shipdate) as date) as t, cast(l_orderkey % 16 as int) as y,
  cast(cast(floor(l_partkey / 4) as bigint) % 16 as int) as x,
  case when l_orderkey % 5 = 0 then null else l_quantity end as b02,
  l_extendedprice as b03, l_discount as b04, l_tax as b08,
  case when l_returnflag = 'R' then 1 else 0 end as clm,
  cast(cast(l_quantity as int) % 12 as int) as scl
from lineitem""",
    "cube_s1": """
select 's1_asc' as modality, 'T' || (o_custkey % 5) as tile,
  cast(o_orderkey % 4 as int) as patch_id, cast(date_trunc('month', o_orderdate) as date) as t,
  cast(cast(floor(o_orderkey / 4) as bigint) % 16 as int) as y,
  cast(cast(floor(o_orderkey / 64) as bigint) % 16 as int) as x,
  o_totalprice as vv, cast(o_orderkey % 97 as double) / 10 as vh,
  case when o_orderstatus = 'F' then 'DESCENDING' else 'ASCENDING' end as orbit
from orders""",
    "raw_s2": """
select modality, tile, patch_id, t, y, x, coalesce(b02, 'NaN'::double) as b02,
  b03 * 20000.0::double as b03, b04, case when b08 > 0 then b08 else 'NaN'::double end as b08,
  clm, scl
from cube_s2""",
    "cleaned_s2": """
select modality, tile, patch_id, t, y, x, case when isnan(b02) or b02 > 1e9 then null else b02 end
  as b02, case when b03 > 1e9 then null else b03 end as b03, b04,
  case when isnan(b08) or b08 > 1e9 then null else b08 end as b08, clm, scl
from raw_s2""",
    "unique_s2": """
select modality, tile, patch_id, t, y, x, max(b02) as b02, max(b03) as b03, max(b04) as b04,
  max(b08) as b08, max(clm) as clm, max(scl) as scl
from cube_s2 group by all""",
    "quality_s2": """
select tile, patch_id, modality, t, count(*) as n, count(*) filter (b02 is null) as n_nan,
  count(*) filter (clm = 1) as n_cld, sum(clm)::double as cld_sum,
  count(*) filter (scl = 0) as n_scl0
from cube_s2 group by all""",
    "usable": """
select tile, patch_id, modality, t from quality_s2
where n_nan < 0.3::double * n and n_cld < 0.5::double * n and n_scl0 < 0.5::double * n""",
    "scenes": """
select tile, t, 100.0::double * sum(clm) / count(*) as cloud_cover from cube_s2 group by all""",
    "weather": """
select 'T' || (user_id % 5) as tile, cast(ts as date) as t, event_type as variable,
  round(avg(value), 6) as v, count(*) as n
from events group by all""",
    "coarse_grid": """
select 'DEM' as tile, cast(floor(p_partkey / 20) as int) as y, cast(p_partkey % 20 as int) as x,
  p_retailprice as v
from part""",
    "frames": """
select 'T' || label as tile, cast(floor(vec_id / 120) as int) as patch_id,
  date '2017-01-01' + cast((vec_id % 120) * 3 as int) as t, embedding as pixels
from embeddings""",
    "frame_pixels": """
select tile, patch_id, t, cast(i as int) as pos, cast(floor(i / 8) as int) as y,
  cast(i % 8 as int) as x, pixels[i + 1]::double as value
from frames, range(64) r(i)""",
    "frame_times": """
select tile, patch_id, t,
  cast(row_number() over (partition by tile, patch_id order by t) - 1 as int) as ti,
  cast(date_diff('day', date '2014-03-03', t) as int) as doy,
  dayofyear(t)::double / dayofyear(make_date(year(t), 12, 31))::double as true_doy
from frames""",
    "series": """
select tile, patch_id, cast(count(*) as int) as n from frames group by all""",
    "tiles_metric": """
select 'C' || c_custkey as tile, (c_custkey % 100)::double * 109800.0::double as xmin,
  floor(c_custkey / 100)::double * 109800.0::double as ymin,
  (c_custkey % 100)::double * 109800.0::double + 109800.0::double as xmax,
  floor(c_custkey / 100)::double * 109800.0::double + 109800.0::double as ymax
from customer""",
    "tiles_lonlat": """
select 'C' || c_custkey as tile, (c_custkey % 36)::double - 9.75::double as xmin,
  (cast(floor(c_custkey / 36) as bigint) % 30)::double + 30.25::double as ymin
from customer""",
    "rois": """
select 'T' || (s_suppkey % 5) as tile, cast(s_suppkey as int) as roi,
  (s_suppkey % 13)::double * 10 + 2 as x0,
  (cast(floor(s_suppkey / 13) as bigint) % 12)::double * 10 + 2 as y0
from supplier""",
    # triangle (x0, y0), (x0 + 38, y0), (x0, y0 + 44): the hypotenuse bounds it
    "placed": """
select tile, patch_id, t, y, x, b02, b03, b04, b08, clm, scl,
  (x + 0.5::double) * 10 as px, (y + 0.5::double) * 10 as py
from cube_s2""",
    "in_roi": """
select p.*, r.roi, r.x0, r.y0 from placed p join rois r
on p.tile = r.tile and px between x0 and x0 + 38 and py between y0 and y0 + 44
where (px - x0) / 38 + (py - y0) / 44 < 1""",
    "region_cube": """
select 's2' as modality, 'T' || (l_suppkey % 5) as tile, cast(l_suppkey as int) as patch_id,
  cast(date_trunc('month', l_shipdate) as date) as t, cast(l_orderkey % 16 as int) as y,
  cast(cast(floor(l_partkey / 4) as bigint) % 16 as int) as x, l_quantity as b02,
  case when l_returnflag = 'R' then 1 else 0 end as clm
from lineitem""",
    "items": "select distinct tile, patch_id from region_cube",
    "item_reps": "select tile, patch_id, cast(rep as int) as rep from items, range(4) r(rep)",
    "draws": """
select *, cast('0x' || substr(md5('7:months:' || tile || ':' || patch_id || ':' || rep), 1, 13)
    as bigint)::double / 4503599627370496::double as u1,
  cast('0x' || substr(md5('7:start:' || tile || ':' || patch_id || ':' || rep), 1, 13)
    as bigint)::double / 4503599627370496::double as u2
from item_reps""",
    "spans": """
select *, 30 * (6 + cast(floor(u1 * 7) as int)) as days from draws""",
    "windows": """
select tile, patch_id, rep, win_start, win_start + days as win_end from (
  select *, date '1995-01-01' + cast(floor(u2 *
    (date_diff('day', date '1995-01-01', date '2000-12-31') - days + 1)) as int) as win_start
  from spans)""",
    "scene_files": """
select 'T' || l_suppkey || '/' || year(l_shipdate) || '/Sentinel2_T' || l_suppkey || '_' ||
  year(l_shipdate) || '/openEO_' || (l_partkey % 6) || '_clip.nc' as path, count(*) * 5000 as length
from lineitem group by 1
union all
select 'T' || o_custkey || '/' || year(o_orderdate) || '/Sentinel1_ASCENDING_T' || o_custkey ||
  '_' || year(o_orderdate) || '/openEO_' || (o_orderkey % 6) || '_clip.nc', count(*) * 5000
from orders group by 1""",
    "file_catalog": """
select case when path like '%Sentinel2%' then 's2' else 's1_asc' end as mod,
  split_part(path, '/', 4) as patch_id, split_part(path, '/', 1) as s2_tile, path as sits_path,
  length
from scene_files""",
    "roi_files": """
select 'T' || (l_suppkey % 5) || '/' || year(l_shipdate) || '/S2/openEO_' || l_suppkey || '.nc'
  as path, count(*) as length
from lineitem group by 1""",
    "sample_files": """
select 'root/T' || (o_custkey % 7) || '/Patch_id_openEO_' || (o_orderkey % 500) || '_clip_id' ||
  (o_custkey % 3) || '_' || case when o_orderkey % 3 = 0 then 's1_asc' else 's2' end || '.pt'
  as path
from orders group by 1""",
    "manifest_rows": """
select s_suppkey as k, 'Sentinel2_' || s_name as title, 'T' || (s_nationkey % 5) as tile,
  case when s_suppkey % 4 = 0 then null else cast(2017 + s_suppkey % 4 as varchar) end as year,
  length(s_name) + length(cast(s_suppkey as varchar)) * 2 as varying
from supplier""",
    "assets": """
select k, year, tile, title, 'openEO_' || k || '.nc' as asset, 'u' || k as href from manifest_rows
union all
select k, year, tile, title, 'stac.json', 's' from manifest_rows""",
    "targets": """
select *, 'base/' || tile || '/' || coalesce(year || '/', '') || title || '/' || asset as target
from assets""",
    "global_stats": """
select band, quantile_cont(v, 0.5) as med, quantile_cont(v, 0.05) as qmin,
  quantile_cont(v, 0.95) as qmax
from (unpivot (select b02, b03, b04, b08 from cube_s2) on b02, b03, b04, b08
  into name band value v) group by band""",
    "norm_stats": """
select band, round(med, 2) as med, round(qmin, 2) as qmin, round(qmax, 2) as qmax
from global_stats""",
    "norm_wide": """
select max(qmax) + 100 as big,
"""
    + ",\n".join(
        f"  max({s}) filter (band = '{b}') as {b}_{s}" for b in OPTICAL for s in ("med", "qmin", "qmax")
    )
    + "\nfrom norm_stats",
    "pixel_stats": """
select round(quantile_cont(value, 0.5), 2) as med, round(quantile_cont(value, 0.05), 2) as qmin,
  round(quantile_cont(value, 0.95), 2) as qmax
from frame_pixels""",
    "usable_s2": "select c.* from cube_s2 c semi join usable using (tile, patch_id, modality, t)",
    "prepared_s2": """
select tile, patch_id, t, y, x, max(b02) as b02, max(b03) as b03, max(clm) as clm,
  max((b02 is null)::int) as mask_nan
from usable_s2 group by all""",
    "dense_s2": """
select k.tile, k.patch_id, k.t, k.crop_id, cast(i as int) as pos,
  coalesce(b02, 0) as b02, coalesce(b03, 0) as b03, coalesce(clm, 0) as clm,
  coalesce(mask_nan, 4) as mask_nan
from (select distinct tile, patch_id, t, y // 8 as crop_id from prepared_s2 where y // 8 = x // 8) k
cross join range(64) r(i)
left join prepared_s2 p on p.tile = k.tile and p.patch_id = k.patch_id and p.t = k.t
  and p.y = k.crop_id * 8 + i // 8 and p.x = k.crop_id * 8 + i % 8""",
    "unique_modal": """
select 's2' as modality, tile, patch_id, t, y, x, max(b03) as value from usable_s2 group by all
union all
select 's1_asc', tile, patch_id, t, y, x, max(vv) from cube_s1 group by all""",
}


def sql(body: str) -> str:
    """``body`` with the derived tables it needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str):
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    parts = [f"{name} as ({CTES[name].strip()})" for name in needed]
    head = "with " + ",\n".join(parts)
    return f"{head}\n{body.strip()}"


def _u(label: str, *keys: str, seed=7) -> str:
    text = f"'{seed}:{label}:' || " + " || ':' || ".join(keys)
    return (
        f"(cast('0x' || substr(md5({text}), 1, 13) as bigint)::double / 4503599627370496::double)"
    )


def _rank_hash(label: str, *keys: str, seed=7) -> str:
    return f"md5('{seed}:{label}:' || " + " || ':' || ".join(keys) + ")"


S2_COLUMNS = "tile, patch_id, t, y, x, b02, b03, b04, b08, clm, scl"
ROW, COL = _u("row", "tile", "patch_id"), _u("col", "tile", "patch_id")
UNPIVOT_S2 = """(unpivot (select tile, b02, b03, b04, b08 from {source})
  on b02, b03, b04, b08 into name band value v)"""


def _norm(b: str, value: str) -> str:
    return f"({value} - {b}_med) / nullif({b}_qmax - {b}_qmin, 0)"


def _clip(b: str) -> str:
    return f"least(greatest(coalesce({b}, big), {b}_qmin), {b}_qmax)"


def _keys_weight(d: str) -> str:
    return f"""case when {d} <= 1 then 1.5::double*{d}*{d}*{d} - 2.5::double*{d}*{d} + 1
    when {d} < 2 then -0.5::double*{d}*{d}*{d} + 2.5::double*{d}*{d} - 4*{d} + 2 else 0 end"""


BODIES = {
    "read_cube": f"""select {S2_COLUMNS} from cube_s2
where tile in ('T1', 'T3') and year(t) in (1996, 1999)""",
    "write_samples": """select tile, patch_id, t, y, x, value as pixels from frame_pixels
where tile in ('T1', 'T2', 'T3')""",
    "merge_series": """select tile, patch_id, t, y, x, b02,
  case when month(t) <= 6 then clm end as clm, b03 from unique_s2""",
    "merge_conflicts": " union all ".join(
        f"""select tile, patch_id, t, y, x, '{b}' as band from cube_s2
group by all having count(distinct {b}) > 1"""
        for b in ("b02", "b03", "b08")
    ),
    "pending": """select distinct tile, patch_id, modality, t from cube_s2
except select tile, patch_id, modality, t from cube_s2 where clm = 1 and b04 > 0.09""",
    "scene_catalog": "select * from file_catalog where mod = 's2'",
    "build_catalog": "select * from file_catalog",
    "catalog_summary": """select mod, patch_id, s2_tile, count(*) as n_files,
  min(sits_path) as first_path, max(sits_path) as last_path from file_catalog group by all""",
    "missing_scenes": """select distinct c.mod, c.patch_id, 'T' || i as s2_tile
from (select distinct mod, patch_id from file_catalog where length > 5000) c, range(40) r(i)
where not exists (select 1 from file_catalog f where f.length > 5000 and f.mod = c.mod
  and f.patch_id = c.patch_id and f.s2_tile = 'T' || i)""",
    "union_catalogs": """select * from file_catalog
where (mod = 's2' and s2_tile = 'T1') or (mod = 's1_asc' and s2_tile = 'T2')""",
    "distinct_patches": "select distinct mod, patch_id from file_catalog",
    "sample_catalog": """select mod, substr(rest, 1, 2) as patch_id,
  cast(regexp_extract(rest, '^([0-9]+)', 1) as int) as patch_no, s2_tile, path as sits_path
from (select path, split_part(path, '/', 2) as s2_tile,
  case when path like '%s1_asc.pt' then 's1_asc' else 's2' end as mod,
  split_part(path, 'openEO_', 2) as rest from sample_files)
where s2_tile in ('T0', 'T1', 'T2', 'T3', 'T4')""",
    "catalog_len": """select 's2' as mod, count(distinct (s2_tile, patch_id)) as n_items
from file_catalog where mod = 's2'""",
    "small_files": "select path, length from scene_files where ceil(length / 1024) < 50",
    "job_ids": "select 'vito-j-' || s_suppkey as job_id from supplier",
    "manifest_assets": """select 'j-' || k as "jobId", year, tile, title, asset, href, target
from targets""",
    "target_path": """select distinct tile, t,
  case when month(t) = 3 then 'S2' when month(t) = 5 then tile || '/S2'
    else tile || '/' || year(t) || '/S2' end as target
from cube_s2""",
    "read_rois": """select tile, roi, x0 as xmin, y0 as ymin, x0 + 38 as xmax, y0 + 44 as ymax
from rois""",
    "select_tiles": "select * from tiles_metric where tile in ('C1', 'C20', 'C77', 'C149')",
    "item_keys": """select dense_rank() over (order by tile, patch_id) - 1 as item, tile, patch_id
from (select distinct 'T' || (o_custkey % 50) as tile, cast(o_orderkey % 900 as int) as patch_id
  from orders)""",
    "load_collection": """select tile, patch_id, t, y, x, b04, b02 from cube_s2
where t >= date '1996-03-01' and t < date '1998-01-01'""",
    "filter_props": "select * exclude (modality) from cube_s1 where orbit = 'ASCENDING'",
    "filter_scene_cloud": """select tile, t, count(*) as n, round(sum(b03), 2) as b03
from cube_s2 semi join (select tile, t from scenes where cloud_cover <= 33) using (tile, t)
group by all""",
    "select_modalities": """select modality, tile, count(*) as n from cube_s1 group by all""",
    "split_bands": """select tile, t, band, max(v) as value,
  case band when 'temperature-max' then 'TEMP_MAX' when 'temperature-min' then 'TEMP_MIN'
    else 'WIND_SPEED' end as suffix
from (select tile, t, v, case variable when 'click' then 'temperature-max'
  when 'view' then 'temperature-min' else 'wind-speed' end as band from weather)
group by tile, t, band""",
    "select_bands": "select tile, patch_id, modality, t, y, x, b04, b03 from cube_s2",
    "drop_bands": "select tile, patch_id, t, y, x, b03, b04, b08, clm from cube_s2",
    "order_bands": "select tile, patch_id, t, y, x, vh, vv from cube_s1",
    "stack_bands": " union all ".join(
        f"select tile, patch_id, t, y, x, '{b}' as band, {b} as value from cube_s2"
        for b in OPTICAL
    ),
    "cast_bands": """select tile, patch_id, t, y, x, cast(trunc(b02) as int) as b02,
  case when abs(trunc(b03)) <= 32767 then cast(trunc(b03) as int) end as b03, b04, b08
from cleaned_s2""",
    "date_quality": "select * from quality_s2",
    "usable_dates": "select * from usable",
    "usable_pixels": f"""select modality, {S2_COLUMNS} from usable_s2""",
    "filter_nodata_dates": """select tile, patch_id, t, y, x, b02 from cube_s2
semi join (select tile, patch_id, t from quality_s2 where n_nan < 0.3::double * n)
using (tile, patch_id, t)""",
    "filter_cloud_dates": """select tile, patch_id, t, y, x, clm, scl from cube_s2
semi join (select tile, patch_id, t from quality_s2
  where n_cld < 0.3::double * n and n_scl0 < 0.3::double * n)
using (tile, patch_id, t)""",
    "cloud_sum_dates": """select tile, patch_id, modality, t from quality_s2
where cld_sum < 0.3::double * n
union all select distinct tile, patch_id, modality, t from cube_s1""",
    "clean_missing": """select tile, patch_id, t, y, x, coalesce(b02, 0) as b02,
  coalesce(b03, 0) as b03, b04, coalesce(b08, 0) as b08, clm, scl from cleaned_s2""",
    "nan_count": """select tile, patch_id, t, y, x,
  (b02 is null)::int + (b03 is null)::int + (b08 is null)::int as nan_count from cleaned_s2""",
    "scl_nodata": """select tile, patch_id, t, y, x, (scl = 0)::int as nodata from cube_s2""",
    "merge_mask": """select tile, patch_id, t, y, x,
  (clm = 1 or scl in (0, 1, 3, 7, 8, 9, 10))::int as invalid from cube_s2""",
    "audit_no_nan": " union all ".join(
        f"select '{b}' as column_name, count(*) filter ({b} is null or isnan({b})) as n_missing from raw_s2"
        for b in OPTICAL
    ),
    "frame_quality": """select tile, patch_id, t, count(*) as n,
  count(*) filter (value::float >= 0.2::double) as n_nan,
  count(*) filter (value::float > 0.1::double) as n_cld,
  count(*) filter (value < 0) as n_scl0
from frame_pixels group by all""",
    "days_since": """select distinct tile, patch_id, t,
  cast(t - date '2014-03-03' as int) as days, cast(t - date '2014-03-03' as int) / 8.0::double
  as scaled, cast(t - date '2014-03-03' as int) as from_day_number from cube_s2""",
    "doy_fraction": """select distinct cast(l_shipdate as date) as t,
  round(dayofyear(l_shipdate)::double
    / (case when year(l_shipdate) % 4 = 0 then 366 else 365 end)::double, 9) as doy
from lineitem""",
    "slice_years": f"""select {S2_COLUMNS}, cast(year(t) as int) as year from cube_s2
where t between date '1996-01-01' and date '1996-12-31'
  or t between date '1998-01-01' and date '1998-12-31'""",
    "missing_years": """select tile, patch_id, 's2' as modality, cast(y as int) as year
from items, (values (1994), (1998), (2001), (2002)) v(y)
where not exists (select 1 from region_cube c where c.tile = items.tile
  and c.patch_id = items.patch_id and year(c.t) = v.y)""",
    "repeat_items": "select * from item_reps",
    "random_windows": "select * from windows",
    "crop_time": """select c.tile, c.patch_id, c.t, y, x, b02, clm, rep, win_start, win_end
from region_cube c join windows w on c.tile = w.tile and c.patch_id = w.patch_id
where rep < 2 and c.t >= win_start and c.t <= win_end""",
    "subsample_dates": f"""select {S2_COLUMNS} from cube_s2 semi join (
  select tile, patch_id, t from (select distinct tile, patch_id, t from cube_s2)
  qualify row_number() over (partition by tile, patch_id
    order by {_rank_hash('dates', 'tile', 'patch_id', "'s2'", 't')}, t) <= 20)
using (tile, patch_id, t)""",
    "pad_time": """select s.tile, s.patch_id, cast(k as int) as ti, coalesce(f.doy, 0) as doy,
  round(coalesce(f.true_doy, 0)::float::double, 5) as true_doy, (f.t is null)::int as padded,
  cast(i as int) as pos, coalesce(p.value, 0) as value
from series s cross join range(12) a(k) cross join range(64) b(i)
left join frame_times f on f.tile = s.tile and f.patch_id = s.patch_id and f.ti = k
left join frame_pixels p on p.tile = f.tile and p.patch_id = f.patch_id and p.t = f.t and p.pos = i""",
    "pad_heads": """select s.tile, s.patch_id, cast(k as int) as ti, coalesce(f.doy, 0) as doy,
  (f.t is null)::int as padded
from series s cross join range(12) a(k)
left join frame_times f on f.tile = s.tile and f.patch_id = s.patch_id and f.ti = k""",
    "pad_k": """select f.tile, f.patch_id, f.ti, 0 as padded, pos, value
from frame_times f join frame_pixels p using (tile, patch_id, t)
union all
select tile, patch_id, cast(n + k as int), 1, cast(i as int), 0
from series, range(3) a(k), range(64) b(i)""",
    "crop_center": """select tile, patch_id, t, y - 5 as y, x - 5 as x, b02, b03, b04, b08, clm, scl
from cube_s2 where y between 5 and 10 and x between 5 and 10""",
    "crop_random": f"""select tile, patch_id, t, y - r as y, x - c as x, b02, b03, b04, b08, clm, scl
from (select *, cast(floor({ROW} * 11) as int) as r, cast(floor({COL} * 11) as int) as c
  from cube_s2)
where y >= r and y < r + 6 and x >= c and x < c + 6""",
    "crop_offsets": f"""select tile, patch_id, cast(floor({ROW} * 385) as int) as row0,
  cast(floor({COL} * 385) as int) as col0 from items""",
    "crop_topleft": f"select {S2_COLUMNS} from cube_s2 where y < 8 and x < 8",
    "crop_frames": """select tile, patch_id, t, y - 2 as y, x - 3 as x, value from frame_pixels
where y between 2 and 5 and x between 3 and 6""",
    "tile_crops_diag": """select tile, patch_id, t, y % 4 as y, x % 4 as x, b02, b03, b04, b08, clm,
  scl, y // 4 as crop_id from cube_s2 where y // 4 = x // 4""",
    "tile_crops_grid": """select tile, patch_id, t, y % 4 as y, x % 4 as x, b02, b03, b04, b08, clm,
  scl, (y // 4) * 4 + x // 4 as crop_id from cube_s2""",
    "tile_frames": """select tile, patch_id, t, y % 4 as y, x % 4 as x, value,
  (y // 4) * 2 + x // 4 as crop_id from frame_pixels""",
    "sample_rois": f"""select tile, roi, round(cx - 2560, 3) as xmin, round(cy - 2560, 3) as ymin,
  round(cx + 2560, 3) as xmax, round(cy + 2560, 3) as ymax
from (select tile, roi,
    (xmin + 2560) + {_u('cx', 'tile', 'roi')} * ((xmax - 2560) - (xmin + 2560)) as cx,
    (ymin + 2560) + {_u('cy', 'tile', 'roi')} * ((ymax - 2560) - (ymin + 2560)) as cy
  from (select *, cast(i as int) as roi from tiles_metric, range(10) r(i)))""",
    "validate_rois": """select tile, 10::bigint as n_roi,
  (cast(substr(tile, 2) as int) % 7 <> 0)::int as area_ok,
  (cast(substr(tile, 2) as int) % 7 <> 0)::int as perimeter_ok from tiles_metric""",
    "filter_spatial": f"""select {S2_COLUMNS} from placed p
where exists (select 1 from rois r where r.tile = p.tile and px between x0 and x0 + 38
  and py between y0 and y0 + 44 and (px - x0) / 38 + (py - y0) / 44 < 1)""",
    "sample_by_feature": """select tile, roi, t, count(*) as n, round(sum(b03), 2) as b03
from in_roi group by all""",
    "clip_polygon": """select p.tile, roi, y - cast(ceil(y0 / 10 - 0.5) as int) as y,
  x - cast(ceil(x0 / 10 - 0.5) as int) as x,
  cast(floor((y0 + 44) / 10 - 0.5) - ceil(y0 / 10 - 0.5) + 1 as int) as h,
  cast(floor((x0 + 38) / 10 - 0.5) - ceil(x0 / 10 - 0.5) + 1 as int) as w,
  count(*) as n, count(*) filter ((px - x0) / 38 + (py - y0) / 44 < 1) as n_inside,
  round(sum(b03) filter ((px - x0) / 38 + (py - y0) / 44 < 1), 2) as b03
from placed p join rois r
on p.tile = r.tile and px between x0 and x0 + 38 and py between y0 and y0 + 44
group by all""",
    "match_rois": """select r.tile, r.roi, path, length from rois r join roi_files f
on split_part(path, '/', 1) = r.tile
  and cast(regexp_extract(path, 'openEO_([0-9]+)', 1) as int) = r.roi""",
    "resample_cubic": f"""select tile, cast(ty as int) as y, cast(tx as int) as x,
  round(sum(w * v) / sum(w), 6) as v
from (select tile, ty, tx, v, ({_keys_weight('dx')}) * ({_keys_weight('dy')}) as w
  from (select g.tile, ty, tx, v, abs(sx - g.x) as dx, abs(sy - g.y) as dy
    from (select *, (tx + 0.5::double) / 2 - 0.5::double as sx,
        (ty + 0.5::double) / 2 - 0.5::double as sy
      from range(40) a(tx), (select unnest(range(0, cast(count(*) // 10 as bigint))) as ty
        from part) b) c
    cross join range(-1, 3) d(i) cross join range(-1, 3) e(j)
    join coarse_grid g on g.x = cast(floor(sx) as int) + i and g.y = cast(floor(sy) as int) + j))
group by tile, ty, tx""",
    "resample_series": """select tile, patch_id, t, count(*) as n_cells, cast(min(ty) as int) as y_min,
  cast(max(tx) as int) as x_max
from (select distinct tile, patch_id, t, ty, tx from
    (select distinct tile, patch_id, t, y, x from cube_s1), range(48) a(ty), range(48) b(tx)
  where floor((ty + 0.5::double) / 3 - 0.5::double) between y - 2 and y + 1
    and floor((tx + 0.5::double) / 3 - 0.5::double) between x - 2 and x + 1)
group by all""",
    "resample_near": """select tile, v, cast(y * 3 + j as int) as y, cast(x * 3 + i as int) as x
from coarse_grid, range(3) a(i), range(3) b(j)""",
    "resample_resolution": """select tile, v, cast(y * 4 + j as int) as y,
  cast(x * 4 + i as int) as x from coarse_grid, range(4) a(i), range(4) b(j)""",
    "merge_variables": "select tile, t, "
    + ", ".join(
        f"max(v) filter (variable = '{v}') as {v}"
        for v in ("click", "view", "purchase", "signup", "error")
    )
    + " from weather where n % 7 <> 0 group by all",
    "assemble_items": """select tile, patch_id, a.n as s2_dates, a.first as s2_first, b.n as s1_dates,
  b.first as s1_first, 1 as no_dem
from (select tile, patch_id, cast(count(distinct t) as int) as n,
    cast(min(t) - date '2014-03-03' as int) as first from cube_s2 group by all) a
full join (select tile, patch_id, cast(count(distinct t) as int) as n,
    cast(min(t) - date '2014-03-03' as int) as first from cube_s1 group by all) b
using (tile, patch_id)""",
    "sample_scenes": f"""select path, length from scene_files
order by {_rank_hash('scenes', 'path')}, path limit 50""",
    "sample_scenes_by_tile": f"""select path, length, split_part(path, '/', 1) as tile
from scene_files qualify row_number() over (partition by split_part(path, '/', 1)
  order by {_rank_hash('scenes', 'path')}, path) <= 5""",
    "flatten_pixels": "select tile, patch_id, t, y, x, value from frame_pixels where y < 3 and x < 3",
    "band_stats": f"""select tile, band, round(quantile_cont(v, 0.5), 6) as med,
  round(quantile_cont(v, 0.05), 6) as qmin, round(quantile_cont(v, 0.95), 6) as qmax
from {UNPIVOT_S2.format(source='usable_s2')} group by all""",
    "band_stats_lower": f"""select tile, band, round(quantile_disc(v, 0.5), 6) as med,
  round(quantile_cont(v, 0.05), 6) as qmin, round(quantile_cont(v, 0.95), 6) as qmax
from {UNPIVOT_S2.format(source='cube_s2')} group by all""",
    "band_stats_located": """select 's2' as modality, band, round(med, 6) as med,
  round(qmin, 6) as qmin, round(qmax, 6) as qmax from global_stats""",
    "band_stats_integer": """select tile, band, round(quantile_cont(v, 0.5), 6) as med,
  round(quantile_cont(v, 0.05), 6) as qmin, round(quantile_cont(v, 0.95), 6) as qmax
from (select tile, 'b02' as band, trunc(b02) as v from cube_s2 where b02 is not null
  union all select tile, 'scl', scl from cube_s2) group by all""",
    "ratio_log_stats": """select tile, band, round(quantile_disc(v, 0.5), 6) as med,
  round(quantile_cont(v, 0.05), 6) as qmin, round(quantile_cont(v, 0.95), 6) as qmax
from (select tile, 'vv' as band, case when vv > 0 then ln(vv) end as v from cube_s1
  union all select tile, 'vh', case when vh > 0 then ln(vh) end from cube_s1
  union all select tile, 'ratio', case when vh > 0 and vv > 0 then ln(vv / vh) end from cube_s1)
where v is not null group by all""",
    "stats_table": """select stat, """
    + ", ".join(f"round(max(v) filter (band = '{b}'), 6) as {b}" for b in OPTICAL)
    + """ from (unpivot global_stats on med, qmin, qmax into name stat value v) group by stat""",
    "stats_roundtrip": """select modality, band, round(med, 6) as med, round(qmin, 6) as qmin,
  round(qmax, 6) as qmax
from (select 's2' as modality, * from global_stats union all
  select 's1_asc', band, quantile_cont(v, 0.5), quantile_cont(v, 0.05), quantile_cont(v, 0.95)
  from (select 'vv' as band, vv as v from cube_s1 union all select 'vh', vh from cube_s1)
  group by band)""",
    "merge_stats": """select variable as band, round(quantile_cont(v, 0.5), 6) as med,
  round(quantile_cont(v, 0.05), 6) as qmin, round(quantile_cont(v, 0.95), 6) as qmax,
  case variable when 'click' then 0 when 'view' then 1 when 'purchase' then 2
    when 'signup' then 3 else 4 end as ord, 'agera5' as modality
from weather group by variable""",
    "approximate_band_stats": """select count(b03) as n, 1 as med_ok, 1 as qmin_ok, 1 as qmax_ok from cube_s2""",
    "clip_bands": "select tile, patch_id, t, y, x, "
    + ", ".join(f"{_clip(b)} as {b}" for b in OPTICAL)
    + ", clm, scl from cube_s2, norm_wide",
    "normalize_bands": "select tile, patch_id, t, y, x, "
    + ", ".join(f"round({_norm(b, b)}, 6) as {b}" for b in OPTICAL)
    + ", clm, scl from cube_s2, norm_wide",
    "normalize_partial": "select tile, patch_id, t, y, x, "
    + ", ".join(f"round({_norm(b, b)}, 6) as {b}" for b in OPTICAL[:2])
    + ", b04, b08, clm, scl from cube_s2, norm_wide",
    "transform_modality": "select tile, patch_id, t, y, x, "
    + ", ".join(f"round({_norm(b, _clip(b))}, 6) as {b}" for b in OPTICAL)
    + ", clm, scl from cube_s2, norm_wide",
    "transform_frames": """select tile, patch_id, t, y, x,
  round((least(greatest(value, qmin), qmax) - med) / (qmax - qmin), 6) as value
from frame_pixels, pixel_stats""",
    "to_frames": """select tile, patch_id, t, 256 as n_pixels, round(sum(b02), 2) as b02_sum,
  round(sum(b02 * (y * 16 + x + 1)), 2) as b02_pos, round(sum(b03), 2) as b03_sum,
  round(sum(b03 * (y * 16 + x + 1)), 2) as b03_pos, sum(scl)::double as scl_sum,
  sum(scl * (y * 16 + x + 1))::double as scl_pos
from (select * replace (coalesce(b02, 0) as b02) from unique_s2) group by all""",
    "from_frames": "select tile, patch_id, t, y, x, value from frame_pixels",
    "to_samples": """select s.tile, s.patch_id, 'pixels' as band, cast(k as int) as ti,
  coalesce(f.doy, 0) as doy, (f.t is null)::int as padded, cast(i // 8 as int) as y,
  cast(i % 8 as int) as x, coalesce(p.value, 0) as value
from series s cross join range(12) a(k) cross join range(64) b(i)
left join frame_times f on f.tile = s.tile and f.patch_id = s.patch_id and f.ti = k
left join frame_pixels p on p.tile = f.tile and p.patch_id = f.patch_id and p.t = f.t and p.pos = i""",
    "permute": """select s.tile, s.patch_id, 12 as n_dates, cast(k as int) as ti, 1 as n_bands,
  coalesce(p.value, 0) as sixth
from series s cross join range(12) a(k)
left join frame_times f on f.tile = s.tile and f.patch_id = s.patch_id and f.ti = k
left join frame_pixels p on p.tile = f.tile and p.patch_id = f.patch_id and p.t = f.t and p.pos = 5""",
    "select_dates": """select s.tile, s.patch_id, 'pixels' as band, slot as ti,
  coalesce(f.doy, 0) as doy, (f.t is null)::int as padded, cast(i // 8 as int) as y,
  cast(i % 8 as int) as x, coalesce(p.value, 0) as value
from series s cross join (values (0, 0), (1, 2), (2, 5), (3, -1), (4, -1)) a(slot, k)
cross join range(64) b(i)
left join frame_times f on f.tile = s.tile and f.patch_id = s.patch_id and f.ti = k
left join frame_pixels p on p.tile = f.tile and p.patch_id = f.patch_id and p.t = f.t and p.pos = i""",
    "load_samples": f"""select tile, patch_id, t, y - r as y, x - c as x, value
from (select *, cast(floor({ROW} * 5) as int) as r, cast(floor({COL} * 5) as int) as c
  from frame_pixels)
semi join (select tile, patch_id, t from frames
  qualify row_number() over (partition by tile, patch_id
    order by {_rank_hash('dates', 'tile', 'patch_id', "'s2'", 't')}, t) <= 6)
using (tile, patch_id, t)
where y >= r and y < r + 4 and x >= c and x < c + 4""",
    "convert": """select tile, patch_id, t, crop_id, 64 as n_pixels,
  round(sum(b02), 2) as b02_sum, round(sum(b02 * (pos + 1)), 2) as b02_pos,
  round(sum(b03), 2) as b03_sum, round(sum(b03 * (pos + 1)), 2) as b03_pos,
  sum(mask_nan)::double as mask_nan_sum, sum(mask_nan * (pos + 1))::double as mask_nan_pos,
  sum(clm)::double as clm_sum, sum(clm * (pos + 1))::double as clm_pos,
  cast(t - date '2014-03-03' as int) as doy
from dense_s2 where not (tile = 'T4' and patch_id = 2)
group by all""",
    "yearly_convert": """select tile, patch_id, modality, t, 0 as crop_id, cast(year(t) as int) as year,
  256 as n_pixels, round(sum(value), 2) as total
from unique_modal where year(t) in (1997, 1999) group by all""",
    "multimodal_windows": """select m.tile, m.patch_id, modality, t, y // 8 as crop_id, w.rep,
  64 as n_pixels, round(sum(value), 2) as total
from unique_modal m join windows_of_patches w
  on m.tile = w.tile and m.patch_id = w.patch_id and t between win_start and win_end
where y // 8 = x // 8 group by all""",
    "windows_resume": """select m.tile, m.patch_id, modality, t, y // 8 as crop_id, w.rep,
  64 as n_pixels, round(sum(value), 2) as total
from unique_modal m join windows_of_patches w
  on m.tile = w.tile and m.patch_id = w.patch_id and t between win_start and win_end
where y // 8 = x // 8 and w.rep <> 1 group by all""",
    "nodata_area": """select tile, patch_id, t, 256::bigint as n, greatest(256 - count(b02), 0) as n_nan
from cube_s2 group by all""",
    "normalize_other_modality": """select modality, tile, round(sum(case modality
    when 's2' then (least(greatest(coalesce(b03, 5100.0), 0.0), 5000.0) - 1000.0) / 5000.0
    when 's2_l1c' then (least(greatest(coalesce(b03, 9100.0), 500.0), 9000.0) - 2000.0) / 8500.0
    else b03 end), 4) as b03, count(*) as n
from (select tile, b03, ['s2', 's2_l1c', 's3'][patch_id % 3 + 1] as modality from cube_s2) group by all""",
    "without_stats": """select * from (values ('s2', 'vv'), ('s1_asc', 'b03'), ('s1_asc', 'vv')) v(modality, band)
where exists (select 1 from cube_s2)""",
    "merge_nan": """select tile, t, variable,
  case when day(t) % 6 <> 0 then v end as v from weather""",
    "rois_with_holes": """select tile, y, x, count(*) as n from cube_s2
where (x between 1 and 8 and y between 1 and 8 and not (x between 3 and 5 and y between 3 and 6))
  or (x between 11 and 14 and y between 10 and 13) group by all""",
    "manifest_errors": """select 'j-' || s_suppkey as "jobId",
  case s_suppkey % 5 when 0 then 'malformed' when 1 then 'no assets' else 'absent' end as reason
from supplier where s_suppkey % 5 < 3""",
    "load_direct": "select tile, patch_id, t, y - r as y, x - c as x, "
    + ", ".join(
        f"round({_norm(b, f'least(greatest(coalesce({b}, 0), {b}_qmin), {b}_qmax)')}, 6) as {b}"
        for b in OPTICAL
    )
    + f""", clm, scl, (scl = 0)::int as mask_nan
from (select *, cast(floor({ROW} * 9) as int) as r, cast(floor({COL} * 9) as int) as c from cube_s2)
semi join (select tile, patch_id, t from usable
  qualify row_number() over (partition by tile, patch_id
    order by {_rank_hash('dates', 'tile', 'patch_id', "'s2'", 't')}, t) <= 20)
using (tile, patch_id, t), norm_wide
where y >= r and y < r + 8 and x >= c and x < c + 8""",
    "load_stored": f"""select s.tile, s.patch_id, 'pixels' as band, cast(k as int) as ti,
  coalesce(f.doy, 0) as doy, (f.t is null)::int as padded, cast(i // 4 as int) as y,
  cast(i % 4 as int) as x,
  case when value is null then 0
    else round((least(greatest(value, qmin), qmax) - med) / (qmax - qmin), 6) end as value
from series s cross join range(10) a(k) cross join range(16) b(i) cross join pixel_stats
left join (select *, row_number() over (partition by tile, patch_id order by t) - 1 as at
  from (select * from frame_times qualify row_number() over (partition by tile, patch_id
    order by {_rank_hash('dates', 'tile', 'patch_id', "'s2'", 't')}, t) <= 10)) f
  on f.tile = s.tile and f.patch_id = s.patch_id and f.at = k
left join frame_pixels p on p.tile = f.tile and p.patch_id = f.patch_id and p.t = f.t
  and p.y = 2 + i // 4 and p.x = 2 + i % 4""",
    "dataset_stats": f"""select stat, round(max(v) filter (band = 'b02'), 6) as b02,
  round(max(v) filter (band = 'b04'), 6) as b04
from (unpivot (select band, quantile_cont(v, 0.5) as med, quantile_cont(v, 0.05) as qmin,
    quantile_cont(v, 0.95) as qmax
  from (select tile, patch_id, 'b02' as band, b02 as v from region_cube
    union all select tile, patch_id, 'b04', clm * 2.0::double from region_cube)
  semi join (select tile, patch_id from items
    order by {_rank_hash('scenes', "tile || '/' || patch_id")}, tile || '/' || patch_id limit 10)
  using (tile, patch_id) group by band) on med, qmin, qmax into name stat value v)
group by stat""",
    "sample_stats": f"""select stat, round(max(v) filter (band = 'vv'), 6) as vv,
  round(max(v) filter (band = 'vh'), 6) as vh, round(max(v) filter (band = 'ratio'), 6) as ratio
from (unpivot (select band, quantile_disc(v, 0.5) as med, quantile_cont(v, 0.05) as qmin,
    quantile_cont(v, 0.95) as qmax
  from (select tile, patch_id, y, x, 'vv' as band, case when vv > 0 then ln(vv) end as v
      from cube_s1
    union all select tile, patch_id, y, x, 'vh', case when vh > 0 then ln(vh) end from cube_s1
    union all select tile, patch_id, y, x, 'ratio',
      case when vh > 0 and vv > 0 then ln(vv / vh) end from cube_s1)
  semi join (select tile, patch_id from (select distinct tile, patch_id from cube_s1)
    qualify row_number() over (partition by tile
      order by {_rank_hash('scenes', "tile || '/' || patch_id")}) <= 3) using (tile, patch_id)
  where y < 8 and x < 8 and v is not null group by band) on med, qmin, qmax
  into name stat value v)
group by stat""",
    "clip_scenes": """select c.tile, patch_id as roi, t,
  cast(floor((y0 + 44) / 10 - 0.5) - ceil(y0 / 10 - 0.5) + 1 as int) as h,
  cast(floor((x0 + 38) / 10 - 0.5) - ceil(x0 / 10 - 0.5) + 1 as int) as w,
  count(*) as n, count(*) filter (inside) as n_inside, sum(b02) filter (inside) as b02
from (select *, (x * 10 + 5 - x0) / 38 + (y * 10 + 5 - y0) / 44 < 1 as inside
  from region_cube r join rois on r.tile = rois.tile and roi = patch_id
  where x * 10 + 5 between x0 and x0 + 38 and y * 10 + 5 between y0 and y0 + 44
    and roi % 10 <> 3) c
group by c.tile, patch_id, t, x0, y0
having coalesce(sum(clm) filter (inside), 0) < 0.02::double *
  (floor((y0 + 44) / 10 - 0.5) - ceil(y0 / 10 - 0.5) + 1) *
  (floor((x0 + 38) / 10 - 0.5) - ceil(x0 / 10 - 0.5) + 1)""",
    "clip_tile_grid": """select c.tile, patch_id as roi, t,
  cast(floor((y0 + 44) / 10 - 0.5) - ceil(y0 / 10 - 0.5) + 1 as int) as h,
  cast(floor((x0 + 38) / 10 - 0.5) - ceil(x0 / 10 - 0.5) + 1 as int) as w,
  count(*) as n, count(*) filter (inside) as n_inside, sum(b02) filter (inside) as b02
from (select *, (x * 10 + 5 - x0) / 38 + (y * 10 + 5 - y0) / 44 < 1 as inside
  from region_cube r join rois on r.tile = rois.tile and roi = patch_id
  where x * 10 + 5 between x0 and x0 + 38 and y * 10 + 5 between y0 and y0 + 44) c
group by c.tile, patch_id, t, x0, y0""",
    "clip_stored": """select tile, roi, t, count(*) as n, round(sum(b03), 2) as b03
from in_roi group by all""",
    "clip_geojson": """select c.tile, roi, patch_id, t,
  cast(floor((y0 + 44) / 10 - 0.5) - ceil(y0 / 10 - 0.5) + 1 as int) as h,
  cast(floor((x0 + 38) / 10 - 0.5) - ceil(x0 / 10 - 0.5) + 1 as int) as w,
  count(*) as n, count(*) filter (inside) as n_inside, sum(b02) filter (inside) as b02
from (select r.*, roi, x0, y0, (x * 10 + 5 - x0) / 38 + (y * 10 + 5 - y0) / 44 < 1 as inside
  from region_cube r join rois on r.tile = rois.tile
  where x * 10 + 5 between x0 and x0 + 38 and y * 10 + 5 between y0 and y0 + 44) c
group by c.tile, roi, patch_id, t, x0, y0
having coalesce(sum(clm) filter (inside), 0) < 0.02::double *
  (floor((y0 + 44) / 10 - 0.5) - ceil(y0 / 10 - 0.5) + 1) *
  (floor((x0 + 38) / 10 - 0.5) - ceil(x0 / 10 - 0.5) + 1)""",
    "missing_scenes_everywhere": """select c.mod, c.patch_id, r.s2_tile
from (select distinct mod, patch_id from file_catalog where length > 5000) c,
  (select distinct s2_tile from file_catalog) r
where not exists (select 1 from file_catalog f where f.length > 5000 and f.mod = c.mod
  and f.patch_id = c.patch_id and f.s2_tile = r.s2_tile)""",
    "sample_shortfall": """select w.tile, count(path) as n_scenes
from (select 'T' || i as tile from range(0, 200, 3) r(i)) w
left join scene_files f on split_part(path, '/', 1) = w.tile group by 1 having count(path) < 60""",
    "missing_tiles": """select 'C' || i as tile from range(0, 2000, 7) r(i)
where 'C' || i not in (select tile from tiles_metric)""",
    "create_cubes": """select tile || '/' || year(t) || '/' || title as target, roi, modality,
  count(*) as n, round(sum(value), 2) as total
from (select p.tile, t, title, modality, roi, value
  from (select tile, t, y, x, 'S2' as title, modality, b03 as value
      from cube_s2 semi join (select tile, t from scenes where cloud_cover <= 34) using (tile, t)
    union all
    select tile, t, y, x, 'S1_ASCENDING', modality, vv from cube_s1
    where orbit = 'ASCENDING') p
  join rois r on p.tile = r.tile
    and x * 10 + 5 between x0 and x0 + 38 and y * 10 + 5 between y0 and y0 + 44
  where t >= date '1996-01-01' and t < date '1998-01-01'
    and (x * 10 + 5 - x0) / 38 + (y * 10 + 5 - y0) / 44 < 1)
group by all""",
}
CTES["windows_of_patches"] = """
select tile, patch_id, rep, win_start, win_start + days as win_end from (
  select *, date '1995-01-01' + cast(floor(u2 *
    (date_diff('day', date '1995-01-01', date '2000-12-31') - days + 1)) as int) as win_start
  from (select *, 30 * (6 + cast(floor(u1 * 7) as int)) as days from (
    select *, {u1} as u1, {u2} as u2
    from (select distinct tile, patch_id from cube_s2), (select cast(i as int) as rep from range(4) r(i)))))
""".format(
    u1=_u("months", "tile", "patch_id", "rep"), u2=_u("start", "tile", "patch_id", "rep")
)
# Transverse Mercator on WGS84 (third-order series), with the constants written out
CTES["ellipsoid"] = """
select 1 / 298.257223563::double / (2 - 1 / 298.257223563::double) as n"""
CTES["series_terms"] = """
select n, 6378137.0::double / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * 0.9996::double as k,
  2 * sqrt(n) / (1 + n) as e,
  n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 as a1, 13 * n**2 / 48 - 3 * n**3 / 5 as a2,
  61 * n**3 / 240 as a3,
  n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 as b1, n**2 / 48 + n**3 / 15 as b2,
  17 * n**3 / 480 as b3,
  2 * n - 2 * n**2 / 3 - 2 * n**3 as d1, 7 * n**2 / 3 - 8 * n**3 / 5 as d2,
  56 * n**3 / 15 as d3
from ellipsoid"""


def _forward(source: str) -> str:
    """(tile, corner, zone, east, north) of (tile, corner, zone, lon, lat) rows."""
    return f"""select tile, corner, zone,
  500000 + k * (eta + a1 * cos(2*xi) * sinh(2*eta) + a2 * cos(4*xi) * sinh(4*eta)
    + a3 * cos(6*xi) * sinh(6*eta)) as east,
  k * (xi + a1 * sin(2*xi) * cosh(2*eta) + a2 * sin(4*xi) * cosh(4*eta)
    + a3 * sin(6*xi) * cosh(6*eta)) as north
from (select *, atan2(tt, cos(dl)) as xi, atanh(sin(dl) / sqrt(1 + tt * tt)) as eta
  from (select *, radians(lon) - radians(zone * 6 - 183) as dl,
      sinh(atanh(sin(radians(lat))) - e * atanh(e * sin(radians(lat)))) as tt
    from {source}, series_terms))"""


CTES["tile_corners"] = """
select tile, corner, cast(floor((xmin + 0.5 + 180) / 6) + 1 as int) as zone, xmin + dx as lon,
  ymin + dy as lat
from tiles_lonlat, (values (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1)) v(corner, dx, dy)"""
CTES["tile_origin"] = """
select tile, 0 as corner, cast(floor((xmin + 180) / 6) + 1 as int) as zone, xmin as lon,
  ymin as lat from tiles_lonlat"""
CTES["utm_corners"] = _forward("tile_corners")
CTES["utm_origin"] = _forward("tile_origin")
CTES["utm_tiles"] = """
select tile, zone, min(east) as xmin, min(north) as ymin, max(east) as xmax, max(north) as ymax
from utm_corners group by all"""
CTES["utm_rois"] = f"""
select tile, zone, roi,
  (xmin + 2560) + {_u('cx', 'tile', 'roi')} * ((xmax - 2560) - (xmin + 2560)) - 2560 as xmin,
  (ymin + 2560) + {_u('cy', 'tile', 'roi')} * ((ymax - 2560) - (ymin + 2560)) - 2560 as ymin
from (select *, cast(i as int) as roi from utm_tiles, range(3) r(i))"""
BODIES["to_utm_roundtrip"] = """select tile, zone, round(east, 3) as east, round(north, 3) as north,
  1 as returns from utm_origin"""
BODIES["generate_rois"] = """select tile, roi, zone, round(xmin, 3) as xmin,
  round(ymin + 5120, 3) as ymax, 5 as corners,
  round(zone * 6 - 183 + degrees(atan2(sinh(eta0), cos(xi0))), 7) as lon,
  round(degrees(chi + d1 * sin(2*chi) + d2 * sin(4*chi) + d3 * sin(6*chi)), 7) as lat
from (select *, asin(sin(xi0) / cosh(eta0)) as chi
  from (select *, xi - b1 * sin(2*xi) * cosh(2*eta) - b2 * sin(4*xi) * cosh(4*eta)
      - b3 * sin(6*xi) * cosh(6*eta) as xi0,
      eta - b1 * cos(2*xi) * sinh(2*eta) - b2 * cos(4*xi) * sinh(4*eta)
      - b3 * cos(6*xi) * sinh(6*eta) as eta0
    from (select *, ymin / k as xi, (xmin - 500000) / k as eta from utm_rois, series_terms)))"""
BODIES["resolve_manifests"] = """select 'vito-j-' || k as job_id, year, tile, title, asset, href,
  target
from targets join (select s_suppkey as k, length(manifest) as size from manifest_text)
using (k)
where size % 3 <> 0 and not (asset = 'stac.json' and coalesce(year, '') = '2018')"""
CTES["manifest_text"] = """
select s_suppkey, '{"properties":{"title":"Sentinel2_' || s_name ||
  '","card4l:processing_chain":{"process_graph":{"loadcollection1":{"arguments":' ||
  '{"temporal_extent":' || case when s_suppkey % 4 = 0 then 'null'
    else '["' || (2017 + s_suppkey % 4) || '-01-01","x"]' end ||
  '}},"filterspatial1":{"arguments":{"geometries":{"features":[{"properties":{"Name":"T' ||
  (s_nationkey % 5) || '"}}]}}}}}},"assets":{"openEO_' || s_suppkey || '.nc":{"href":"u' ||
  s_suppkey || '"},"stac.json":{"href":"s"}}}' as manifest
from supplier"""
BODIES["crop_time_random"] = BODIES["crop_time"]
CTES["deliveries"] = """
select *, t >= '1998-01-01' and t < '2001-01-01' as one, month(t) < 10 and t >= '1996-06-01' as two
from unique_s2"""
CTES["first_limit"] = "select max(t) - 1500 as after_one from deliveries where one"
CTES["second_limit"] = """
select after_one, max(t) - 1500 as after_two from deliveries, first_limit
where one or (two and t >= after_one) group by after_one"""
CTES["delivered"] = """
select d.*, one or (two and t >= after_one) or t >= after_two as taken,
  (two and t < after_one) or t < after_two as late
from deliveries d, second_limit"""
BODIES["ingest_stream"] = "select modality, tile, patch_id, t, y, x, b02, b03, b04, b08 from usable_s2"
CTES["files"] = """
select tile, patch_id, t, y, x, b02, case when x = i * 3 then b03 + i else b03 end as b03
from unique_s2, range(3) r(i)
where (i = 0 and month(t) <= 5) or (i = 1 and month(t) >= 4 and t < '1998-01-01') or (i = 2 and y % 3 = 0)"""
BODIES["merge_into_stored"] = """select tile, patch_id, t, y, x,
  case when min(b02) = max(b02) then min(b02) end as b02,
  case when min(b03) = max(b03) then min(b03) end as b03 from files group by all"""
BODIES["merge_into_conflicts"] = """select tile, patch_id, t, y, x, 'b03' as band from files group by all
having min(b03) <> max(b03)"""
BODIES["load_collection_stored"] = """select tile, patch_id, t, y, x, b04, b02 from unique_s2
where t >= '1996-03-01' and t < '1998-01-01' and tile in (
  select 'T' || (s_suppkey % 5) from supplier where s_suppkey % 5 < 3)"""
CTES["dense_pixels"] = """
select 's2' as modality, tile, patch_id, t, y, x, value as v, (value > 0.1::double)::int as clm
from frame_pixels where value >= -0.065::double
union all
select 's1_asc', tile, patch_id, t, y, x, value * 3, null from frame_pixels where value >= -0.075::double
union all
select 'dem', tile, patch_id, null, y, x, max(value), null from frame_pixels group by all"""
CTES["dense_counts"] = """
select modality, tile, patch_id, t, count(v) > 0.7::double * 64 as whole, coalesce(sum(clm), 0) < 0.12::double * 64 as clear
from dense_pixels group by all"""
CTES["dense_crops"] = """
select d.modality, d.tile, d.patch_id, d.t, y // 4 as crop_id, round(sum(v), 3) as total,
  (16 - count(v))::int as n_nan, any_value(whole) as whole, any_value(clear) as clear
from dense_pixels d join dense_counts c on d.modality = c.modality and d.tile = c.tile
  and d.patch_id = c.patch_id and d.t is not distinct from c.t
where y // 4 = x // 4 group by all"""
BODIES["convert_whole"] = """select tile, patch_id, modality, t, crop_id, total, n_nan from dense_crops
where modality <> 's2' or (whole and clear)"""
BODIES["yearly_whole"] = """select tile, patch_id, modality, t, crop_id, cast(year(t) as int) as year, total, n_nan
from dense_crops where year(t) in (2016, 2017) and (modality <> 's2' or (whole and clear))"""
CTES["dense_windows"] = """
select tile, patch_id, rep, win_start, win_start + days as win_end from (
  select *, date '2017-01-01' + cast(floor(u2 *
    (date_diff('day', date '2017-01-01', date '2018-06-30') - days + 1)) as int) as win_start
  from (select *, 30 * (6 + cast(floor(u1 * 7) as int)) as days from (
    select *, {u1} as u1, {u2} as u2
    from (select distinct tile, patch_id from frames), (select cast(i as int) as rep from range(4) r(i)))))
""".format(
    u1=_u("months", "tile", "patch_id", "rep"), u2=_u("start", "tile", "patch_id", "rep")
)
BODIES["windows_whole"] = """select tile, patch_id, modality, t, crop_id, rep, total, n_nan
from dense_crops join dense_windows using (tile, patch_id)
where (t is null or t between win_start and win_end) and (modality = 'dem' or whole)
  and (modality <> 's2' or clear)"""
BODIES["crop_time_many"] = """select modality, tile, patch_id, rep, win_start, count(*) as n,
  count(distinct t) as dates, max(t) as last
from dense_pixels join (select distinct tile, patch_id from frames) using (tile, patch_id)
join (select cast(i as int) as rep, date '2016-11-20' + cast(i * 23 as int) as win_start from range(20) r(i))
  on t is null or (t >= win_start and t <= win_start + rep * 9 - 9) group by all"""
BODIES["ingest_redelivered"] = """
select modality, tile, patch_id, t, y, x, b02, b03, b04, b08, false as late
from (select * from delivered where taken) join (
  select modality, tile, patch_id, t from delivered where taken group by all
  having count(*) filter (b02 is null) < 0.3::double * count(*)
    and sum(clm) < 0.5::double * count(*) and count(*) filter (scl = 0) < 0.5::double * count(*))
  using (modality, tile, patch_id, t)
union all
select modality, tile, patch_id, t, y, x, b02, b03, b04, b08, true from delivered where late"""


CTES["weather_grid"] = """
select make_date(year(o_orderdate), 1, 1) as t, cast(o_orderkey % 24 as int) as y,
  cast(floor(o_custkey / 3)::bigint % 24 as int) as x, min(o_totalprice)::double as temp,
  max(o_totalprice)::double as rain
from orders group by all"""
CTES["warp_grids"] = """
select 'S' || s_suppkey as tile, 430000 + (s_suppkey % 17) * 5003.0::double as x0,
  5100000 + (s_suppkey % 13) * 7001.0::double as y0 from supplier"""
CTES["warp_nodes"] = """
select tile, jy, jx, (lon - 2.0::double) / 0.1::double - 0.5::double as sx,
  (46.6::double - lat) / 0.1::double - 0.5::double as sy
from (select tile, jy, jx, 3 + degrees(atan2(sinh(eta0), cos(xi0))) as lon,
    degrees(chi + d1 * sin(2*chi) + d2 * sin(4*chi) + d3 * sin(6*chi)) as lat
  from (select *, asin(sin(xi0) / cosh(eta0)) as chi
    from (select *, xi - b1 * sin(2*xi) * cosh(2*eta) - b2 * sin(4*xi) * cosh(4*eta)
        - b3 * sin(6*xi) * cosh(6*eta) as xi0,
        eta - b1 * cos(2*xi) * sinh(2*eta) - b2 * cos(4*xi) * sinh(4*eta)
        - b3 * cos(6*xi) * sinh(6*eta) as eta0
      from (select *, (y0 - (jy * 8 + 0.5::double) * 2500) / k as xi,
          (x0 + (jx * 8 + 0.5::double) * 2500 - 500000) / k as eta
        from warp_grids, range(4) a(jy), range(4) b(jx), series_terms))))"""
CTES["warp_pixels"] = """
select tile, y, x, a.sy + (b.sy - a.sy) * fx + ((c.sy + (d.sy - c.sy) * fx) - (a.sy + (b.sy - a.sy) * fx)) * fy as sy,
  a.sx + (b.sx - a.sx) * fx + ((c.sx + (d.sx - c.sx) * fx) - (a.sx + (b.sx - a.sx) * fx)) * fy as sx
from (select y, x, y // 8 as cy, x // 8 as cx, (y % 8) / 8.0::double as fy, (x % 8) / 8.0::double as fx
  from range(20) u(y), range(20) v(x)) p
join warp_nodes a on a.jy = cy and a.jx = cx
join warp_nodes b using (tile) join warp_nodes c using (tile) join warp_nodes d using (tile)
where b.jy = cy and b.jx = cx + 1 and c.jy = cy + 1 and c.jx = cx and d.jy = cy + 1 and d.jx = cx + 1"""
_WARP_DIGEST = """select tile, t, count(*) as n, round(sum(temp * (y * 20 + x + 1)), 1) as temp,
  round(sum(rain * (y * 20 + x + 1)), 1) as rain"""
BODIES["warp_near"] = f"""{_WARP_DIGEST.replace('1)), 1)', '1)), 2)')}
from (select p.tile, p.y, p.x, t, temp, rain from warp_pixels p
  join weather_grid w on w.y = floor(sy + 0.5::double) and w.x = floor(sx + 0.5::double)) group by tile, t"""
BODIES["warp_cubic"] = f"""{_WARP_DIGEST}
from (select tile, y, x, t, sum(weight * temp) / sum(weight) as temp, sum(weight * rain) / sum(weight) as rain
  from (select p.tile, p.y, p.x, t, temp, rain,
      ({_keys_weight('abs(sy - w.y)')}) * ({_keys_weight('abs(sx - w.x)')}) as weight
    from warp_pixels p, range(-1, 3) i(i), range(-1, 3) j(j), weather_grid w
    where w.y = floor(sy) + i and w.x = floor(sx) + j)
  group by tile, y, x, t having sum(weight) >= 0.5::double) group by tile, t"""
CTES["item_dates"] = f"""
select m.modality, m.longest, d.* from (
    select p.tile, p.patch_id, p.t, sum(value) as s, count(*) filter (value > 0) as pos,
      sum((least(greatest(value, qmin), qmax) - med) / (qmax - qmin)) as z
    from frame_pixels p cross join pixel_stats where y between 2 and 5 and x between 2 and 5
    group by p.tile, p.patch_id, p.t) d
  cross join (values ('s2', 10), ('s1_asc', 6), ('s1_desc', 4), ('agera5', null)) m(modality, longest)
where (modality not like 's1%' or day(t) % 2 = 0) and (modality <> 's1_desc' or tile <> 'T1')
qualify longest is null or row_number() over (partition by modality, tile, patch_id
  order by {_rank_hash('dates', 'tile', 'patch_id', 'modality', 't')}, t) <= longest"""
CTES["item_series"] = """
select modality, tile, patch_id, count(*)::int as n_dates,
  greatest(coalesce(any_value(longest), 0) - count(*), 0)::int as padded,
  round(sum(case modality when 's2' then z when 's1_asc' then 6 * s when 's1_desc' then 2 * s
    else s / 2 end), 4) as total,
  sum(date_diff('day', date '2014-03-03', t))::bigint as days,
  (case modality when 's1_asc' then sum(pos) end)::bigint as masked
from item_dates group by modality, tile, patch_id
union all
select 'dem', tile, patch_id, 1, 0, round(s, 4), 0, null from item_dates where modality = 'agera5'
qualify row_number() over (partition by tile, patch_id order by t) = 1"""
BODIES["load_items"] = """select i.tile, i.patch_id, m.modality, n_dates, padded, total, days, masked
from (select distinct tile, patch_id from frames) i
cross join (values ('s2'), ('s1_asc'), ('s1_desc'), ('agera5'), ('dem')) m(modality)
left join item_series s on s.tile = i.tile and s.patch_id = i.patch_id and s.modality = m.modality"""
BODIES["project_rings"] = f"""select tile, roi, 5120.0::double as w, 5120.0::double as h,
  0.0::double as away from ({BODIES["generate_rois"]})"""
BODIES["read_user_stats"] = f"""select * from ({BODIES["stats_roundtrip"]})"""


def oracle_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in BODIES.items()}
