"""DuckDB oracle SQL for every registered query.

Written independently of the Spark plans where that is possible (e.g. warps
as *gather* joins where Spark scatters, neighbours as self-joins where Spark
aggregates), over the fixture SQL of :mod:`tessera.sources.fixtures`.
Constants that Spark folds from Python enter here as the same doubles.
"""

from __future__ import annotations

import math

from .functions import crs as CRS, grid
from .sources.fixtures import with_fixtures as W

S = 32


def L(v: float) -> str:
    """A DOUBLE literal that parses to exactly ``v`` (never a DECIMAL)."""
    return format(float(v), ".17e")


def tx(lon, z):
    return (f"cast(least(greatest(floor(({lon} + 180) / 360 * pow(2.0, {z})), 0), pow(2.0, {z}) - 1) as bigint)")


def ty(lat, z):
    return (f"cast(least(greatest(floor((1 - ln(tan(radians({lat})) + 1 / cos(radians({lat}))) / {L(math.pi)}) / 2 * pow(2.0, {z})), 0),"
            f" pow(2.0, {z}) - 1) as bigint)")


def site_tiles(z):
    return f"select id, cast({z} as bigint) z, {tx('lon', z)} x, {ty('lat', z)} y from sites"


# ------------------------------------------------------------------ UTM in SQL (same series as crs.py)
def utm_inverse_cte(src: str, e: str, n: str, zone: int = 10) -> str:
    k = CRS.utm_constants(zone)
    xi, eta = f"{n} / {L(k['k0A'])}", f"({e} - {L(CRS.UTM_FALSE_EASTING)}) / {L(k['k0A'])}"
    s1 = f"select *, {xi} xi, {eta} eta from {src}"
    xp, ep = "xi", "eta"
    for j, b in enumerate(k["beta"], start=1):
        xp = f"({xp} - {L(b)} * sin({2 * j} * xi) * cosh({2 * j} * eta))"
        ep = f"({ep} - {L(b)} * cos({2 * j} * xi) * sinh({2 * j} * eta))"
    s2 = f"select *, {xp} xi_p, {ep} eta_p from ({s1})"
    s3 = f"select *, asin(sin(xi_p) / cosh(eta_p)) chi from ({s2})"
    lat = "chi"
    for j, d in enumerate(k["delta"], start=1):
        lat = f"({lat} + {L(d)} * sin({2 * j} * chi))"
    return (f"select * exclude (xi, eta, xi_p, eta_p, chi), {L(k['lon0'])} + degrees(atan2(sinh(eta_p), cos(xi_p))) lon_,"
            f" degrees({lat}) lat_ from ({s3})")


def utm_forward_cte(src: str, lon: str, lat: str, zone: int = 10) -> str:
    k = CRS.utm_constants(zone)
    n = k["n"]
    c = 2 * math.sqrt(n) / (1 + n)
    s1 = f"select *, radians({lat}) phi_, radians({lon} - {L(k['lon0'])}) dl_ from {src}"
    s2 = f"select *, sinh(atanh(sin(phi_)) - {L(c)} * atanh({L(c)} * sin(phi_))) t_ from ({s1})"
    s3 = f"select *, atan(t_ / cos(dl_)) xp_, atanh(sin(dl_) / sqrt(1 + t_ * t_)) ep_ from ({s2})"
    e, nn = "ep_", "xp_"
    for j, a in enumerate(k["alpha"], start=1):
        e = f"({e} + {L(a)} * cos({2 * j} * xp_) * sinh({2 * j} * ep_))"
        nn = f"({nn} + {L(a)} * sin({2 * j} * xp_) * cosh({2 * j} * ep_))"
    return (f"select * exclude (phi_, dl_, t_, xp_, ep_), {L(CRS.UTM_FALSE_EASTING)} + {L(k['k0A'])} * {e} e_,"
            f" {L(k['k0A'])} * {nn} n_ from ({s3})")


def merc(lon, lat):
    R = grid.EARTH_RADIUS
    return f"{L(R)} * radians({lon})", f"{L(R)} * ln(tan({L(math.pi / 4)} + radians({lat}) / 2))"


def footprints_sql() -> str:
    """rasters -> footprints with the 4326 box and the default 3857 resolution."""
    base = ("select source_id, a, e, width, height, nodata, c west, f + e * height south, c + a * width east, f north "
            "from rasters")
    corners = []
    for i, (cx, cy) in enumerate((("west", "south"), ("west", "north"), ("east", "south"), ("east", "north"))):
        corners.append(f"select source_id, {i} k, {cx} ce, {cy} cn from fp0")
    cs = " union all ".join(corners)
    ll = utm_inverse_cte(f"({cs})", "ce", "cn")
    mx, my = merc("lon_", "lat_")
    return f"""fp0 as ({base}),
corners as (select *, {mx} mx, {my} my from ({ll})),
agg as (select source_id, min(lon_) lw, min(lat_) ls, max(lon_) le, max(lat_) ln_,
               min(mx) mw, min(my) ms, max(mx) me, max(my) mn from corners group by source_id),
fp as (select fp0.*, lw, ls, le, ln_,
              sqrt((me - mw) * (me - mw) + (mn - ms) * (mn - ms)) / sqrt(cast(width as double) * width + cast(height as double) * height) res
       from fp0 join agg using (source_id))"""


def zoom_sql(res):
    return f"cast(round(log2({L(grid.WORLD)} / ({res} * 2048))) as bigint)"


# ------------------------------------------------------------------ terrain helpers
def diff(prev, v, nxt, h):
    return (f"case when {prev} is null and {nxt} is null then null when {prev} is null then ({nxt} - {v}) / {L(h)} "
            f"when {nxt} is null then ({v} - {prev}) / {L(h)} else ({nxt} - {prev}) / {L(2.0 * h)} end")


def gradient_sql(src: str, h: float, keys: tuple = (), dx: float | None = None) -> str:
    """Neighbours by self-joins (Spark scatters instead)."""
    on = "".join(f" and n.{k} = c.{k}" for k in keys)
    kc = "".join(f"c.{k}, " for k in keys)
    j = lambda dx, dy, name: (f" left join {src} {name} on {name}.gx = c.gx + ({dx}) and {name}.gy = c.gy + ({dy})"
                              + on.replace("n.", f"{name}."))
    return (f"select {kc}c.gx, c.gy, c.v, {diff('u.v', 'c.v', 'dn.v', h)} a, {diff('l.v', 'c.v', 'r.v', dx or h)} b "
            f"from {src} c" + j(0, -1, "u") + j(0, 1, "dn") + j(-1, 0, "l") + j(1, 0, "r"))


def naive_sql(a, b):
    az, alt = AZIMUTH * math.pi / 180.0, ALTITUDE * math.pi / 180.0
    slope = f"({L(math.pi / 2.0)} - atan(sqrt({a} * {a} + {b} * {b})))"
    aspect = f"atan2(-{a}, {b})"
    shaded = f"({L(math.sin(alt))} * sin({slope}) + {L(math.cos(alt))} * cos({slope}) * cos({L(az)} - {aspect}))"
    return f"cast(floor(255 * ({shaded} + 1) / 2) as bigint)"


def aspect_sql(a, b):
    az = math.radians(90.0 - AZIMUTH)
    t = f"atan2({b}, -{a})"
    return (f"(case when {a} = 0 and {b} > 0 then {L(math.pi / 2)} when {a} = 0 and {b} < 0 then {L(2 * math.pi - math.pi / 2)} "
            f"when {a} = 0 then {L(-1 * (math.pi / 4 - az))} when {t} < 0 then {t} + {L(2 * math.pi)} else {t} end)")


def zfactor_sql(a, b):
    az, zen = math.radians(90.0 - AZIMUTH), math.radians(90.0 - ALTITUDE)
    g = f"atan({L(Z_FACTOR)} * sqrt({a} * {a} + {b} * {b}))"
    v = f"({L(math.cos(zen))} * cos({g}) + {L(math.sin(zen))} * sin({g}) * cos({L(az)} - {aspect_sql(a, b)}))"
    return f"cast(floor(255.0 * greatest(0.0, {v})) as bigint)"


def light_sql(a, b):
    A, H = math.radians(90.0 - AZIMUTH), math.radians(ALTITUDE)
    d0, d1, d2 = math.cos(A) * math.cos(H), math.sin(A) * math.cos(H), math.sin(H)
    m = f"sqrt({b} * {b} + {a} * {a} + 1)"
    return f"((-{b} / {m}) * {L(d0)} + ({a} / {m}) * {L(d1)} + (1 / {m}) * {L(d2)})"


def stretch_q(i, lo, hi):
    s = f"(case when {hi} - {lo} > {L(1e-6)} then ({i} - {lo}) / ({hi} - {lo}) else {i} end)"
    return f"cast(floor(255.0 * least(greatest({s}, 0.0), 1.0)) as bigint)"


# the colour ramp, written out here so that a wrong stop in the library shows
RAMP = {"r": ((0.0, 60 / 255), (1.0, 220 / 255)), "g": ((0.0, 75 / 255), (1.0, 255 / 255)),
        "b": ((0.0, 80 / 255), (1.0, 100 / 255)), "a": ((0.0, 0.4), (162 / 255, 0.0), (1.0, 0.2))}
# light: azimuth 315, altitude 45, z factor 0.05
AZIMUTH, ALTITUDE, Z_FACTOR = 315.0, 45.0, 0.05


def ramp_sql(idx, stops, steps=256):
    xi = f"({idx} * {L(1.0 / (steps - 1))})"
    parts = []
    for (x0, y0), (x1, y1) in zip(stops[:-1], stops[1:]):
        parts.append(f"when {xi} <= {L(x1)} then ({xi} - {L(x0)}) / {L(x1 - x0)} * {L(y1 - y0)} + {L(y0)}")
    body = f"case when {idx} = 0 then {L(stops[0][1])} when {idx} = {steps - 1} then {L(stops[-1][1])} " \
           f"{' '.join(parts)} else {L(stops[-1][1])} end"
    return f"cast(floor(({body}) * 255.0) as bigint)"


def halo_windows(src: str, buffer: int = 2) -> str:
    """Every cell with each tile whose buffered window holds it (range join)."""
    return (f"select t.tx, t.ty, c.gx, c.gy, c.v from {src} c join "
            f"(select distinct cast(floor(gx / {S}) as bigint) tx, cast(floor(gy / {S}) as bigint) ty from {src}) t "
            f"on c.gx >= t.tx * {S} - {buffer} and c.gx < t.tx * {S} + {S + buffer} "
            f"and c.gy >= t.ty * {S} - {buffer} and c.gy < t.ty * {S} + {S + buffer}")


# ------------------------------------------------------------------ the oracles
def _oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["tile_of_point"] = W(" union all ".join(
        f"select id, cast({z} as bigint) z, {tx('lon', z)} x, {ty('lat', z)} y from sites" for z in (0, 6, 14)), "sites")
    mx, my = merc("lon", "lat")
    q["mercator_xy"] = W(f"select id, round({mx}, 4) mx, round({my}, 4) my from sites", "sites")
    q["tile_ul"] = W(f"""select id, z, x, y, round(x / pow(2.0, z) * 360 - 180, 9) lon,
        round(degrees(atan(sinh({L(math.pi)} * (1 - 2 * y / pow(2.0, z))))), 9) lat from ({site_tiles(14)})""", "sites")
    sp = f"({L(grid.WORLD)} / pow(2.0, z))"
    hw = L(grid.HALF_WORLD)
    q["tile_bounds"] = W(f"""select id, round(x * {sp} - {hw}, 4) ulx, round({hw} - y * {sp}, 4) uly,
        round((x + 1) * {sp} - {hw}, 4) lrx, round({hw} - (y + 1) * {sp}, 4) lry,
        round({sp} / 2048, 6) a, round(-{sp} / 2048, 6) e from ({site_tiles(14)})""", "sites")
    qk = ("case when z > 1 then array_to_string(list_transform(range(z - 1, -1, -1), "
          "lambda i: cast(((x >> i) & 1) + 2 * ((y >> i) & 1) as varchar)), '') else '' end")
    q["tile_quadkey"] = W(" union all ".join(f"select id, z, {qk} qk from ({site_tiles(z)})" for z in (1, 6, 14)), "sites")
    d14 = f"(select distinct z, x, y from ({site_tiles(14)}))"
    q["tile_parents"] = W(f"""select z, x, y, z - 1 pz, x >> 1 px, y >> 1 py,
        case when x % 2 = 0 and y % 2 = 0 then 'ul' when x % 2 = 0 then 'll' when y % 2 = 0 then 'ur' else 'lr' end corner,
        (x % 2) * 1024 dx, (y % 2) * 1024 dy from {d14}""", "sites")
    q["tile_parent_set"] = W(f"select z - 1 z, x >> 1 x, y >> 1 y, count(*) n_children from {d14} group by all", "sites")
    d10 = f"(select distinct z, x, y from ({site_tiles(10)}))"
    q["tile_children"] = W(f"""select z, x, y, z + 1 cz, 2 * x + o.dx cx, 2 * y + o.dy cy from {d10}
        cross join (values (0, 0), (0, 1), (1, 0), (1, 1)) o(dx, dy)""", "sites")
    q["tiles_for_boxes"] = W(f"""select 6::bigint z, x, y, count(*) n_boxes from (
        select id, x, unnest(range(y0, y1 + 1)) y from (
          select id, unnest(range(x0, x1 + 1)) x, y0, y1 from (
            select id, {tx('west', 6)} x0, {tx('east', 6)} x1, {ty('north', 6)} y0, {ty('south', 6)} y1 from boxes)))
        group by all""", "boxes")
    q["tile_list_json"] = W(f"""select z, x, y, 's3://b/3857/' || z || '/' || x || '/' || y || '.tif' path
        from (select distinct z, x, y from ({site_tiles(14)}))""", "sites")
    q["geojson_features"] = W("select id, west, south, east, north from boxes", "boxes")
    q["utm_to_lonlat"] = W(f"select id, round(lon_, 8) lon, round(lat_, 8) lat from ({utm_inverse_cte('utm_points', 'easting', 'northing')})",
                           "utm_points")
    fw = utm_forward_cte(f"({utm_inverse_cte('utm_points', 'easting', 'northing')})", "lon_", "lat_")
    q["lonlat_to_utm"] = W(f"select id, round(e_, 3) easting, round(n_, 3) northing from ({fw})", "utm_points")
    fps = footprints_sql()
    q["suggest_zoom"] = W(f"select source_id, round(res, 6) res, {zoom_sql('res')} zoom from fp", "rasters").replace(
        "\nselect source_id, round", f",\n{fps}\nselect source_id, round", 1)
    q["footprint_index"] = W(f"""select source_id, west, south, east, north, round(lw, 8) lon_lat_west,
        round(ls, 8) lon_lat_south, round(le, 8) lon_lat_east, round(ln_, 8) lon_lat_north from fp""", "rasters").replace(
        "\nselect source_id, west", f",\n{fps}\nselect source_id, west", 1)
    q["mosaic_grid"] = W("""select min(abs(a)) res, max(nodata) nodata, count(*) n_sources, min(west) west,
        min(south) south, max(east) east, max(north) north from fp""", "rasters").replace(
        "\nselect min(abs(a))", f",\n{fps}\nselect min(abs(a))", 1)
    q["plan_tiles"] = W(f"""select z, x, y, count(*) n_sources from (
        select source_id, z, x, unnest(range(y0, y1 + 1)) y from (
          select source_id, z, unnest(range(x0, x1 + 1)) x, y0, y1 from (
            select source_id, zm z, {tx('lw', 'zm')} x0, {tx('le', 'zm')} x1, {ty('ln_', 'zm')} y0, {ty('ls', 'zm')} y1
            from fp, (select max({zoom_sql('res')}) zm from fp))))
        group by all""", "rasters").replace("\nselect z, x, y, count(*) n_sources", f",\n{fps}\nselect z, x, y, count(*) n_sources", 1)
    sp14 = f"({L(grid.WORLD)} / pow(2.0, t.z))"
    q["source_overlap"] = W(f"""select t.z, t.x, t.y, fp.source_id from tl t
        join fpm fp on t.x * {sp14} - {hw} < fp.me and fp.mw < (t.x + 1) * {sp14} - {hw}
          and {hw} - (t.y + 1) * {sp14} < fp.mn and fp.ms < {hw} - t.y * {sp14}""", "rasters").replace(
        "\nselect t.z, t.x, t.y, fp.source_id", f""",\n{fps},
 fpm as (select source_id, mw, ms, me, mn from agg),
 tl as (select distinct z, x, unnest(range(y0, y1 + 1)) y from (
          select zm z, unnest(range(x0, x1 + 1)) x, y0, y1 from (
            select zm, {tx('lw', 'zm')} x0, {tx('le', 'zm')} x1, {ty('ln_', 'zm')} y0, {ty('ls', 'zm')} y1
            from fp, (select max({zoom_sql('res')}) zm from fp))))
select t.z, t.x, t.y, fp.source_id""", 1)
    src_a = grid.WORLD / (2 ** 14 * 512)
    q["source_window"] = W(f"""select id, cast(row0 as bigint) row0, cast(row0 + span as bigint) row1,
        cast(col0 as bigint) col0, cast(col0 + span as bigint) col1,
        cast(row0 - 2 * scale as bigint) brow0, cast(row0 + span + 2 * scale as bigint) brow1,
        cast(col0 - 2 * scale as bigint) bcol0, cast(col0 + span + 2 * scale as bigint) bcol1, scale,
        round({L(-grid.HALF_WORLD)} + col0 * {L(src_a)}, 4) wc, round({L(grid.HALF_WORLD)} + row0 * {L(-src_a)}, 4) wf,
        round(abs({L(src_a)}) * scale, 6) dx, round(abs({L(-src_a)}) * scale, 6) dy from (
          select id, 512 * (y * k) row0, 512 * (x * k) col0, floor(512 * k) span, k * {L(512 / 256)} scale from (
            select *, pow(2.0, 14 - z) k from ({site_tiles(15)})))""", "sites")
    q["uri_names"] = W(r"""select path, regexp_extract(path, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) scheme,
        regexp_extract(path, '^[A-Za-z][A-Za-z0-9+.-]*://([^/]*)', 1) bucket,
        regexp_extract(path, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/(.*)$', 1) "key",
        regexp_extract(path, '([^/]*)$', 1) base,
        replace(replace(path, 'source', '4326'), '.zip', '.tif') target,
        replace(regexp_extract(path, '([^/]*)$', 1), 'zip', 'tif') member,
        replace(path, 's3://', 'http://s3.amazonaws.com/') http from objects""", "objects")
    q["missing_targets"] = W(r"""select path source, replace(replace(path, 'source', '4326'), '.zip', '.tif') target
        from objects o where contains(path, 'zip') and not exists (
          select 1 from done d where regexp_matches(d.path, '\.tif$')
            and d.path = replace(replace(o.path, 'source', '4326'), '.zip', '.tif'))""", "objects", "done")
    q["listing_union"] = W("select path, 'source' listing from objects union all select path, '4326' listing from done",
                           "objects", "done")
    q["conversion_log"] = W(r"""select source, case when n_cells > 0 then replace(replace(source, 'source', '4326'), '.zip', '.tif') end output,
        n_cells > 0 ok, n_cells from (
          select o.path source, coalesce(n, 0) n_cells from objects o
          left join (select l_orderkey k, count(*) n from lineitem group by 1) li
            on li.k = cast(regexp_extract(regexp_extract(o.path, '([^/]*)$', 1), '^(\d+)', 1) as bigint)
          where contains(o.path, 'zip'))""", "objects")
    q["reproject_worklist"] = W("""select 's3://b/4326/scene-' || priority || '.tif' target, cast(floor(gx / 2) as bigint) gx,
        cast(floor(gy / 2) as bigint) gy, cast(sum(v) as bigint) vsum, count(v) vcount, cast(sum(v) as double) / count(v) v
        from scenes where v is not null group by all""", "scenes")
    q["dem_blocks_valid"] = W(f"""select 6::bigint z, cast(floor(gx / {S}) as bigint) x, cast(floor(gy / {S}) as bigint) y,
        count(v) valid_count, {S * S * 8}::bigint nbytes from dem group by all having count(v) > 0""", "dem")
    st = ("count(v) n, min(cast(v as double)) vmin, max(cast(v as double)) vmax, round(avg(cast(v as double)), 4) vmean, "
          "round(stddev_pop(cast(v as double)), 2) vstd")
    q["dem_stats"] = W(f"""select cast(floor(gx / {S}) as bigint) x, cast(floor(gy / {S}) as bigint) y, {st}
        from dem where v is not null group by all
        union all select null::bigint, null::bigint, {st} from dem where v is not null""", "dem")
    q["reblock"] = W("select gx, gy, v from dem where v is not null", "dem")
    q["overview_sizes"] = W("""select k level, cast(ceil(w / pow(2.0, k)) as bigint) width, cast(ceil(h / pow(2.0, k)) as bigint) height
        from (select w, h, unnest(range(0, cast(ceil(log2(greatest(w, h))) as bigint) + 1)) k
              from (select max(gx) + 1 w, max(gy) + 1 h from dem))""", "dem")
    q["decimate"] = W("""select cast(floor(gx / 2) as bigint) gx, cast(floor(gy / 2) as bigint) gy, v from dem
        where v is not null and gx % 2 = 1 and gy % 2 = 1""", "dem")
    q["pyramid_levels"] = W(" union all ".join(
        f"select {6 - k}::bigint z, (gx + 1) // {2 ** k} - 1 gx, (gy + 1) // {2 ** k} - 1 gy, v from dem "
        f"where v is not null and (gx + 1) % {2 ** k} = 0 and (gy + 1) % {2 ** k} = 0" for k in range(7)), "dem")
    q["pyramid_average"] = W(" union all ".join(
        f"select {6 - k}::bigint z, gx // {2 ** k} gx, gy // {2 ** k} gy, cast(sum(v) as bigint) vsum, count(v) vcount, "
        f"cast(sum(v) as double) / count(v) v from dem where v is not null group by all" for k in range(7)), "dem")
    q["pyramid_average_i2"] = W(" union all ".join(
        f"select {6 - k}::bigint z, gx // {2 ** k} gx, gy // {2 ** k} gy, cast(sum(v % 30000) as bigint) vsum, count(v) vcount "
        f"from dem where v is not null group by all" for k in range(7)), "dem")
    means = " union all ".join(
        f"select {6 - k}::bigint z, gx // {2 ** k} gx, gy // {2 ** k} gy, cast(sum(v) as double) / count(v) v "
        f"from dem where v is not null group by all" for k in range(7))
    q["stats_of_average"] = W(f"""select z, gx // {S} x, gy // {S} y, count(*) n, min(v) vmin, max(v) vmax
        from ({means}) group by all""", "dem")
    q["tms_of_average"] = W(f"""select r.z, r.x, r.y, s.x is not null stored, coalesce(s.vmax, 0) vmax from (
          select distinct z, x + unnest([0, 1]) x, y from (select distinct z, gx // {S} x, gy // {S} y from ({means}) where z = 5)) r
        left join (select gx // {S} x, gy // {S} y, max(v) vmax from ({means}) where z = 5 group by all) s
          on s.x = r.x and s.y = r.y""", "dem")
    # a pixel counts unless it equals the nodata value of its own tile
    mixed = f"(select gx, gy, v % 50 - 10 v, (gx // {S} + gy // {S}) % 2 odd from dem where v is not null)"
    q["pyramid_mixed_nodata"] = W(" union all ".join(
        f"select {6 - k}::bigint z, (gx + 1) // {2 ** k} - 1 gx, (gy + 1) // {2 ** k} - 1 gy, v from {mixed} "
        f"where v <> case odd when 0 then -1 else -9 end and (gx + 1) % {2 ** k} = 0 and (gy + 1) % {2 ** k} = 0"
        for k in range(7)), "dem")
    lv = " union all ".join(
        f"select distinct {6 - k}::bigint z, ((gx + 1) // {2 ** k} - 1) // {S} x, ((gy + 1) // {2 ** k} - 1) // {S} y from dem "
        f"where v is not null and (gx + 1) % {2 ** k} = 0 and (gy + 1) % {2 ** k} = 0" for k in range(7))
    q["pyramid_manifest"] = W(f"select z, count(*) n_tiles, count(*) * {S * S * 8} nbytes from ({lv}) group by rollup (z)", "dem")
    q["tms_view"] = W(f"""select r.z, r.x, r.y, s.x is not null stored, cast(coalesce(s.vsum, 0) as bigint) vsum from (
          select distinct z, x + o.dx x, y + o.dy y from (
            select 6::bigint z, gx // {S} x, gy // {S} y from dem group by all having count(v) > 0)
          cross join (values (-1,-1),(-1,0),(-1,1),(0,-1),(0,0),(0,1),(1,-1),(1,0),(1,1)) o(dx, dy)
          where x + o.dx >= 0 and y + o.dy >= 0 and x + o.dx < 64 and y + o.dy < 64) r
        left join (select gx // {S} x, gy // {S} y, cast(sum(v) as bigint) vsum from dem group by all having count(v) > 0) s
          on s.x = r.x and s.y = r.y""", "dem")
    q["window_read"] = W(f"""select w.wz, w.wx, w.wy, (d.gy - w.row0) // 2 orow, (d.gx - w.col0) // 2 ocol, d.v from (
          select 5::bigint wz, wx, wy, 64 * wy - 4 row0, 64 * wy + 68 row1, 64 * wx - 4 col0, 64 * wx + 68 col1 from (
            select distinct (gx // {S}) >> 1 wx, (gy // {S}) >> 1 wy from dem where v is not null)) w
        join dem d on d.gy >= w.row0 and d.gy < w.row1 and d.gx >= w.col0 and d.gx < w.col1
        where d.v is not null and (d.gy - w.row0) % 2 = 1 and (d.gx - w.col0) % 2 = 1""", "dem")
    paint = ("select {k}gx, gy, v from (select *, row_number() over (partition by {k}gx, gy "
             "order by priority desc, tie desc, v desc) rn from {t} where v is not null) where rn = 1")
    q["mosaic_paint"] = W(paint.format(k="", t="scenes"), "scenes")
    q["chunk_average"] = W(f"""select cast(floor(gx / 2) as bigint) gx, cast(floor(gy / 2) as bigint) gy, cast(sum(v) as bigint) vsum,
        count(v) vcount, cast(sum(v) as double) / count(v) v from ({paint.format(k='', t='scenes')}) group by all""", "scenes")
    q["chunk_tiles"] = W(f"""select 9::bigint z, gx // {S} x, gy // {S} y, count(*) valid_count, round(sum(v), 4) vsum from (
          select cast(floor(gx / 2) as bigint) gx, cast(floor(gy / 2) as bigint) gy, cast(sum(v) as double) / count(v) v
          from ({paint.format(k='', t='scenes')}) group by all) group by all""", "scenes")
    q["warp_bands"] = W(f"""select cast(band as bigint) band, cast(floor(gx / 2) as bigint) gx, cast(floor(gy / 2) as bigint) gy,
        cast(sum(v) as bigint) vsum, count(v) vcount, cast(sum(v) as double) / count(v) v
        from ({paint.format(k='band, ', t='scenes_bands')}) group by all""", "scenes_bands")
    q["chunk_bands"] = W(f"""select cast(band as bigint) band, gx, gy, round(v, 6) v from (
          select band, cast(floor(gx / 2) as bigint) gx, cast(floor(gy / 2) as bigint) gy, cast(sum(v) as double) / count(v) v
          from ({paint.format(k='band, ', t='scenes_bands')}) group by all)
        where (gx // {S} + gy // {S}) % 2 = 1""", "scenes_bands")
    q["mosaic_bands"] = W(f"""select cast(band as bigint) band, gx, gy, v
        from ({paint.format(k='band, ', t='scenes_bands')})""", "scenes_bands")
    q["warp_nearest"] = W(f"""select t.tx gx, t.ty gy, d.v from (
          select tx, unnest(range(0, h)) ty from (
            select unnest(range(0, w)) tx, h from (
              select cast(ceil((max(gx) + 1) / {L(1.5)}) as bigint) + 2 w, cast(ceil((max(gy) + 1) / {L(1.5)}) as bigint) + 2 h from dem))) t
        join dem d on d.gx = cast(floor((t.tx + 0.5) * {L(1.5)}) as bigint) and d.gy = cast(floor((t.ty + 0.5) * {L(1.5)}) as bigint)
        where d.v is not null""", "dem")
    r = 0.75
    sx = f"((tx + {L(0.5)}) * {L(r)} - {L(0.5)})"
    sy = f"((ty + {L(0.5)}) * {L(r)} - {L(0.5)})"
    q["warp_bilinear"] = W(f"""select tx gx, ty gy, sum(w * v) / sum(w) v from (
          select t.tx, t.ty, d.v,
                 (case when ox = 0 then 1 - ({sx} - floor({sx})) else {sx} - floor({sx}) end)
               * (case when oy = 0 then 1 - ({sy} - floor({sy})) else {sy} - floor({sy}) end) w
          from (select tx, unnest(range(0, h)) ty from (
                  select unnest(range(0, w)) tx, h from (
                    select cast(ceil((max(gx) + 2) / {L(r)}) as bigint) + 2 w, cast(ceil((max(gy) + 2) / {L(r)}) as bigint) + 2 h from dem))) t
          cross join (values (0, 0), (0, 1), (1, 0), (1, 1)) o(ox, oy)
          join dem d on d.gx = cast(floor({sx}) as bigint) + ox and d.gy = cast(floor({sy}) as bigint) + oy
          where d.v is not null)
        where w > 0 group by all""", "dem")
    q["warp_bilinear_blocks"] = q["warp_bilinear"]
    q["warp_nearest_blocks"] = q["warp_nearest"]
    q["pyramid_levels_cells"] = q["pyramid_levels"]
    q["pyramid_average_cells"] = q["pyramid_average"]
    # gather form of the 3857 -> 4326 reprojection: every target pixel, its inverse-projected
    # source coordinate, the four (or one) source pixels it reads
    px = L(grid.WORLD / 2048)
    X, Y = merc(f"({L(-180.0)} + (ti + 5e-1) * {L(0.125)})", f"({L(85.0625)} - (tj + 5e-1) * {L(0.0625)})")
    tgt = f"""(select ti, tj, ({X} - {L(-grid.HALF_WORLD)}) / {px} - 5e-1 sx, ({L(grid.HALF_WORLD)} - {Y}) / {px} - 5e-1 sy
          from (select ti, unnest(range(0, h)) tj from (
                  select unnest(range(0, w)) ti, h from (
                    select cast(ceil((max(gx) + 3) * {L(360.0 / 2048)} / {L(0.125)}) as bigint) + 3 w,
                           cast(ceil(({L(85.0625)} - degrees(atan(sinh({L(math.pi)} * (1 - 2 * (max(gy) + 3) / 2048.0))))) / {L(0.0625)}) as bigint) + 3 h
                    from dem))))"""
    q["warp_4326"] = W(f"""select ti gx, tj gy, cast(round(sum(w * v) / sum(w)) as bigint) v from (
          select t.ti, t.tj, d.v,
                 (case when ox = 0 then 1 - (sx - floor(sx)) else sx - floor(sx) end)
               * (case when oy = 0 then 1 - (sy - floor(sy)) else sy - floor(sy) end) w
          from {tgt} t cross join (values (0, 0), (0, 1), (1, 0), (1, 1)) o(ox, oy)
          join dem d on d.gx = cast(floor(sx) as bigint) + ox and d.gy = cast(floor(sy) as bigint) + oy
          where d.v is not null)
        where w > 0 group by all""", "dem")
    q["warp_4326_nearest"] = W(f"""select ti gx, tj gy, d.v from {tgt} t
        join dem d on d.gx = cast(floor(sx + 5e-1) as bigint) and d.gy = cast(floor(sy + 5e-1) as bigint)
        where d.v is not null""", "dem")
    q["warp_4326_blocks"] = q["warp_4326"]
    lat = f"degrees(atan(sinh({L(math.pi)} * (1 - 2 * (gy + 5e-1) / 2048.0))))"
    q["reproject_average_4326"] = W(f"""select 's3://b/4326/dem-' || (gx // {S}) || '.tif' target,
        cast(floor(((gx + 5e-1) * {L(360.0 / 2048)}) / 5e-1) as bigint) gx, cast(floor(({L(85.25)} - {lat}) / 2.5e-1) as bigint) gy,
        round(avg(cast(v as double)), 4) v from dem where v is not null
        group by gx // {S}, 2, 3""", "dem")
    q["reproject_average_blocks"] = q["reproject_average_4326"]
    # pixel centres that fall in the target pixel, else the source pixel under the target's centre
    tp = L(grid.WORLD / 1024)
    per = []
    for sid, x0, y0, dx, dy, lift in ((1, -179.97, 85.0, 0.125, 0.0625, 0), (2, -174.97, 80.0, 0.25, 0.125, 1000000)):
        mx, my = merc(f"({L(x0)} + (gx + 5e-1) * {L(dx)})", f"({L(y0)} - (gy + 5e-1) * {L(dy)})")
        per.append(f"""select {sid} sid, cast(floor(({mx} + {hw}) / {tp}) as bigint) ti, cast(floor(({hw} - {my}) / {tp}) as bigint) tj,
            avg(cast(v + {lift} as double)) direct, null::double near from dem where v is not null and {L(y0)} - (gy + 5e-1) * {L(dy)} > -85
            group by 2, 3""")
        per.append(f"""select {sid}, t.ti, t.tj, null, cast(d.v + {lift} as double) from tg t join dem d
            on d.gx = cast(floor((t.lon - {L(x0)}) / {L(dx)}) as bigint) and d.gy = cast(floor(({L(y0)} - t.lat) / {L(dy)}) as bigint)
            where d.v is not null""")
    q["chunk_reproject"] = W(f"""select ti gx, tj gy, round(v, 4) v from (
          select ti, tj, v, row_number() over (partition by ti, tj order by sid desc) rn from (
            select sid, ti, tj, coalesce(max(direct), max(near)) v from ({' union all '.join(per)}) group by all))
        where rn = 1 and ti >= 0 and tj >= 0 and ti < 1024 and tj < 1024 and (ti // {S}) % 3 <> 2""", "dem").replace(
        "\nselect ti gx, tj gy, round", f""",
 tg as (select ti, tj, -180 + (ti + 5e-1) * {L(360.0 / 1024)} lon, degrees(atan(sinh({L(math.pi)} * (1 - 2 * (tj + 5e-1) / 1024.0)))) lat
        from (select ti, unnest(range(0, 1024)) tj from (select unnest(range(0, 160)) ti)))
select ti gx, tj gy, round""", 1)
    # the upper source on the grid of the finer one (the same origin as the mosaic), painted over it, then averaged
    mx, my = merc(f"({L(-179.97)} + (gx + 5e-1) * {L(0.125)})", f"({L(85.0)} - (gy + 5e-1) * {L(0.0625)})")
    q["chunk_mosaic"] = W(f"""select ti gx, tj gy, round(coalesce(max(direct), max(near)), 4) v from (
          select cast(floor(({mx} + {hw}) / {tp}) as bigint) ti, cast(floor(({hw} - {my}) / {tp}) as bigint) tj,
                 avg(cast(v as double)) direct, null::double near from mosaic where {L(85.0)} - (gy + 5e-1) * {L(0.0625)} > -85 group by 1, 2
          union all select t.ti, t.tj, null, cast(m.v as double) from tg t join mosaic m
            on m.gx = cast(floor((t.lon + {L(179.97)}) / {L(0.125)}) as bigint) and m.gy = cast(floor(({L(85.0)} - t.lat) / {L(0.0625)}) as bigint))
        where ti >= 0 and tj >= 0 and ti < 1024 and tj < 1024 and (ti // {S}) % 3 <> 2 group by all""", "dem").replace(
        "\nselect ti gx, tj gy, round", f""",
 tg as (select ti, tj, -180 + (ti + 5e-1) * {L(360.0 / 1024)} lon, degrees(atan(sinh({L(math.pi)} * (1 - 2 * (tj + 5e-1) / 1024.0)))) lat
        from (select ti, unnest(range(0, 1024)) tj from (select unnest(range(0, 160)) ti))),
 upper as (select 2 * gx + 40 + ox gx, 2 * gy + 80 + oy gy, v + 1000000 v from dem
        cross join (values (0, 0), (0, 1), (1, 0), (1, 1)) o(ox, oy) where v is not null),
 mosaic as (select gx, gy, coalesce(u.v, l.v) v from (select gx, gy, v from dem where v is not null) l full join upper u using (gx, gy))
select ti gx, tj gy, round""", 1)
    # every target pixel of a source's default 4326 grid, taken back to UTM
    tgt_utm = utm_forward_cte("tgp", "lon_t", "lat_t")
    q["convert_missing"] = W(f"""select 'pixel' kind, 's3://b/4326/' || sid || '.tif' "name", cast(p.band as bigint) band,
          t.ti gx, t.tj gy, p.v from utm t join px p using (sid)
          where p.gx = cast(floor((t.e_ - t.c) / t.a) as bigint) and p.gy = cast(floor((t.f - t.n_) / t.a) as bigint)
        union all select 'first', 's3://b/source/' || source_id || '.zip', null, null, null,
          cast(source_id in (select sid from px) as bigint) from fp where source_id <> 2
        union all select 'second', 's3://b/source/' || source_id || '.zip', null, null, null, 0
          from fp where source_id not in (select sid from px)""", "rasters").replace(
        "\nselect 'pixel' kind", f""",\n{fps},
 px0 as (select 1 + o_orderkey % 9 sid, (o_orderkey // 9) % 16 gx, o_orderkey // 144 gy, cast(round(o_totalprice * 100) as bigint) v1,
                cast(o_custkey as bigint) v2 from orders),
 px as (select sid, gx, gy, 1 band, v1 v from px0 union all select sid, gx, gy, 2, v2 from px0),
 gr as (select source_id sid, a, west c, north f, lw, ln_,
               sqrt((le - lw) * (le - lw) + (ln_ - ls) * (ln_ - ls)) / sqrt(cast(width as double) * width + cast(height as double) * height) r
        from fp where source_id <> 2 and source_id in (select sid from px)),
 tgp as (select *, lw + (ti + 5e-1) * r lon_t, ln_ - (tj + 5e-1) * r lat_t
         from (select *, unnest(range(0, h)) tj from (select gr.*, unnest(range(0, 40)) ti, (select max(gy) + 20 from px) h from gr))),
 utm as ({tgt_utm})
select 'pixel' kind""", 1)
    q["convert_missing_blocks"] = q["convert_missing"][:q["convert_missing"].index("select 'pixel' kind")] + """
select 'pixel' kind, 's3://b/4326/' || sid || '.tif' "name", cast(band as bigint) band, ti gx, tj gy, cast(round(sum(w * v) / sum(w) / 10000) as bigint) v
from (select sid, ti, tj, p.band, p.v,
             (case when ox = 0 then 1 - (sx - floor(sx)) else sx - floor(sx) end)
           * (case when oy = 0 then 1 - (sy - floor(sy)) else sy - floor(sy) end) w
      from (select *, (e_ - c) / a - 5e-1 sx, (f - n_) / a - 5e-1 sy from utm) t
      cross join (values (0, 0), (0, 1), (1, 0), (1, 1)) o(ox, oy)
      join px p using (sid) where p.gx = cast(floor(sx) as bigint) + ox and p.gy = cast(floor(sy) as bigint) + oy)
where w > 0 group by all
union all select 'log', 's3://b/source/' || source_id || '.zip', null, null, null, cast(source_id in (select sid from px) as bigint)
from fp where source_id <> 2"""
    q["block_failures"] = W(f"""select x, y, case when x in (1, 2) then null else s end vsum,
          case x when 1 then '100 of {S * S * 8} bytes' when 2 then 'unknown dtype q9' end error
        from (select gx // {S} x, gy // {S} y, cast(2 * sum(v) as bigint) s, count(v) n from dem group by 1, 2)
        where x in (1, 2) or n > 0""", "dem")
    q["source_blocks_read"] = W(f"""select 1::bigint source_id, x, y, n valid_count, s vsum from (
          select gx // {S} x, gy // {S} y, count(v) n, cast(sum(v) as bigint) s from dem group by 1, 2 having count(v) > 0)
        where {L(-179.97)} + x * {L(S * 0.125)} < -172 and {L(-179.97)} + (x + 1) * {L(S * 0.125)} > -176
          and {L(85.0)} - (y + 1) * {L(S * 0.0625)} < 84.5 and {L(85.0)} - y * {L(S * 0.0625)} > 80""", "dem")
    q["block_map"] = W(f"""select gx // {S} x, gy // {S} y, count(v) n, cast(sum(floor(v / 1e2)) as bigint) vsum
        from dem where v is not null group by 1, 2""", "dem")
    odd = "(id % 2 = 1)"
    q["tiles_antimeridian"] = W(f"""select distinct id, 7::bigint z, x, unnest(range(y0, y1 + 1)) y from (
          select id, unnest(range(x0, x1 + 1)) x, y0, y1 from (
            select id, {tx('w', 7)} x0, {tx('e', 7)} x1, {ty('north', 7)} y0, {ty('south', 7)} y1 from (
              select id, west w, east e, south, north from boxes where not {odd}
              union all select id, cast(177 + id % 3 as double), 180.0, south, north from boxes where {odd}
              union all select id, -180.0, cast(-179 + id % 4 as double), south, north from boxes where {odd})))""", "boxes")
    q["listing_storage"] = W("""select distinct 's3://b/source/scene ' || priority || '+.zip' source, 's3://b/4326/scene ' || priority || '+.tif' target
        from scenes where priority % 2 = 0""", "scenes")
    q["mosaic_blocks"] = q["mosaic_paint"]
    q["chunk_average_blocks"] = q["chunk_average"]
    g2 = gradient_sql("dem_dense", 2.0)
    q["gradient"] = W(f"select gx, gy, a, b from ({g2})", "dem_dense")
    q["hillshade_naive"] = W(f"select gx, gy, {naive_sql('a', 'b')} shade from ({g2})", "dem_dense")
    q["hillshade_zfactor"] = W(f"select gx, gy, round({aspect_sql('a', 'b')}, 9) aspect, {zfactor_sql('a', 'b')} shade from ({g2})",
                               "dem_dense")
    trig = {
        "cos_aspect": "case when a = 0 and b = 0 then -1.0 when a = 0 then 0.0 when b = 0 and a < 0 then 1.0 "
                      "when b = 0 then -1.0 else -a / sqrt(b * b + a * a) end",
        "sin_aspect": "case when b = 0 then 0.0 when a = 0 and b < 0 then -1.0 when a = 0 then 1.0 "
                      "else b / sqrt(b * b + a * a) end",
        "sin_slope": "sqrt(a * a + b * b) / sqrt(a * a + b * b + 1)",
        "cos_slope": "1 / sqrt(a * a + b * b + 1)",
    }
    q["slope_aspect_trig"] = W("select gx, gy, " + ", ".join(f"round(cast({e} as double), 9) {k}" for k, e in trig.items())
                               + f" from ({g2})", "dem_dense")
    win = f"win as ({halo_windows('dem_dense')}),\n gw as ({gradient_sql('win', 1.0, ('tx', 'ty'))}),\n" \
          f" li as (select *, {light_sql('a', 'b')} i from gw),\n" \
          f" ls as (select *, {stretch_q('i', 'min(i) over (partition by tx, ty)', 'max(i) over (partition by tx, ty)')} shade from li)"
    crop = f"gx // {S} = tx and gy // {S} = ty"
    q["hillshade_light"] = W(f"select tx, ty, gx, gy, shade from ls where {crop}", "dem_dense").replace(
        "\nselect tx, ty, gx, gy, shade", f",\n{win}\nselect tx, ty, gx, gy, shade", 1)
    rgba = ", ".join(f"{ramp_sql('idx', RAMP[ch])} {ch}" for ch in ("r", "g", "b", "a"))
    q["shade_rgba"] = W(f"""select tx, ty, gx, gy, shade, {rgba} from (
          select *, cast(least(floor((case when hmax > hmin then (shade - hmin) / (hmax - hmin) else 0.0 end) * 256), 255) as bigint) idx
          from (select *, min(shade) over (partition by tx, ty) hmin, max(shade) over (partition by tx, ty) hmax from ls))
        where {crop}""", "dem_dense").replace("\nselect tx, ty, gx, gy, shade, ", f",\n{win}\nselect tx, ty, gx, gy, shade, ", 1)
    q["compare_shades"] = W(f"""select gx, gy, naive, zfactor, {stretch_q('i', 'imin', 'imax')} light from (
          select *, min(i) over () imin, max(i) over () imax from (
            select gx, gy, {naive_sql('a', 'b')} naive, {zfactor_sql('a', 'b')} zfactor, {light_sql('(a * 2)', '(b * 2)')} i
            from ({g2})))""", "dem_dense")
    q["compare_shades_blocks"] = q["compare_shades"]
    q["shade_halo"] = W(f"select gx, gy, {zfactor_sql('a', 'b')} shade from ({g2})", "dem_dense")
    q["shade_spacing"] = W(f"select gx, gy, {zfactor_sql('a', 'b')} shade from ({gradient_sql('dem_dense', 2.0, dx=1.5)})", "dem_dense")
    half = gradient_sql("half", 4.0, dx=3.0)
    q["shade_window"] = W(f"""select 6::bigint z, gx, gy, {zfactor_sql('a', 'b')} shade from ({gradient_sql('dem_dense', 2.0, dx=1.5)})
        union all select 5, gx, gy, {zfactor_sql('a', 'b')} from ({half})""", "dem_dense").replace(
        "\nselect 6::bigint", ",\n half as (select gx // 2 gx, gy // 2 gy, v from dem_dense where gx % 2 = 1 and gy % 2 = 1)\nselect 6::bigint", 1)
    q["tiles_upsert"] = W(f"select gx, gy, v + case (gx // {S}) % 2 when 1 then 100 else 0 end v from dem where v is not null", "dem")
    # a base tile feeds the levels above if its parent is the parent of a listed tile that holds data
    listed = f"""select distinct tx >> 1 px, ty >> 1 py from (select distinct gx // {S} tx, gy // {S} ty from dem where v is not null)
        where ((tx // 2) + (ty // 2)) % 2 = 0 and (tx + ty) % 2 = 0"""
    q["pyramid_list"] = W("select 6::bigint z, gx, gy, v from dem where v is not null union all " + " union all ".join(
        f"select {6 - k}, (gx + 1) // {2 ** k} - 1, (gy + 1) // {2 ** k} - 1, v from fed "
        f"where (gx + 1) % {2 ** k} = 0 and (gy + 1) % {2 ** k} = 0" for k in range(1, 7)), "dem").replace(
        "\nselect 6::bigint", f""",
 fed as (select d.gx, d.gy, d.v from dem d join ({listed}) on px = (d.gx // {S}) >> 1 and py = (d.gy // {S}) >> 1 where d.v is not null)
select 6::bigint""", 1)
    q["shade_rgba_blocks"] = f"""select gx, gy, cast(unnest([1, 2, 3, 4]) as bigint) band, unnest([r, g, b, a]) v
        from ({q["shade_rgba"]})"""
    q["hillshade_light_blocks"] = q["hillshade_light"]
    q["hillshade_naive_blocks"] = q["hillshade_naive"]
    q["tile_partitions"] = W(f"select {qk} qk, z, x, y from (select distinct z, x, y from ({site_tiles(14)}))", "sites")
    return q


ORACLES = _oracles()
