"""Reference data: parameters, models, sources and regions, as Python rows, DataFrames and SQL tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Parameters in their order, with units, limits, GRIB2 code and the short names files use for them.
PARAMETERS = [
    ("temperature_sl", "C", 60.0, -90.0, "167", ["t", "t2m", "tas"]),
    ("downward_shortwave_radiation_flux_gl", "W/m^2", 1500.0, 0.0, "169", ["swavr", "ssrd", "dswrf", "sdswrf"]),
    ("downward_longwave_radiation_flux_gl", "W/m^2", 500.0, 0.0, "175", ["strd", "dlwrf", "sdlwrf"]),
    ("relative_humidity_sl", "%", 100.0, 0.0, "157", ["r", "r2"]),
    ("visibility_sl", "m", 4500.0, 0.0, "20", ["vis"]),
    ("wind_u_component_10m", "m/s", 100.0, -100.0, "165", ["u10", "u", "uas"]),
    ("wind_v_component_10m", "m/s", 100.0, -100.0, "166", ["v10", "v", "vas"]),
    ("wind_u_component_100m", "m/s", 100.0, -100.0, "246", ["u100"]),
    ("wind_v_component_100m", "m/s", 100.0, -100.0, "247", ["v100"]),
    ("wind_u_component_200m", "m/s", 150.0, -150.0, "239", ["u200"]),
    ("wind_v_component_200m", "m/s", 150.0, -150.0, "240", ["v200"]),
    ("snow_depth_gl", "m", 12.0, 0.0, "141", ["sd", "sdwe", "sde"]),
    ("cloud_cover_high", "UI", 1.0, 0.0, "188", ["hcc"]),
    ("cloud_cover_medium", "UI", 1.0, 0.0, "187", ["mcc"]),
    ("cloud_cover_low", "UI", 1.0, 0.0, "186", ["lcc"]),
    ("cloud_cover_total", "UI", 1.0, 0.0, "164", ["tcc", "clt"]),
    ("total_precipitation_rate_gl", "kg/m^2/s", 0.2, 0.0, "260048", ["prate", "tprate", "rprate"]),
    ("downward_ultraviolet_radiation_flux_gl", "W/m^2", 1000.0, 0.0, "57", ["uvb"]),
    ("direct_shortwave_radiation_flux_gl", "W/m^2", 1000.0, 0.0, "47", ["dsrp"]),
    ("wind_speed_10m", "m/s", 150.0, 0.0, "207", ["10si", "si10"]),
    ("wind_speed_100m", "m/s", 200.0, 0.0, "249", ["100si", "si100"]),
    ("wind_direction_10m", "degrees", 0.0, 360.0, "194", ["wdir", "wdir10", "10wdir"]),
    ("pressure_msl", "Pa", 105000.0, 95000.0, "151", ["mslp", "msl", "prmsl"]),
]
THRESHOLD = 0.05

_WIND10 = ["wind_u_component_10m", "wind_v_component_10m"]
_WIND100 = ["wind_u_component_100m", "wind_v_component_100m"]
_WIND200 = ["wind_u_component_200m", "wind_v_component_200m"]
_CLOUDS = ["cloud_cover_high", "cloud_cover_medium", "cloud_cover_low"]
_SOLAR = ["downward_shortwave_radiation_flux_gl", "downward_longwave_radiation_flux_gl"]

# Key, name, resolution, running hours, delay in minutes, steps (first, last, by), variables, statistics,
# members, kind of grid, y axis and x axis as runs of (first, by, count) in millionths of a degree or in metres.
MODELS = [
    ("ECMWF_HRES_IFS_0P1DEGREE", "hres-ifs", "0.1 degrees", [0, 6, 12, 18], 1560, (0, 84, 1), [*_WIND10, *_WIND100, *_WIND200, "temperature_sl", "total_precipitation_rate_gl", *_SOLAR, *_CLOUDS, "cloud_cover_total", "snow_depth_gl", "visibility_sl", "direct_shortwave_radiation_flux_gl", "downward_ultraviolet_radiation_flux_gl"], [], 0, "latlon", [(90_000_000, -100_000, 1801)], [(-180_000_000, 100_000, 3601)]),
    ("ECMWF_ENS_STAT_0P1DEGREE", "ens-stat", "0.1 degrees", [0, 12], 1560, (0, 84, 3), ["pressure_msl", "wind_speed_10m", "wind_speed_100m", "temperature_sl"], ["mean", "std", "P10", "P25", "P75", "P90"], 0, "latlon", [(90_000_000, -100_000, 1800)], [(-180_000_000, 100_000, 3600)]),
    ("ECMWF_ENS_0P1DEGREE", "ens", "0.1 degrees", [0, 6, 12, 18], 1560, (0, 55, 1), ["downward_longwave_radiation_flux_gl", "downward_shortwave_radiation_flux_gl", "downward_ultraviolet_radiation_flux_gl", "direct_shortwave_radiation_flux_gl", "cloud_cover_low", "temperature_sl"], [], 50, "latlon", [(90_000_000, -100_000, 1800)], [(-180_000_000, 100_000, 3600)]),
    ("NCEP_GFS_1DEGREE", "ncep-gfs", "1 degree", [0, 6, 12, 18], 300, (3, 48, 3), ["temperature_sl", "cloud_cover_total", *_CLOUDS, *_SOLAR, "total_precipitation_rate_gl", "snow_depth_gl", "relative_humidity_sl", "visibility_sl", *_WIND10, *_WIND100], [], 0, "latlon", [(90_000_000, -1_000_000, 181)], [(-180_000_000, 1_000_000, 361)]),
    ("MO_UM_GLOBAL_17KM", "um-global", "17km", [0, 6, 12, 18], 300, (0, 47, 1), ["downward_shortwave_radiation_flux_gl", "cloud_cover_total", *_CLOUDS, "relative_humidity_sl", "snow_depth_gl", "temperature_sl", *_WIND10, "visibility_sl"], [], 0, "latlon", [(89_856_000, -156_000, 1153)], [(-45_000_000, 234_000, 385), (45_000_000, 234_000, 385), (135_000_000, 234_000, 385), (225_000_000, 234_000, 385)]),
    ("MO_UM_GLOBAL_10KM", "um-global", "10km", [0, 12], 300, (0, 54, 1), ["cloud_cover_total", *_CLOUDS, "visibility_sl", "relative_humidity_sl", "snow_depth_gl", "downward_shortwave_radiation_flux_gl", "temperature_sl", *_WIND10], [], 0, "latlon", [(89_953_125, -93_750, 1920)], [(-179_929_687, 140_625, 2560)]),
    ("MO_UM_UKV_2KM_OSGB", "um-ukv", "2km", [0, 6, 12, 18], 120, (0, 48, 1), ["cloud_cover_total", *_CLOUDS, "visibility_sl", "relative_humidity_sl", "snow_depth_gl", *_SOLAR, "temperature_sl", *_WIND10, "wind_direction_10m", "wind_speed_10m", "total_precipitation_rate_gl"], [], 0, "osgb", [(1_223_000, -2000, 704)], [(-239_000, 2000, 548)]),
    ("MO_UM_UKV_2KM_LAEA", "um-ukv", "2km", [0, 3, 6, 9, 12, 15, 18, 21], 120, (0, 42, 1), [*_CLOUDS, "visibility_sl", "relative_humidity_sl", "snow_depth_gl", *_SOLAR, "temperature_sl", "wind_direction_10m", "wind_speed_10m", "total_precipitation_rate_gl"], [], 0, "laea", [(700_000, -2000, 639)], [(-576_000, 2000, 455)]),
]

# Named regions as north, west, south, east and the suffix of the model's name.
REGIONS = [("uk", 62, -12, 48, 3, "uk"), ("uk-north60", 60, -12, 48, 3, "uk"), ("india", 35, 67, 6, 97, "india"), ("west-europe", 63, -12, 35, 26, "west-europe"), ("nl", 54, 2, 50, 8, "nl")]

# Source, archive or not, order-based or not, connections.
SOURCES = [("CEDA", True, False, 20), ("NOAA-GFS-S3", False, False, 100), ("ECMWF-Realtime-S3", False, True, 100), ("ECMWF-MARS", True, False, 20), ("MetOffice-Weather-Datahub", False, True, 10)]

# Source, name there, model, region, running hours, delay, extra parameters, last step, block counts.
OFFERED = [
    ("CEDA", "default", "MO_UM_GLOBAL_17KM", None, [0, 12], None, [], None, {"latitude": 8, "longitude": 8}),
    ("CEDA", "mo-um-global", "MO_UM_GLOBAL_17KM", None, [0, 12], None, [], None, {"latitude": 8, "longitude": 8}),
    ("CEDA", "mo-um-ukv", "MO_UM_UKV_2KM_OSGB", None, None, None, [], None, None),
    ("NOAA-GFS-S3", "default", "NCEP_GFS_1DEGREE", None, None, None, [], None, None),
    ("NOAA-GFS-S3", "gfs-1deg", "NCEP_GFS_1DEGREE", None, None, None, [], None, None),
    ("ECMWF-Realtime-S3", "default", "ECMWF_HRES_IFS_0P1DEGREE", "uk-north60", None, 420, [], None, None),
    ("ECMWF-Realtime-S3", "hres-ifs-uk", "ECMWF_HRES_IFS_0P1DEGREE", "uk-north60", None, 420, [], None, None),
    ("ECMWF-Realtime-S3", "hres-ifs-india", "ECMWF_HRES_IFS_0P1DEGREE", "india", None, 420, [], None, {"variable": 1}),
    ("ECMWF-Realtime-S3", "hres-ifs-nl", "ECMWF_HRES_IFS_0P1DEGREE", "nl", None, 420, [], 84, None),
    ("ECMWF-MARS", "default", "ECMWF_HRES_IFS_0P1DEGREE", "uk", None, None, [], None, None),
    ("ECMWF-MARS", "hres-ifs-uk", "ECMWF_HRES_IFS_0P1DEGREE", "uk", None, None, [], None, None),
    ("ECMWF-MARS", "hres-ifs-india", "ECMWF_HRES_IFS_0P1DEGREE", "india", None, None, [], None, None),
    ("ECMWF-MARS", "hres-ifs-west-europe", "ECMWF_HRES_IFS_0P1DEGREE", "west-europe", None, None, [], None, None),
    ("ECMWF-MARS", "ens-stat-india", "ECMWF_ENS_STAT_0P1DEGREE", "india", None, None, [], None, None),
    ("ECMWF-MARS", "ens-stat-uk", "ECMWF_ENS_STAT_0P1DEGREE", "uk", None, None, [], None, None),
    ("ECMWF-MARS", "ens-uk", "ECMWF_ENS_0P1DEGREE", "uk", None, None, [], None, {"latitude": 1, "longitude": 1}),
    ("MetOffice-Weather-Datahub", "default", "MO_UM_GLOBAL_10KM", "india", None, None, [], None, None),
    ("MetOffice-Weather-Datahub", "um-global-10km-india", "MO_UM_GLOBAL_10KM", "india", None, None, [], None, None),
    ("MetOffice-Weather-Datahub", "um-global-10km-uk", "MO_UM_GLOBAL_10KM", "uk", None, None, [], None, None),
    ("MetOffice-Weather-Datahub", "um-global-10km-nl", "MO_UM_GLOBAL_10KM", "nl", None, None, ["pressure_msl"], None, None),
    ("MetOffice-Weather-Datahub", "um-ukv-2km", "MO_UM_UKV_2KM_LAEA", None, None, None, [], None, None),
]

# The coordinate system of each kind of grid, as it is carried with the data. The OSGB scale factor of 0 is
# what files of that model say, and physically wrong (see CRS_FLAGS).
CRS = {
    "latlon": {"geodesic_ellipsiodal": {"crs": "EPSG:4326"}},
    "osgb": {
        "transverse_mercator": {
            "latitude_of_projection_origin": 49.0, "longitude_of_central_meridian": -2.0, "false_easting": 400000.0, "false_northing": -100000.0,
            "scale_factor_at_central_meridian": 0.0, "ellipsoid": {"semi_major_axis": 6377563.4, "semi_minor_axis": 6356256.91},
        }
    },
    "laea": {
        "lambert_azimuthal_equal_area": {
            "latitude_of_projection_origin": 54.9, "longitude_of_projection_origin": -2.5, "false_easting": 0.0, "false_northing": 0.0,
            "ellipsoid": {"semi_major_axis": 6378137.0, "semi_minor_axis": 6356752.314140356},
        }
    },
}
CRS_FLAGS = {"osgb": "scale factor 0 as given"}

#: What the parameters are, in our words.
DESCRIPTIONS = {
    "temperature_sl": "air temperature near the surface", "downward_shortwave_radiation_flux_gl": "sunlight that reaches the ground, direct and diffuse", "downward_longwave_radiation_flux_gl": "heat radiation that reaches the ground",
    "relative_humidity_sl": "relative humidity near the surface", "visibility_sl": "distance that can be seen near the surface", "wind_u_component_10m": "eastward wind at 10 m", "wind_v_component_10m": "northward wind at 10 m",
    "wind_u_component_100m": "eastward wind at 100 m", "wind_v_component_100m": "northward wind at 100 m", "wind_u_component_200m": "eastward wind at 200 m", "wind_v_component_200m": "northward wind at 200 m",
    "snow_depth_gl": "depth of snow on the ground", "cloud_cover_high": "share of sky under high clouds", "cloud_cover_medium": "share of sky under medium clouds", "cloud_cover_low": "share of sky under low clouds",
    "cloud_cover_total": "share of sky under any cloud", "total_precipitation_rate_gl": "rain and snow that reach the ground in a second", "downward_ultraviolet_radiation_flux_gl": "ultraviolet light that reaches the ground",
    "direct_shortwave_radiation_flux_gl": "direct sunlight that reaches the ground", "wind_speed_10m": "wind speed at 10 m", "wind_speed_100m": "wind speed at 100 m", "wind_direction_10m": "direction the wind at 10 m comes from",
    "pressure_msl": "air pressure at mean sea level",
}


def model(key: str) -> dict:
    names = ("key", "name", "resolution", "hours", "delay", "steps", "variables", "stats", "members", "grid", "y", "x")
    return next(dict(zip(names, m, strict=True)) for m in MODELS if m[0] == key)


def rows_of(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small dimension table. Its size is that of this file's lists, so that Spark may broadcast it."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def parameters(spark: SparkSession) -> DataFrame:
    """(ord, variable, units, upper, lower, grib2_code, aliases, description)"""
    return rows_of(spark, [(i, *p, DESCRIPTIONS[p[0]]) for i, p in enumerate(PARAMETERS)], "ord int, variable string, units string, upper double, lower double, grib2_code string, aliases array<string>, description string")


def aliases(spark: SparkSession) -> DataFrame:
    """(alias, variable, alias_ord): short names; alias_ord orders several names of one parameter."""
    return rows_of(spark, [(a, p[0], i * 10 + j) for i, p in enumerate(PARAMETERS) for j, a in enumerate(p[5])], "alias string, variable string, alias_ord int")


def models(spark: SparkSession) -> DataFrame:
    rows = [(k, n, r, h, d, *s, sorted(v), st, m, g, y, x) for k, n, r, h, d, s, v, st, m, g, y, x in MODELS]
    return rows_of(spark, rows, "model string, name string, resolution string, hours array<int>, delay int, first_step int, last_step int, step_by int, variables array<string>, stats array<string>, members int, grid string, y_runs array<struct<first:long,by:long,n:int>>, x_runs array<struct<first:long,by:long,n:int>>")


def offered(spark: SparkSession) -> DataFrame:
    return rows_of(spark, OFFERED, "source string, offered string, model string, region string, own_hours array<int>, own_delay int, extra array<string>, max_step int, block_counts map<string,int>")


def regions(spark: SparkSession) -> DataFrame:
    return rows_of(spark, REGIONS, "region string, north int, west int, south int, east int, suffix string")


def sources(spark: SparkSession) -> DataFrame:
    return rows_of(spark, SOURCES, "source string, is_archive boolean, is_order_based boolean, connections int")


def attributes(variables: list[str], grid: str) -> dict[str, str]:
    """What a store says of itself: its variables and its coordinate system, as JSON."""
    units = {p[0]: p[1] for p in PARAMETERS}
    return {"variables": json.dumps({v: {"description": DESCRIPTIONS[v], "units": units[v]} for v in variables}), "coord_system": json.dumps(CRS.get(grid, {}))}


def sql_value(x) -> str:
    if x is None:
        return "null"
    if isinstance(x, bool):
        return str(x).lower()
    if isinstance(x, list):
        return f"[{', '.join(map(sql_value, x))}]"
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else repr(x)


def sql_table(name: str, columns: str, rows: list) -> str:
    """A common table expression with these rows."""
    return f"{name}({columns}) as (values {', '.join('(' + ', '.join(map(sql_value, r)) + ')' for r in rows)})"


ALIAS_SQL = sql_table("aliases", "alias, variable, alias_ord", [(a, p[0], i * 10 + j) for i, p in enumerate(PARAMETERS) for j, a in enumerate(p[5])])
PARAMETER_SQL = sql_table("params", "ord, variable, units, upper, lower, grib2_code", [(i, *p[:5]) for i, p in enumerate(PARAMETERS)])
