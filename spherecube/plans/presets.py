"""Settings of the known data sets, as plain dicts for :mod:`spherecube.plans.workflows`.

The names, patterns and levels are fixed values: they must equal what the data providers use and
what the standard output names are.
"""

from __future__ import annotations

LATLON_SKIP = ["*_bnds", "*_bounds", "time_bnds", "lat_bnds", "lon_bnds"]
LATLON_DIMS = [["time", "lat", "lon"], ["time", "lon", "lat"]]
COLUMN_SKIP = ["*band", "*_bounds", "time_bnds", "areas", "hyai", "hyam", "hybi", "hybm"]

IMERG = {
    "dataset": "IMERG_V7",
    "grid_type": "latlon_1d",
    "x": "lon",
    "y": "lat",
    "zoom": 9,
    "time_chunk": 24,
    "time_average": "1h",
    "source_time_res": "30MIN",
    "date_pattern": r"\.(\d{8})-",
    "date_format": "%Y%m%d",
    "file_glob": "3B-HHR.MS.MRG.3IMERG.*",
    "year_subdirs": True,
    "skip_variables": LATLON_SKIP,
    "required_dimensions": LATLON_DIMS,
}

IR_IMERG = {
    **IMERG,
    "dataset": "IR_IMERG_V7",
    "date_pattern": r"_(\d{10})_",
    "date_format": "%Y%m%d%H",
    "file_glob": "merg_*",
}

ERA5_SURFACE = {
    "dataset": "era5_2d",
    "grid_type": "latlon_1d",
    "x": "longitude",
    "y": "latitude",
    "zoom": 8,
    "time_chunk": 8,
    "time_subset": "3h",
    "source_time_res": "1H",
    "file_template": "e5.oper.an.sfc.{var_code}.ll025{grid_type}.{date_start}_{date_end}.nc",
    "monthly_files": True,
    "variables": [
        {"var_code": "128_137_tcwv", "var_name": "TCWV", "grid_type": "sc"},
        {"var_code": "128_034_sstk", "var_name": "SSTK", "grid_type": "sc"},
        {"var_code": "128_167_2t", "var_name": "VAR_2T", "grid_type": "sc"},
        {"var_code": "128_168_2d", "var_name": "VAR_2D", "grid_type": "sc"},
        {"var_code": "128_134_sp", "var_name": "SP", "grid_type": "sc"},
        {"var_code": "128_151_msl", "var_name": "MSL", "grid_type": "sc"},
        {"var_code": "128_165_10u", "var_name": "VAR_10U", "grid_type": "sc"},
        {"var_code": "128_166_10v", "var_name": "VAR_10V", "grid_type": "sc"},
        {"var_code": "128_232_ie", "var_name": "IE", "grid_type": "sc"},
        {"var_code": "128_231_ishf", "var_name": "ISHF", "grid_type": "sc"},
    ],
    "remap_variables": {
        "TCWV": "prw", "SSTK": "sstk", "VAR_2T": "tas", "VAR_2D": "d2m", "SP": "ps",
        "MSL": "psl", "VAR_10U": "u10", "VAR_10V": "v10", "IE": "ie", "ISHF": "hfssd",
    },
}

ERA5_LEVELS = {
    "dataset": "era5_3d",
    "grid_type": "latlon_1d",
    "x": "longitude",
    "y": "latitude",
    "zoom": 8,
    "time_chunk": 8,
    "time_subset": "3h",
    "source_time_res": "1H",
    "file_template": "e5.oper.an.pl.{var_code}.ll025{grid_type}.{date_start}_{date_end}.nc",
    "monthly_files": False,
    "level_subset": [100, 200, 300, 400, 500, 600, 700, 750, 800, 850, 900, 925, 950, 975, 1000],
    "passthrough_variables": ["level"],
    "variables": [
        {"var_code": "128_130_t", "var_name": "T", "grid_type": "sc"},
        {"var_code": "128_133_q", "var_name": "Q", "grid_type": "sc"},
        {"var_code": "128_157_r", "var_name": "R", "grid_type": "sc"},
        {"var_code": "128_129_z", "var_name": "Z", "grid_type": "sc"},
        {"var_code": "128_131_u", "var_name": "U", "grid_type": "uv"},
        {"var_code": "128_132_v", "var_name": "V", "grid_type": "uv"},
        {"var_code": "128_135_w", "var_name": "W", "grid_type": "sc"},
    ],
    "remap_variables": {
        "T": "ta", "Q": "hus", "R": "hur", "Z": "zg", "U": "ua", "V": "va", "W": "omega",
    },
}

SCREAM_1H = {
    "dataset": "SCREAMv1",
    "grid_type": "unstructured",
    "x": "ncol",
    "zoom": 9,
    "time_chunk": 24,
    "source_time_res": "1H",
    "date_pattern": r"\.(\d{4}-\d{2}-\d{2})-",
    "date_format": "%Y-%m-%d",
    "file_glob": "1hi.INSTANT.nhours_x1.*",
    "year_subdirs": False,
    "skip_variables": [*COLUMN_SKIP, "lev", "ilev"],
    "required_dimensions": [["time", "ncol"]],
    "remap_variables": {
        "LW_flux_up_at_model_top": "rlut",
        "precip_total_surf_mass_flux": "pr",
        "diag_equiv_reflectivity_vert_max": "max_reflectivity",
    },
}

SCREAM_3H = {
    **SCREAM_1H,
    "dataset": "SCREAMv1_ne120_INSTANT",
    "zoom": 8,
    "source_time_res": "3H",
    "file_glob": "3hi_ne120pg2_dyamond3.INSTANT.nhours_x3.*",
    "skip_variables": COLUMN_SKIP,
    "required_dimensions": [["time", "ncol"], ["time", "ncol", "lev"]],
    "passthrough_variables": ["p_levs"],
    "remap_variables": {
        "VapWaterPath": "prw", "qv": "hus", "T_mid": "ta", "RelativeHumidity": "hur",
        "z_mid": "z", "p_mid": "p", "U": "ua", "V": "va", "omega": "omega", "ps": "ps",
        "T_2m": "tas", "qv_2m": "huss", "SeaLevelPressure": "psl",
        "omega_at_500hPa": "omega500", "z_mid_at_500hPa": "z500",
        "MeridionalVapFlux": "vivt", "ZonalVapFlux": "uivt",
    },
}

SCREAM_1M = {
    **SCREAM_3H,
    "dataset": "SCREAMv1_ne120_AVERAGE",
    "time_chunk": 1,
    "source_time_res": "1M",
    "file_glob": "1ma_ne120pg2_dyamond3.AVERAGE.nmonths_x1.*",
    "remap_variables": {
        "T_mid": "ta", "qv": "hus", "RelativeHumidity": "hur", "z_mid": "z", "p_mid": "p",
        "U": "ua", "V": "va", "omega": "omega",
        "cldfrac_tot_for_analysis": "cldfrac_tot_for_analysis", "ps": "ps", "T_2m": "tas",
        "qv_2m": "huss", "RelativeHumidity_at_2m_above_surface": "hurs",
        "wind_speed_10m": "sfcWind", "SeaLevelPressure": "psl",
        "omega_at_500hPa": "omega500", "z_mid_at_500hPa": "z500",
        "MeridionalVapFlux": "vivt", "ZonalVapFlux": "uivt",
        "surface_upward_latent_heat_flux": "hflsd", "surf_sens_flux": "hfssd",
        "VapWaterPath": "prw", "LiqWaterPath": "lwp", "IceWaterPath": "iwp",
        "RainWaterPath": "rwp", "ShortwaveCloudForcing": "ShortwaveCloudForcing",
        "LongwaveCloudForcing": "LongwaveCloudForcing", "landfrac": "landfrac",
    },
}

# Output names of a global model run that is already on cells, keys included.
IFS_NAMES = {
    "time": "time", "level": "lev", "value": "cell", "u": "ua", "v": "va", "w": "omega",
    "z": "z", "t": "ta", "q": "hus", "r": "hur", "tp": "pr", "tcwv": "prw", "sp": "ps",
    "msl": "psl", "10u": "uas", "10v": "vas", "2t": "tas", "ttr": "rlut", "slhf": "hflsd",
    "sshf": "hflsu",
}

PRESETS = {
    "imerg": IMERG,
    "ir_imerg": IR_IMERG,
    "era5_2d": ERA5_SURFACE,
    "era5_3d": ERA5_LEVELS,
    "scream_1h": SCREAM_1H,
    "scream_3h": SCREAM_3H,
    "scream_1m": SCREAM_1M,
}
