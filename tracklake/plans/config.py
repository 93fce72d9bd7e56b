"""Paths and parameters of the pipeline, from YAML."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field, fields
from enum import Enum


class Stage(Enum):
    GPS = "gps"
    ARRAYS = "vocus_h5"
    ION_CAL = "vocus_cal"
    INSTRUMENT = "instrument"
    ALL = "all"


#: The order in which stages run.
ORDER = (Stage.GPS, Stage.ARRAYS, Stage.ION_CAL, Stage.INSTRUMENT)


def chosen(stages: list[Stage] | None) -> list[Stage]:
    """The stages to run, in order; none named, or ALL, means every one."""
    return [s for s in ORDER if not stages or Stage.ALL in stages or s in stages]


@dataclass
class Paths:
    """Where things are; unset paths follow from the base folders."""

    # folders that the others are in
    base_raw: str = ""
    base_processed: str = ""
    # read and written by the GPS stage
    gps_raw: str = ""
    gps_processed: str = ""
    roads_cache: str = ""
    # by the stages of the ion instrument
    vocus_h5_raw: str = ""
    peak_columns: str = ""
    tps_columns: str = ""
    vocus_cps: str = ""
    cal_standards: str = ""
    ksens_standards: str = ""
    vocus_cal_stats: str = ""
    # by the instrument stage
    logs_raw: str = ""
    lag_times: str = ""
    flags_file: str = ""
    field_map: str = ""
    exclusion_poly: str = ""
    NO_NO2_NOx_O3_cal: str = ""
    CO_N2O_CH4_C2H6_CO2_cal: str = ""
    calibration_store: str = ""
    output_l2: str = ""
    output_exchange: str = ""
    output_targets: str = ""

    def __post_init__(self) -> None:
        raw = {"gps_raw": "logs", "logs_raw": "logs", "vocus_h5_raw": "vocus"}
        done = {
            "gps_processed": "gps", "vocus_cps": "vocus/cps", "vocus_cal_stats": "vocus/cal_stats",
            "roads_cache": "road_segments", "output_l2": "l2", "output_exchange": "exchange", "output_targets": "targets",
            "calibration_store": "calibrations",
        }
        for base, names in ((self.base_raw, raw), (self.base_processed, done)):
            for name, folder in names.items():
                if base and not getattr(self, name):
                    setattr(self, name, f"{base.rstrip('/')}/{folder}")

    def needed(self, stages: list[Stage] | None = None) -> dict[str, bool]:
        """Names of the paths that stages need, and whether each must be there beforehand."""
        by = {
            Stage.GPS: {"gps_raw": True, "gps_processed": False},
            Stage.ARRAYS: {"vocus_h5_raw": True, "peak_columns": True, "tps_columns": True, "vocus_cps": False},
            Stage.ION_CAL: {"vocus_cps": False, "cal_standards": True},
            Stage.INSTRUMENT: {"logs_raw": True, "gps_processed": False, "flags_file": True, "lag_times": True, "field_map": True},
        }
        out: dict[str, bool] = {}
        for s in chosen(stages):
            for name, there in by[s].items():
                out[name] = out.get(name, False) or there
        return out


@dataclass
class Config:
    """Parameters of all stages."""

    # the GPS stage
    kalman_process_noise: float = 1e-9
    kalman_measurement_noise: float = 1e-10
    kalman_max_displacement_m: float = 15.0
    max_interpolation_gap_s: float = 5.0
    max_match_distance_m: float = 15.0
    max_match_angle_deg: float = 60.0
    segment_length_m: float = 30.0
    use_cached_roads: bool = True
    # the stages of the ion instrument
    tof_extraction_freq: float = 24990.0
    ptr_prefixes: str = "HCOKSNV"
    cal_cylinder_no: str = ""
    cal_step_flows: list[float] = field(default_factory=lambda: [0, 2, 5, 10])
    default_k: float = 2.5
    flow_tolerance: float = 0.1
    zero_flow_thresh: float = 450.0
    min_cal_samples: int = 70
    cal_window_samples: int = 60
    # the instrument stage
    org: str = ""
    revision: str = "r1"
    output_types: list[str] = field(default_factory=lambda: ["L1", "L2a"])
    value_precision: int = 5
    coord_precision: int = 5
    target_instruments: list[str] = field(default_factory=list)
    target_cylinders: list[str] = field(default_factory=list)
    target_length: int = 60
    vocus_target_flow: float = 1.0
    # the command line
    verbose: bool = True
    #: Zone of the ion counts' times.  The calibration stage may read them as
    #: another zone than the instrument stage only where this is set apart.
    cps_zone: str = "America/Los_Angeles"
    calibration_zone: str = "America/Los_Angeles"

    def problems(self) -> list[str]:
        out = []
        if not 0 < self.cal_window_samples < self.min_cal_samples:
            out.append("cal_window_samples must be less than min_cal_samples")
        if len(self.target_cylinders) != len(self.target_instruments):
            out.append("target_cylinders and target_instruments go in pairs")
        return out


#: Settings that are accepted and have no effect: a folder that no stage reads, and what only plots need, of which there are none.
WITHOUT_EFFECT = ("base_reference", "vocus_diagnostics", "generate_diagnostics")


def _of(kind, values: dict | None, aliases: dict[str, str]):
    values = {aliases.get(k, k): v for k, v in (values or {}).items()}
    known = {f.name for f in fields(kind)}
    if odd := sorted(set(values) - known - set(WITHOUT_EFFECT)):
        raise TypeError(f"unknown {kind.__name__.lower()} settings: {', '.join(odd)}")
    for name in sorted(set(values) & set(WITHOUT_EFFECT)):
        warnings.warn(f"the setting {name} has no effect", stacklevel=3)
    return kind(**{k: v for k, v in values.items() if k in known})


def load(text: str, aliases: dict[str, str] | None = None) -> tuple[Paths, Config]:
    """Paths and parameters from YAML with the parts ``paths`` and ``config``.

    A part ``aliases``, or the argument, says which settings of a file from
    elsewhere mean which of these: ``aliases: {their_name: logs_raw}``.
    """
    import yaml

    parts = yaml.safe_load(text) or {}
    aliases = (parts.get("aliases") or {}) | (aliases or {})
    return _of(Paths, parts.get("paths"), aliases), _of(Config, parts.get("config"), aliases)
