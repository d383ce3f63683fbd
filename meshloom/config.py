"""Run configuration: a text file of scalars and variable lists, read into a frozen dataclass."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

# Section titles, key names, variables, month lengths and module names of the file format.
SECTIONS = {
    "TIME SERIES VARIABLES": "forcing",
    "SURFACE PROPERTIES": "surface",
    "PFT PARAMETERS": "parameters",
    "SCALAR VARIABLES": "history",
    "1D PFT VARIABLES": "pft",
    "2D VARIABLES": "columns",
    "RESTART_COL_1D_VARS": "columns_flat",
}
ALIASES = {
    "surfdata_path": "DS1_PATH",
    "init_h0_file": "DS2_PATH",
    "init_r_path": "DS10_PATH",
    "target_ho_path": "H0_LIST_PATHS",
    "target_r_path": "R_LIST_PATHS",
    "clm_params_path": "CLM_PARAMS_PATH",
    "forcing_root": "DATM_ROOT",
}
FORCING = ("FLDS", "PSRF", "FSDS", "QBOT", "PRECTmms", "TBOT")
LAYERED = ("PCT_SAND", "PCT_CLAY", "PCT_NAT_PFT")
DAYS_PER_MONTH = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
MODULES = (
    "A_index_core", "A_ds1_surface", "A_ds2_history_x", "A_ds10_restart_x", "A_h0_list_y", "A_r_list_y",
    "A_forcing_ds4_flds", "A_forcing_ds5_psrf", "A_forcing_ds6_fsds", "A_forcing_ds7_qbot", "A_forcing_ds8_prectmms", "A_forcing_ds9_tbot",
    "A_clm_params_pft",
)

SCALAR = re.compile(r"([A-Za-z0-9_]+)\s*[:=]\s*(.*)")


@dataclass(frozen=True)
class Config:
    output: str = "output"
    paths: dict[str, str] = field(default_factory=dict)
    targets_history: tuple[str, ...] = ()
    targets_restart: tuple[str, ...] = ()
    mode: str = "datm"
    lat_max: int = 90
    lat_min: int = -90
    lon_min: int = 0
    lon_max: int = 360
    batch_size: int = 1000
    series_length: int = 179_580
    steps_per_day: int = 4
    years: int = 123
    datm_root: str = ""
    datm_start: int = 1901
    datm_end: int = 2023
    datm_tokens: dict[str, str] = field(default_factory=dict)
    datm_paths: dict[str, str] = field(default_factory=dict)
    forcing: tuple[str, ...] = FORCING
    surface: tuple[str, ...] = ()
    parameters: tuple[str, ...] = ()
    history: tuple[str, ...] = ()
    pft: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()
    columns_flat: tuple[str, ...] = ()

    @property
    def surface_scalars(self) -> tuple[str, ...]:
        return tuple(v for v in self.surface if v not in LAYERED)

    @property
    def surface_layers(self) -> tuple[str, ...]:
        return tuple(v for v in self.surface if v in LAYERED)

    @property
    def forcing_modules(self) -> dict[str, str]:
        """Module name to variable; a list of other than six variables leaves the usual ones."""
        names = self.forcing if len(self.forcing) == len(FORCING) else FORCING
        return dict(zip((m for m in MODULES if m.startswith("A_forcing_")), names, strict=True))


def listed(raw: str) -> list[str]:
    return [x.strip() for x in raw.split(",") if x.strip()]


def whole(raw: str | None, fallback: int) -> int:
    """raw as an integer; anything else leaves the fallback."""
    try:
        return int(raw)
    except (TypeError, ValueError):
        return fallback


def parse(text: str) -> tuple[dict[str, str], dict[str, list[str]]]:
    """Scalars and sections. A title opens a section; bullets, comma lists and bare names belong to it; # starts a comment line."""
    scalars: dict[str, str] = {}
    sections: dict[str, list[str]] = {s: [] for s in SECTIONS.values()}
    held: list[str] | None = None
    for line in map(str.strip, text.splitlines()):
        if not line or line[0] == "#":
            continue
        title = next((t for t in SECTIONS if line.upper().startswith(t)), None)
        if title:
            held = sections[SECTIONS[title]]
        elif line[0] == "•" and held is not None:
            held += listed(line.lstrip("•"))
        elif m := SCALAR.match(line):
            scalars[m[1]] = m[2].strip()
        elif held is not None and ("," in line or re.fullmatch(r"[A-Za-z0-9_]+", line)):
            held += listed(line)
    for alias, name in ALIASES.items():
        if alias in scalars:
            scalars.setdefault(name, scalars[alias])
    if root := scalars.get("DATA_ROOT"):
        scalars = {k: v.replace("$DATA_ROOT", root).replace("${DATA_ROOT}", root).replace("{DATA_ROOT}", root) for k, v in scalars.items()}
    return scalars, {k: list(dict.fromkeys(v)) for k, v in sections.items()}


def from_text(text: str) -> Config:
    s, lists = parse(text)
    c = Config()
    paths = {f"ds{n}": s[f"DS{n}_PATH"] for n in (1, 2, 4, 5, 6, 7, 8, 9, 10) if s.get(f"DS{n}_PATH")}
    if s.get("CLM_PARAMS_PATH"):
        paths["clm_params"] = s["CLM_PARAMS_PATH"]
    by_variable = lambda suffix: {v: x for v in FORCING if (x := s.get(f"DATM_{v.upper()}_{suffix}"))}
    numbers = {"lat_max": "LAT1", "lat_min": "LAT2", "lon_min": "LON1", "lon_max": "LON2", "batch_size": "BATCH_SIZE", "series_length": "TIME_SERIES_LENGTH", "steps_per_day": "STEPS_PER_DAY", "years": "YEARS_IN_DATA", "datm_start": "DATM_START_YEAR", "datm_end": "DATM_END_YEAR"}
    lists["parameters"] = [x.removeprefix("pft_") for x in lists["parameters"]]
    return replace(
        c,
        output=s.get("BASE_OUTPUT_ROOT") or c.output,
        paths=paths,
        targets_history=tuple(listed(s.get("H0_LIST_PATHS", ""))),
        targets_restart=tuple(listed(s.get("R_LIST_PATHS", ""))),
        mode=(s.get("FORCING_MODE") or c.mode).strip().lower(),
        datm_root=s.get("DATM_ROOT", ""),
        datm_tokens=by_variable("TOKEN"),
        datm_paths=by_variable("PATH"),
        **{k: whole(s.get(key), getattr(c, k)) for k, key in numbers.items()},
        **{k: tuple(v) for k, v in lists.items() if v},
    )


def load(path: str) -> Config:
    with open(path, encoding="utf-8") as f:
        return from_text(f.read())
