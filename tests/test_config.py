from meshloom import config

TEXT = """
# a comment
DATA_ROOT: /data
surfdata_path: ${DATA_ROOT}/surf
DS2_PATH = $DATA_ROOT/h0
target_ho_path: {DATA_ROOT}/a, /b ,
DATM_FLDS_PATH:
DATM_FLDS_TOKEN: TPQWL
Only for one case (free text)
FORCING_MODE: DATM
LAT1: 60
LAT2: 42.5
BATCH_SIZE: 10

TIME SERIES VARIABLES (forcing):
• FLDS, PSRF, FSDS, QBOT, PRECTmms, TBOT
surface properties:
• AREA, PCT_SAND, AREA
PCT_CLAY, LANDFRAC_PFT
PFT PARAMETERS:
• pft_leafcn, xl
1D PFT VARIABLES:
tlai
RESTART_COL_1D_VARS:
"""


def test_parse():
    c = config.from_text(TEXT)
    assert c.paths == {"ds1": "/data/surf", "ds2": "/data/h0"}
    assert c.targets_history == ("/data/a", "/b")
    assert (c.mode, c.lat_max, c.lat_min, c.batch_size) == ("datm", 60, -90, 10)
    assert c.datm_tokens == {"FLDS": "TPQWL"} and c.datm_paths == {}
    assert c.surface_scalars == ("AREA", "LANDFRAC_PFT") and c.surface_layers == ("PCT_SAND", "PCT_CLAY")
    assert c.parameters == ("leafcn", "xl") and c.pft == ("tlai",) and c.columns_flat == ()
    assert c.forcing_modules["A_forcing_ds8_prectmms"] == "PRECTmms"


def test_no_leak_between_loads():
    config.from_text(TEXT)
    assert config.from_text("BATCH_SIZE: x") == config.Config()


def test_other_number_of_forcing_variables():
    c = config.from_text("TIME SERIES VARIABLES\nA, B")
    assert list(c.forcing_modules.values()) == list(config.FORCING)
