"""Explicit schemas of all tables; nothing is inferred."""

from __future__ import annotations

VALUES = ["value_0", "value_1", "value_2", "value_3"]
TILE = ["tile_e", "tile_n"]
KEY = ["id", *TILE]
_FOUR = ", ".join(f"{v} double" for v in VALUES)

H = f"id string, tile_e int, tile_n int, {_FOUR}"
S = f"id string, tile_e int, tile_n int, {_FOUR}"
AREAS = "id int, tile_e int, tile_n int"
RESIDENTS = "tile_e int, tile_n int, value double"
KEYS = "period int, key binary"
FINGERPRINT = f"tile_e int, tile_n int, {_FOUR}"
TOP_ANCHOR = "tile_e int, tile_n int, value bigint"
FUF = "reference_area int, tile_e int, tile_n int, strength double"
STATISTICS = "highly_nomadic_users bigint, observed_total_users bigint, adjusted_total_users double"
INSTANCES = "instance int, status string, arguments array<struct<key: string, value: string>>, outputs array<struct<topic: string, id: int>>, error string, application_log string"
GRID_CSV = "ogc_fid int, grd_fixid string, grd_floaid string, grd_newid string, shape_leng double, shape_area double, ms_pop double"
BINARY = "id binary, tile_e int, tile_n int, value_0 float, value_1 float, value_2 float, value_3 float"
