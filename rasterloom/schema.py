"""Schemas of logs, measurements and tiles."""

from __future__ import annotations

FAILURE_LOG = "timestamp string, filename string, step string, status string, error string, full_path string"
BENCHMARK_LOG = "timestamp timestamp_ntz, device string, processes int, threads int, total_time double, avg_time double"
BEST_CONFIG = "device string, processes int, threads int"
CALIBRATION = "ppi int, width_pixel double, width_mm double, height_pixel double, height_mm double, correction_factor double"
RECT = "struct<cx:double,cy:double,w:double,h:double,angle:double>"
EXIF = "file string, key string, value string"
IMAGE = "path string, height int, width int, channels int, data binary"
TILE = "path string, height int, width int, tile_h int, tile_w int, start_h int, start_w int, data binary, error string"
