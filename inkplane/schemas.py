"""Schemas of the artifacts that stages exchange."""

from __future__ import annotations

QUAD = "array<array<int>>"

IMAGES = "image_name string, source_image string, width int, height int"
TILE = "struct<tile_id: string, coordinates: array<int>, grid_position: array<int>, tile_size: array<int>>"
TILES_FILE = f"source_image string, original_size array<int>, tile_size int, overlap_ratio double, num_tiles int, tiles array<{TILE}>"
IMAGE_TILES = "source_image string, tiles array<struct<tile_id: string, source_image: string, coordinates: array<int>, tile_size: array<int>, grid_position: array<int>, overlap: double, original_image_size: array<int>>>"
DETECTIONS = f"bbox {QUAD}, bbox_normalized array<array<double>>, rotation_angle int, tile_id string, tile_path string, tile_coordinates array<int>, grid_position array<int>, source_image string, original_image_size array<int>, detection_type string, tile_size array<int>"
GROUPED = f"bbox {QUAD}, bbox_normalized array<array<double>>, rotation_angle int, source_image string, detection_type string, original_image_size array<int>, grouped_from_tiles array<string>, is_grouped boolean"
MANIFEST = f"crop_filename string, original_bbox {QUAD}, original_text string, original_confidence double, orientation int, original_image_size array<int>"
ANNOTATIONS = f"text string, confidence double, bbox {QUAD}, crop_filename string, ocr_method string, easyocr_detections int, original_image_size array<int>"
POINTS = ANNOTATIONS.replace(QUAD, "array<array<double>>")
RUNS = "source_image string, processing_time string, pipeline_version string, config_hash string"
CORRUPT = "_corrupt"
