"""Parameters of all stages: frozen dataclasses, optionally overridden by a YAML file.

A file may use these classes' names or the published ones (PUBLISHED). A file that is missing or invalid
leaves the defaults; sections and keys that nobody knows are reported, not used.
"""

from __future__ import annotations

import dataclasses
import logging
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

log = logging.getLogger(__name__)


# The shipped parameters.
@dataclass(frozen=True)
class Pipeline:
    input_dir: str = "data/raw"
    output_dir: str = "data/outputs"
    min_text_height: int = 6
    max_text_height: int = 100
    device: str = "cuda:0"
    debug: bool = False
    debug_visualization: bool = True


@dataclass(frozen=True)
class Folders:
    image_dir: str = "data/raw"
    sahi_slicer_output_dir: str = "data/processed/tiles"
    metadata_output_dir: str = "data/processed/metadata"
    group_detection_metadata_dir: str = "data/processed/metadata/group_detection_metadata"
    global_metadata_dir: str = "data/processed/metadata/global_metadata"
    detection_metadata_dir: str = "data/processed/metadata/detection_metadata"
    cropping_output_dir: str = "data/processed/cropping"
    text_recognition_output_dir: str = "data/processed/metadata/final_annotations"


@dataclass(frozen=True)
class Pdf:
    dpi: int = 600
    format: str = "PNG"
    threads: int = 1

    def __post_init__(self):
        if self.dpi < 72:
            raise ValueError("dpi must be 72 or more")
        if self.format.upper() not in ("PNG", "JPEG", "JPG", "TIFF"):
            raise ValueError(f"{self.format} isn't an image format that pages are written in")
        object.__setattr__(self, "threads", max(1, min(12, self.threads)))


@dataclass(frozen=True)
class Tiling:
    tile_size: int = 720
    overlap_ratio: float = 0.1
    min_area_ratio: float = 0.1
    verbose: bool = False

    def __post_init__(self):
        if not 0 < self.overlap_ratio < 1:
            raise ValueError("overlap_ratio must lie between 0 and 1")
        if self.tile_size < 64:
            raise ValueError("tile_size must be 64 or more")

    @property
    def step(self) -> int:
        """Distance of tile starts; half a tile where the overlap leaves none."""
        return int(self.tile_size * (1 - self.overlap_ratio)) or max(1, self.tile_size // 2)


@dataclass(frozen=True)
class Grouping:
    iou_threshold: float = 0.1
    high_iou_threshold: float = 0.95
    contained_box_threshold: float = 0.9
    vertical_alignment_factor: float = 0.2
    horizontal_alignment_factor: float = 0.2
    proximity_factor: float = 1.0
    expansion_factor: float = 1.0
    cell: int = 128  # of the blocked spatial joins, in pixels; results don't depend on it


@dataclass(frozen=True)
class Cropping:
    output_dir: str = "data/processed/cropping"
    padding: int = 10


@dataclass(frozen=True)
class Recognition:
    confidence_threshold: float = 0.95
    model_name: str = "microsoft/trocr-small-printed"
    gpu: bool = True
    filter_overlaps: bool = True
    bbox_min_score: float = 0.4


@dataclass(frozen=True)
class Detection:
    languages: tuple[str, ...] = ("en",)
    gpu: bool = True
    detector: str = "craft"
    text_threshold: float = 0.7
    link_threshold: float = 0.9
    low_text: float = 0.2
    height_ths: float = 0.1
    width_ths: float = 0.1
    slope_ths: float = 0.04
    ycenter_ths: float = 0.5

    @property
    def thresholds(self) -> dict[str, float]:
        """What a detector is called with."""
        return {k: getattr(self, k) for k in ("text_threshold", "link_threshold", "low_text", "height_ths", "width_ths", "slope_ths", "ycenter_ths")}


@dataclass(frozen=True)
class Coordinates:
    image_dpi: int = 600
    validate_dimensions: bool = True
    tolerance_percent: float = 5.0
    pdf_base_dir: str | None = None
    image_perspective_dir: str = "data/processed/metadata/final_annotations"
    pdf_perspective_dir: str = "data/outputs/json_pdf_perspective"


@dataclass(frozen=True)
class Visualization:
    output_dir: str = "data/outputs/visualizations_final"


#: Published names of sections and keys, with the names here.
PUBLISHED = {
    "data_loader": ["folders"],
    "pdf_conversion": ["pdf"],
    "sahi_slicer": ["tiling"],
    "ocr": ["detection", "recognition"],
    "coordinate_conversion": ["coordinates"],
}
PUBLISHED_KEYS = {"high_overlap_threshold": "iou_threshold", "neighborhood_expansion_factor": "expansion_factor"}


@dataclass(frozen=True)
class Config:
    pipeline: Pipeline = field(default_factory=Pipeline)
    folders: Folders = field(default_factory=Folders)
    pdf: Pdf = field(default_factory=Pdf)
    tiling: Tiling = field(default_factory=Tiling)
    grouping: Grouping = field(default_factory=Grouping)
    cropping: Cropping = field(default_factory=Cropping)
    recognition: Recognition = field(default_factory=Recognition)
    detection: Detection = field(default_factory=Detection)
    coordinates: Coordinates = field(default_factory=Coordinates)
    visualization: Visualization = field(default_factory=Visualization)

    def value(self, path: str, default: Any = None) -> Any:
        """A value by its dotted path, published names included, or the default."""
        section, *rest = path.split(".")
        for name in PUBLISHED.get(section, [section]):
            at: Any = getattr(self, name, None) if dataclasses.is_dataclass(getattr(self, name, None)) else None
            for key in rest:
                at = getattr(at, PUBLISHED_KEYS.get(key, key), None) if dataclasses.is_dataclass(at) else None
            if at is not None:
                return at
        return default

    def section(self, name: str) -> dict[str, Any]:
        parts = [self.value(p) for p in PUBLISHED.get(name, [name])]
        return {k: v for part in parts if dataclasses.is_dataclass(part) for k, v in dataclasses.asdict(part).items()}


def _usable(value: Any, default: Any) -> bool:
    if isinstance(default, bool) or value is None:
        return isinstance(value, bool) or value is None and default is None
    if isinstance(default, (int, float)):
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return isinstance(value, (list, tuple)) if isinstance(default, tuple) else isinstance(value, str)


def load(path: str | Path | None = None) -> Config:
    """The configuration, with the file's values over the defaults."""
    given: Any = {}
    if path is not None and Path(path).is_file():
        import yaml

        try:
            given = yaml.safe_load(Path(path).read_text()) or {}
        except yaml.YAMLError:
            log.warning("%s is not valid YAML; defaults are used", path)
    if not isinstance(given, dict):
        log.warning("%s has no sections; defaults are used", path)
        given = {}
    parts = {f.name: f.default_factory() for f in dataclasses.fields(Config)}
    for section, asked in given.items():
        names = [n for n in PUBLISHED.get(section, [section]) if n in parts]
        if not names or not isinstance(asked, dict):
            log.warning("%s: %s", section, "not a section of values" if names else "unknown section")
            continue
        for key, value in asked.items():
            own = PUBLISHED_KEYS.get(key, key)
            users = [n for n in names if own in {f.name for f in dataclasses.fields(parts[n])}]
            if not users or not all(_usable(value, getattr(parts[n], own)) for n in users):
                log.warning("%s: %s", section, f"unused key {key}" if not users else f"{key} can't be {value!r}")
                continue
            for n in users:
                kind = type(getattr(parts[n], own))
                parts[n] = dataclasses.replace(parts[n], **{own: tuple(value) if kind is tuple else float(value) if kind is float else value})
    return Config(**parts)
