"""Job settings, with the defaults a job runs under when nothing is said."""

from __future__ import annotations

from dataclasses import dataclass

from tidegrid.sources.layers import LAYER_SUFFIX

OUTPUT_FORMATS = ("COG", "ZARR", "IN_MEMORY")


@dataclass(frozen=True)
class JobConfig:
    """Paths and switches of one job. ``store`` is the folder of named tables."""

    store: str
    generate_mask: bool = False
    preprocess: bool = False
    execute: bool = True
    generate_wse: bool = False
    generate_depth: bool = True
    low_memory: bool = True
    output_format: str = "COG"
    depth_threshold: float | None = None
    elevation_threshold: float | None = None
    renormalize: bool = False
    mesh_path: str = ""
    snapshot_path: str = ""
    crosswalk_path: str = ""
    coverage_path: str = ""
    triangles_path: str = ""
    layers_path: str = ""
    layer_suffix: str = LAYER_SUFFIX
    output_path: str = ""
    exterior_layers: tuple[str, ...] = ()
    interior_layers: tuple[str, ...] = ()
    ring_deg: float = 10.0
    overview_levels: int | None = None
    chunk_store: str = "depth.zarr"

    def format(self) -> str:
        chosen = self.output_format.upper()
        if chosen not in OUTPUT_FORMATS:
            raise ValueError(f"output_format must be one of {OUTPUT_FORMATS}, got {self.output_format!r}")
        return chosen
