"""Rule versions and constants.

A RuleConfig is immutable and handed to every operator; a plan for another version is another
config, and branches that a version does not have never enter its plan.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RuleConfig:
    version: int = 12
    # swatches
    area_min: float = 60.0
    raster_share: float = 0.55
    vector_share: float = 0.1
    nms_overlap: float = 0.5
    furniture_ratio: float = 6.0
    furniture_height: float = 0.25
    # assignment
    slack: float = 2.0
    caption_overlap: float = 0.3
    caption_reach: float = 1.5
    caption_floor: float = 40.0
    far_height: float = 2.0
    far_page: float = 0.15
    # left-column blocks
    block_members: int = 2
    block_height: float = 3.0
    block_area: float = 0.03
    block_x_tolerance: float = 0.02
    block_left: float = 0.45
    block_bottom: float = 0.92
    block_pitch: float = 1.5
    block_band_words: int = 2
    block_uniform: float = 1.5
    # detection
    code_documents: int = 4
    alpha_documents: int = 8
    band_family: int = 3
    digit_lengths: tuple[int, ...] = (2, 3, 5, 6, 7, 8)
    digit_share: float = 0.5
    digit_tokens: int = 8
    column_tolerance: float = 0.005
    row_height: float = 1.5
    occurrence_factor: int = 2
    occurrence_pages: float = 0.6
    occurrence_cap: int = 5
    size_rows: int = 3
    dominance: float = 0.6
    dominance_margin: float = 0.7
    run_gap: float = 2.0
    regroup_rows: int = 3
    # routing and context
    spec_hits: int = 3
    fold_ratio: float = 1.2
    finish_rows: int = 3
    name_targets: int = 3
    # icons
    icon_small: float = 0.05
    icon_repeated: float = 0.5
    icon_big: float = 0.10
    repeat_floor: int = 5
    repeat_pages: float = 0.5
    # assembly guards
    collapse: int = 20
    borderline: int = 18
    merge_pages: int = 5
    merge_bindings: int = 24
    single_page_area: float = 5.0
    # audits
    cover: float = 0.6
    iou: float = 0.85
    stuck: float = 0.9
    orphan_overlap: float = 0.3

    def at(self, version: int) -> bool:
        """Whether the rules of `version` are in force."""
        return self.version >= version


PRODUCTION = RuleConfig()
