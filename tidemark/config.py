"""Thresholds of the library, with the defaults of the data model."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Thresholds:
    # Fixed values of the data model.
    window_sec: float = 180.0
    event_window_sec: float = 60.0
    event_step_sec: float = 30.0
    key_width_sec: float = 3.0
    events_per_hour: float = 45.0
    genre_events_per_hour: dict = field(default_factory=dict)
    overlap: float = 0.5
    similarity: float = 0.85
    coverage_eps: float = 1.0
    speech_gap_sec: float = 0.5
    ocr_gap_sec: float = 3.0
    caption_gap_sec: float = 25.0
    caption_similarity: float = 0.30
    shot_group_sec: float = 15.0
    anchor_cap: int = 150
    qa_per_hour: int = 24
    qa_least: int = 10
    alpha: float = 0.8
    gold_accuracy: float = 0.9
    iou: float = 0.5
    iou_share: float = 0.9
    open_similarity: float = 0.5
    open_share: float = 0.6
    bilingual_share: float = 0.95
    qa_count: int = 8
    option_spread: float = 0.35
    shot_zh: int = 80
    shot_en: int = 60
    segment_zh: int = 400
    segment_en: int = 350
    anchors: int = 2
    elements: int = 6
    reference_zh: int = 80
    reference_en: int = 220
    target_sec: float = 5.0
    span_tolerance: float = 1.0


DEFAULT = Thresholds()

# Fixed values of the data model.
VERIFIED_STATES = ("verified", "refined")
BOUNDARY_STATES = ("verified", "refined", "split", "unreviewed")  # of kept events; rejected_final leaves
TIME_BUCKETS = 4
GENRES = ("movie", "documentary", "tv_series", "variety", "sports", "lecture", "tutorial", "interview", "vlog", "egocentric", "animation", "unknown")
MODALITIES = ("visual", "audio", "speech")
AUDIO_TYPES = ("music", "sfx", "applause", "noise", "other")
CAPABILITIES = (
    "L1_object", "L1_ocr", "L1_action", "L1_audio_asr", "L1_audio_event", "L1_speaker",
    "L2_grounding", "L2_ordering", "L2_counting", "L2_duration", "L2_state_change",
    "L3_causal", "L3_intent", "L3_counterfactual", "L3_prediction", "L3_math_rule",
    "L4_subtitle_visual", "L4_narration_align", "L4_audio_visual",
    "L5_summary", "L5_relation_graph", "L5_cross_scene", "L5_needle", "L5_foreshadow",
)
SUBTITLE_CAPABILITIES = ("L1_audio_asr", "L1_ocr", "L4_subtitle_visual", "L4_narration_align")
HARD_CAPABILITIES = ("L2_counting", "L2_ordering", "L3_causal", "L3_counterfactual", "L3_prediction", "L5_needle", "L5_foreshadow")
STAGES = ("S1", "S2", "S3", "S4", "S5", "S6", "S7")
