from trackspark.operators.buckets import bucketize, distribution
from trackspark.operators.intervals import attach_labels, first_label_wins
from trackspark.operators.previous import HotLimits
from trackspark.operators.segments import merge_segments, segment_measures, trajectory_segments
from trackspark.operators.steps import calculate_distance, classify_stops, step_measures

__all__ = [
    "HotLimits", "attach_labels", "bucketize", "calculate_distance", "classify_stops",
    "distribution", "first_label_wins", "merge_segments", "segment_measures", "step_measures", "trajectory_segments",
]
