from trackspark.sources.labels import EmptyLabelsError, read_labels
from trackspark.sources.tables import geo_table_sql, read_geo_table
from trackspark.sources.tracks import check_track_lines, parse_track_lines, parse_track_text, read_track_lines, read_tracks

__all__ = [
    "EmptyLabelsError", "check_track_lines", "geo_table_sql", "parse_track_lines", "parse_track_text",
    "read_geo_table", "read_labels", "read_track_lines", "read_tracks",
]
