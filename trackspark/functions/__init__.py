from trackspark.functions.geo import haversine_km
from trackspark.functions.text import percent_label
from trackspark.functions.timing import hours, micros, whole_seconds

__all__ = ["haversine_km", "hours", "micros", "percent_label", "whole_seconds"]
