"""flowsift: network flow sessionization and detection as Spark DataFrame plans."""

from flowsift.config import DEFAULT_CONFIG, FEATURES, DetectionConfig

__all__ = ["DEFAULT_CONFIG", "FEATURES", "DetectionConfig"]
