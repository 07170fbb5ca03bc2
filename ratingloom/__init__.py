"""Set-at-a-time recommendation engine on Spark SQL and MLlib."""

from ratingloom.config import PRESET_A, PRESET_B, AlsConfig, SplitConfig

__all__ = ["AlsConfig", "PRESET_A", "PRESET_B", "SplitConfig"]
