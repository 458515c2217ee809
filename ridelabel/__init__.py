"""ridelabel: label vehicle GPS waypoints with public-transport lines and stops, on Spark."""

from ridelabel.params import MatchParams

__all__ = ["MatchParams"]
