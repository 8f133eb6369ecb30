"""The queries of this repository on the driver's tables."""
