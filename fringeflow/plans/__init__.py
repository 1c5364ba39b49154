"""Session, lineage and driver-side planning helpers."""
