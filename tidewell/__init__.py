"""tidewell: a PySpark-native customer-value lakehouse (DQ contracts, quarantine,
FX carry-forward, campaign taxonomy, star schema and marts)."""
