"""isobar: station-observation cleaning and regression comparison on Spark."""
