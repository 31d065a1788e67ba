"""Property-market analytics on Spark: linkage, cleaning, panels, forecasts, news shocks, profiles."""
