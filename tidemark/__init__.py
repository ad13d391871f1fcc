"""Economic time-series lake on Spark: Bronze documents, Silver series, star schema, forecasts."""
