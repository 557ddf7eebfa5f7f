"""DataFrame operators: shaping, quality, merging, history, series and summaries."""
