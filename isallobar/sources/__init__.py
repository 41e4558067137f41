"""Where fields come from: synthetic grids, array files, staged Parquet, published stores."""
