from tallyspark.streaming.refresh import read_cells, start_refresh, weekly_cells

__all__ = ["read_cells", "start_refresh", "weekly_cells"]
